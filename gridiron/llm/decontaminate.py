"""Benchmark decontamination, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridiron.llm.common import LOWER, UPPER, hash128, others, unpack

#: Fixed value: the characters outside words, once A-Z are lower-cased: `[\x00-\x2F\x3A-\x60\x7B-\x7F]`.
BETWEEN = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: A word of the unchanged text with what stands before it, or the rest after the last word.
UNIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+\z"


def words(text: Column) -> Column:
    spaced = F.translate(text, BETWEEN + UPPER, " " * len(BETWEEN) + LOWER)
    return F.array_remove(F.split(F.coalesce(spaced, F.lit("")), " "), "")


def benchmark_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """Each distinct window of the items once: its words joined, its length and the items that hold it."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    at = items.withColumn("k", F.least(F.lit(n), F.size("words"))).select(
        "item", "words", "k", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("k") + 1)).alias("at")
    )
    window = F.slice("words", F.col("at"), F.col("k"))
    return (
        at.select("item", "k", F.xxhash64(window).alias("h"), F.array_join(window, " ").alias("window"))
        .groupBy("h", "k", "window")
        .agg(F.collect_set("item").alias("items"))
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_bytes: int = 64 << 20
) -> DataFrame:
    """Finds words of documents that lie in a window of `n` words of a benchmark item.

    Words are runs of 0-9, a-z and characters beyond ASCII after lower-casing A-Z; an
    item of fewer than `n` words is one window.  Each position of a document gives the
    hash of its window, looked up in the hash set of the benchmark's windows and
    verified against their words.  The set is broadcast if its measured size is at
    most `broadcast_bytes`; beyond that the lookup is a shuffled join.  Hits are merged
    per document in order of position, with no list of positions held but the merged
    spans.

    Returns the documents' columns and n_words, n_hit, items (sorted texts), spans
    (first and past-the-last word, from 0) and `cleaned`, the text without the spans'
    words and what stands before each.  A null or empty text has no words; repeated
    rows are treated alike; an empty benchmark hits nothing; an item without an id counts
    as "null".  Input columns with the new names are replaced.
    """
    windows = benchmark_windows(benchmark, n)
    bound = windows.agg(
        F.coalesce(F.sum(F.octet_length("window") + 64 + 24 * F.size("items")), F.lit(0)).alias("bytes"),
        F.collect_set("k").alias("lengths"),  # at most n values
    ).first()
    if bound.bytes <= broadcast_bytes:
        windows = F.broadcast(windows)
    lengths = sorted(bound.lengths) or [n]
    identity = [F.col("doc_id").alias("id"), *hash128(F.coalesce("text", F.lit("")), "t")]
    at = (
        docs.select(*identity, words(F.col("text")).alias("words"))
        .select("id", "t1", "t2", "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("at"))
        .where(F.col("at").between(1, F.size("words")))  # without words the sequence is 1, 0
    )
    if len(lengths) == 1:
        at = at.withColumn("k", F.lit(lengths[0]))
    else:
        at = at.withColumn("k", F.explode(F.array(*map(F.lit, lengths))))
    window = F.slice("words", F.col("at"), F.col("k"))
    at, said = at.withColumn("h", F.xxhash64(window)), F.array_join(window, " ")
    if bound.bytes > broadcast_bytes:  # of a position only its window is shuffled, not the document's words
        at, said = at.withColumn("said", said).drop("words"), F.col("said")
    hits = (
        at.join(windows, ["h", "k"])
        .where(said == F.col("window"))
        .select("id", "t1", "t2", "at", (F.col("at") + F.col("k")).alias("end"), "items")
    )
    earlier = Window.partitionBy("id", "t1", "t2").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, -1)
    start = F.greatest("at", F.coalesce(F.max("end").over(earlier), F.lit(1)))
    found = (
        hits.withColumn("start", start)
        .groupBy("id", "t1", "t2")
        .agg(
            F.sum(F.greatest(F.col("end") - F.col("start"), F.lit(0))).alias("n_hit"),
            F.array_sort(
                F.collect_list(F.when(F.col("start") < F.col("end"), F.struct(F.col("start") - 1, F.col("end") - 1)))
            ).cast("array<struct<first:int,past:int>>").alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    base = docs.select(
        others(docs, "doc_id", "text").alias("rest"), *identity, F.col("text"), F.size(words(F.col("text"))).alias("n")
    )
    joined = base.join(
        found,
        [base.id.eqNullSafe(found.id), base.t1 == found.t1, base.t2 == found.t2],
        "left",
    ).select(base["*"], "n_hit", "spans", "items")
    hit_words = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["past"] - 1)))
    units = F.regexp_extract_all("text", F.lit(UNIT), F.lit(0))
    cleaned = F.when(F.col("n_hit").isNull(), F.col("text")).otherwise(
        F.array_join(
            F.array_compact(F.zip_with(units, _mask(units, hit_words), lambda u, hit: F.when(~hit, u))), ""
        )
    )
    return unpack(
        joined,
        docs.columns,
        {
            "doc_id": F.col("id"),
            "text": F.col("text"),
            "n_words": F.col("n").cast("long"),
            "n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"),
            "items": F.coalesce("items", F.array().cast("array<string>")),
            "spans": F.coalesce("spans", F.array().cast("array<struct<first:int,past:int>>")),
            "cleaned": cleaned,
        },
    )


def _mask(units: Column, hit_words: Column) -> Column:
    """For each unit whether its word is hit; both lists are ordered, so runs of kept units are laid between the hits."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(units)), hit_words)
    flags = F.concat(
        F.transform(kept, lambda i: F.struct(i.alias("i"), F.lit(False).alias("hit"))),
        F.transform(hit_words, lambda i: F.struct(i.alias("i"), F.lit(True).alias("hit"))),
    )
    return F.slice(F.transform(F.array_sort(flags), lambda s: s["hit"]), F.lit(1), F.size(units))
