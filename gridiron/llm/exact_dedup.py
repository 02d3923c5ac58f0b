"""Exact dedup by an extendible-hash index on shared files, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridiron.llm.common import others, unpack, written

#: Bytes a row has in a bucket besides its text.
ROW = 32
#: Buckets for each shuffle partition, about; a bucket holds at least LEAST bytes.
BUCKETS, LEAST = 4, 1 << 16


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space made one blank; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def hash_key(text: Column, bits: int = 64) -> Column:
    """The first `bits` bits of the text's hash, as a long; fewer than 64 make collisions, for tests."""
    key = F.xxhash64(text)
    return key if bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - bits), 64 - bits)


def directory(keys: DataFrame, capacity: int, finest: int) -> DataFrame:
    """slot, bucket, depth: the directory of the index over `keys` (h, bytes), with 2 ** finest slots at most.

    A bucket owns the keys whose first `depth` bits are the same, a range of keys; it is
    named by the first slot of its range.  The directory starts as deep as evenly filled
    buckets need and is doubled as long as a bucket is overfull; only overfull buckets
    are split, the others share their new slots.  A key larger than a bucket counts as
    nothing, its rows go to overflow parts of their own.
    """
    size = F.when(F.col("bytes") <= capacity, F.col("bytes")).otherwise(0)
    slots = keys.groupBy(F.shiftrightunsigned("h", 64 - finest).alias("slot")).agg(F.sum(size).alias("bytes"))
    slots = written(slots, "slots")
    total = slots.agg(F.sum("bytes")).first()[0] or 0
    start = min(finest, max(0, int(math.log2(max(1, total / capacity)))))

    def bucket(depth: Column) -> Column:
        width = F.pow(F.lit(2.0), F.lit(finest) - depth).cast("long")
        return F.col("slot") - F.pmod("slot", width)

    found = slots.withColumn("depth", F.lit(start))
    while True:
        load = F.sum("bytes").over(Window.partitionBy(bucket(F.col("depth"))))
        split = (load > capacity) & (F.col("depth") < finest)
        found = written(found.select("slot", "bytes", (F.col("depth") + split.cast("int")).alias("depth"), split.alias("split")), "directory")
        if found.where("split").isEmpty():
            return found.select("slot", bucket(F.col("depth")).alias("bucket"), "depth")
        found = found.drop("split")


def owned(docs: DataFrame, carried: list[Column], key_bits: int = 64) -> DataFrame:
    """The rows of `docs` (doc_id, text) as their buckets' owners left them.

    The first scan counts the bytes of each hash key, and the directory is made from
    these counts.  The second sends every row to its bucket; the owner task of a bucket
    sorts its rows by key and text, so that different texts of one key follow each other
    as a chain and only those whose bytes are equal become a group.  A key larger than a
    bucket is dealt to overflow parts, whose groups are merged afterwards.

    Returns doc_id, bucket, part (null unless overflow), h, text_sha256, first (the
    smallest doc_id of the group in this part), n (its rows there), nth (the row's place
    in it from 1), and what is `carried`.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carried, normalised(F.col("text")).alias("said"))
    base = base.withColumn("h", hash_key(F.col("said"), key_bits))
    keys = base.groupBy("h").agg(F.sum(F.octet_length("said") + F.lit(ROW).cast("long")).alias("bytes"))
    keys = written(keys, "keys")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(LEAST, math.ceil(total / (BUCKETS * partitions)))
    finest = math.ceil(math.log2(BUCKETS * partitions)) + 4
    at = directory(keys, capacity, finest)
    big = written(
        keys.where(F.col("bytes") > capacity).select(F.col("h").alias("big"), F.ceil(F.col("bytes") / capacity).alias("parts")),
        "overflow",
    )
    # both are bounded by the number of shuffle partitions: 2 ** finest slots, and total / capacity keys larger than a bucket
    placed = (
        base.withColumn("at", F.shiftrightunsigned("h", 64 - finest))
        .join(F.broadcast(at), F.col("at") == F.col("slot"))
        .join(F.broadcast(big), F.col("h") == F.col("big"), "left")
        .withColumn("part", F.floor(F.rand(11) * F.col("parts")))
    )
    same = Window.partitionBy("h", "part", "bucket", "said")
    names = base.columns[1:-2]
    return (
        placed.repartition("bucket", "part")
        .withColumn("nth", F.row_number().over(same.orderBy(F.asc_nulls_last("doc_id"))))
        .withColumn("first", F.min("doc_id").over(same))
        .withColumn("n", F.count("*").over(same))
        .select("doc_id", "bucket", "part", "h", F.sha2("said", 256).alias("text_sha256"), "first", "n", "nth", *names)
    )


def _judged(rows: DataFrame) -> DataFrame:
    """Adds keep_id, group_size and kept: the groups of overflow parts are merged, with a row per part and text."""
    least = F.min(F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("id"), F.col("part").alias("part")))
    merged = rows.where("part is not null and nth = 1").groupBy("h", "text_sha256").agg(least.alias("least"), F.sum("n").alias("all"))
    merged = merged.select(F.col("h").alias("of_h"), F.col("text_sha256").alias("of_text"), "least", "all")
    joined = rows.join(merged, (F.col("h") == F.col("of_h")) & (F.col("text_sha256") == F.col("of_text")), "left")
    split = F.col("of_h").isNotNull()
    return joined.select(
        *rows.columns,
        F.when(split, F.col("least.id")).otherwise(F.col("first")).alias("keep_id"),
        F.coalesce("all", "n").alias("group_size"),
        ((F.col("nth") == 1) & (~split | (F.col("part") == F.col("least.part")))).alias("kept"),
    )


def exact_duplicates(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """Groups documents whose texts are equal but for the length and kind of runs of ASCII white space.

    Returns a row per row of `docs` (doc_id, text): doc_id, keep_id (the smallest doc_id
    of the group), group_size, kept, text_sha256 (of the normalised text).  One
    row of each group is kept, one with the smallest doc_id; of repeated rows any one is.
    Null texts are empty texts; a null doc_id comes after all others, so a group of such
    rows alone keeps one and has keep_id null.  Other columns are not read.  Texts are
    compared by their bytes within a part of a bucket; the parts of a text larger than a
    bucket are matched by SHA-256.
    """
    rows = written(owned(docs, [], key_bits), "owned")
    return _judged(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that `exact_duplicates` keeps, with all their columns."""
    carried = [F.col("text").alias("_text"), F.col("doc_id").alias("_id"), others(docs, "doc_id", "text").alias("rest")]
    rows = written(owned(docs, carried), "owned")
    return unpack(_judged(rows).where("kept"), docs.columns, {"doc_id": F.col("_id"), "text": F.col("_text")})
