"""Line deduplication across documents, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridiron.llm.common import WHITE, hash128, lower_ascii, others, unpack, written


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Drops lines that at least `min_docs` documents hold, except in the smallest doc_id.

    Lines are split at newlines and compared stripped of ASCII white space, A-Z
    lower-cased; shorter ones than `min_chars` code points always stay.  Each line
    is exploded as its position and a 128-bit hash, the documents of a hash are
    counted with a partial aggregate, so a line found everywhere is a few rows per
    task, and the dropped positions are gathered per document.  Shared hashes are
    written as a table, so the join back to them is one whose hot keys Spark splits.

    Returns the documents with `text` replaced, and n_lines, n_dropped.  A null
    text counts as one empty line and becomes empty; rows without doc_id keep all
    lines and are in no count; rows of one doc_id are one document; repeated rows
    are treated alike.  Input columns called n_lines or n_dropped are replaced.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        others(docs, "doc_id", "text").alias("rest"),
        F.col("doc_id").alias("id"),
        *hash128(text, "t"),
        F.split(text, "\n").alias("lines"),
    )
    trimmed = F.btrim("line", F.lit(WHITE))
    keys = (
        docs.select(F.col("doc_id").alias("id"), *hash128(text, "t"), F.split(text, "\n").alias("lines"))
        .select("id", "t1", "t2", F.posexplode("lines").alias("pos", "line"))  # a text is hashed once, not for each line
        .where(F.col("id").isNotNull() & (F.char_length(trimmed) >= min_chars))
        .select("id", "t1", "t2", "pos", *hash128(lower_ascii(trimmed), "h"))
    )
    held = F.min("id") < F.max("id") if min_docs == 2 else F.count_distinct("id") >= min_docs
    shared = (
        keys.groupBy("h1", "h2").agg(F.min("id").alias("keeper"), held.alias("shared")).where("shared").drop("shared")
    )
    shared = written(shared, "shared-lines")
    dropped = (
        keys.join(shared, ["h1", "h2"])
        .where("id > keeper")
        .groupBy("id", "t1", "t2")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    joined = base.join(dropped, ["id", "t1", "t2"], "left")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.when(F.col("dropped").isNull(), every).otherwise(F.array_except(every, F.col("dropped")))
    return unpack(
        joined,
        docs.columns,
        {
            "doc_id": F.col("id"),
            "text": F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"),
            "n_lines": F.size("lines").cast("long"),
            "n_dropped": F.coalesce(F.size("dropped"), F.lit(0)).cast("long"),
        },
    )
