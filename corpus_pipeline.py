"""The pipeline over a corpus: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes all that the one before it kept, as a table written to the shared
folder.  An empty table, null texts and null ids pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridiron.llm import decontaminate, lang_id, line_dedup, near_dup, packing
from gridiron.llm.common import delete, new_path, others, unpack, work_folder, written
from gridiron.llm.queries import table, tokenizer_file

#: Languages are learned from data by a model, which SQL can't express; tests compare with a brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no learned language: too few of their n-grams are known, or the text is null or has no letter."""
    return lang_id.keep_identified(docs, lang_id.train(docs.where(lang_id.in_training())))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds; n_chars, if the table has it, follows the text; others stay, whatever their names."""
    rows = docs.select(others(docs, "doc_id", "text").alias("doc"), "doc_id", "text")
    kept = line_dedup.dedup_lines(rows)
    length = {"n_chars": F.char_length("text").cast("long")} if "n_chars" in docs.columns else {}
    return unpack(kept, docs.columns, {"doc_id": F.col("doc_id"), "text": F.col("text")} | length, "doc")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates."""
    return near_dup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    rows = docs.select(others(docs).alias("doc"), "doc_id", "text")
    hits = decontaminate.decontaminate(rows, table(spark, sf_dir, "benchmark"))
    return hits.where("n_hit = 0").select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every piece with its sequence and place."""
    return packing.pack(docs, tokenizer_file(), 2048)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`.

    A stage's working tables go when its result is written, and so does the result of the
    stage before it; the last stage's stay, since its rows are still to be computed.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with work_folder(spark, name):
            docs = written(stage(spark, docs, sf_dir), name, path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
