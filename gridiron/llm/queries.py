"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridiron.llm import (
    decontaminate,
    embed_dedup,
    exact_dedup,
    hard_negatives,
    lang_id,
    line_dedup,
    near_dup,
    packing,
    prefix_trie,
    quotes,
    secret_scan,
    sharding,
    warc,
)
from gridiron.llm.common import written

FOUR_WORDS = near_dup.Settings(words=4)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    """The tokenizer's file, PACKING_TOKENIZER or the public one; it must lie there on every executor."""
    import public_tokenizers

    return os.environ.get("PACKING_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), 2048, with_ids=False)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lang_id.train(docs.where(lang_id.in_training()))
    held_out = F.coalesce(~lang_id.in_training(), F.lit(False)).alias("held_out")
    return lang_id.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), FOUR_WORDS)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(table(spark, sf_dir, "documents"))
    none = F.lit(None).cast("int").alias("grown_shard")
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none, "n_alike", "moved"
    )


def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_duplicates(table(spark, sf_dir, "embeddings"), every_length=True)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "nth", F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret")


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c rebuilt: the first h turns of conversation c - c % 20, then its own after the first h.

    h is crc32 of the decimal c, modulo 4.  Takes and returns turns as `prefix_trie.positioned`
    has them, and the conversations left without turns.
    """
    lens = turns.groupBy("conv").agg(F.count("*").alias("len"))
    own = lens.select(
        "conv",
        "len",
        (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).alias("h"),
        (F.col("conv") - F.col("conv") % 20).alias("base"),
    )
    bases = lens.select(F.col("conv").alias("of"), F.col("len").alias("base_len"))
    plan = own.join(bases, F.col("base") == F.col("of"), "left")
    plan = written(plan.withColumn("head", F.least("h", F.coalesce("base_len", F.lit(0)))), "rebuilt")
    moved = turns.join(plan.select(F.col("conv").alias("c"), "h", "head"), F.col("conv") == F.col("c"))
    after = moved.where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "t1", "t2", "words")
    heads = turns.where("pos < 3 and conv % 20 = 0").select(F.col("conv").alias("from"), "pos", "t1", "t2", "words")
    before = plan.join(heads, F.col("base") == F.col("from")).where("pos < head").select(*after.columns)
    return written(after.unionByName(before), "rebuilt-turns"), plan.where("head = 0 and len <= h").select("conv")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(prefix_trie.positioned(table(spark, sf_dir, "conversations")), "positions")
    return prefix_trie.trie(*with_shared_heads(turns))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = written(rows.withColumn("label", moved), "vectors")
    return hard_negatives.hard_negatives(rows, rows.where("id % 100 = 0"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = [
        op1_line_dedup, op2_packing, op3_warc, op4_decontaminate, op5_language_id, op6_near_duplicates, op7_sharding,
        op8_quotes, op9_embedding_dedup, op10_secrets,
        op11_conversation_trie, op12_exact_dedup, op13_hard_negatives,
    ]
    return {f.__name__: f for f in each}
