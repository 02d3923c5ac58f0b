"""Helpers shared by the operators: text, hashes, written tables, ranks."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
#: Fixed value: the white space of ASCII, `[\x20\x09-\x0D]`.
WHITE = " \t\n\x0b\x0c\r"

_OWN: dict[str, str] = {}
_WORK: ContextVar[str | None] = ContextVar("work", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only on a local master without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="llm-")
    return _OWN[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_WORK.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of the shared folder, if it is there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextmanager
def work_folder(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables written inside go to a folder of their own, which is deleted at the end.

    So a result that is still to be computed from them must be written inside, to a path made outside.
    """
    path = new_path(spark, f"{name}-work")
    before = _WORK.set(path)
    try:
        yield
    finally:
        _WORK.reset(before)
        delete(spark, path)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """`df` as a table written to the shared folder: cuts lineage and survives lost executors."""
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, *names: str) -> Column:
    """All columns but those named, as one struct, so that their names can't clash with working columns."""
    kept = [quoted(c) for c in df.columns if c not in names]
    return F.struct(*kept) if kept else F.struct(F.lit(0).alias("_"))


def unpack(df: DataFrame, columns: list[str], values: dict[str, Column], rest: str = "rest") -> DataFrame:
    """The input's `columns` in their order, those in `values` replaced, further values after them."""
    out = [values[c].alias(c) if c in values else F.col(rest)[c].alias(c) for c in columns]
    return df.select(*out, *(v.alias(c) for c, v in values.items() if c not in columns))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def hash128(value: Column, prefix: str) -> list[Column]:
    """Two independent 64-bit hashes, by which equal texts are told from different ones."""
    return [F.xxhash64(value).alias(f"{prefix}1"), F.xxhash64(F.lit(prefix), value).alias(f"{prefix}2")]


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Adds a gapless rank from 0 within `keys`, which must not be null.

    A key may hold most rows: its rows are ranked within hash buckets, and only
    the buckets' counts are summed up in order.  Ranking and the join with the counts
    share one shuffle of the rows.
    """
    buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*(F.col(c).alias(f"_of_{c}") for c in keys), F.col("_bucket").alias("_of_bucket"), "_start")
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    same = [F.col(c) == F.col(f"_of_{c}") for c in keys] + [F.col("_bucket") == F.col("_of_bucket")]
    return (
        placed.withColumn("_at", F.row_number().over(within) - 1)
        .join(starts, same)
        .select(*df.columns, (F.col("_at") + F.col("_start")).alias(name))
    )
