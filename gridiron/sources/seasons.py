"""Season-partitioned Parquet sources: ``<root>/season=<year>/*.parquet``."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

FIRST_SEASON = 2024
#: What reading a missing or damaged season raises.
UNREADABLE = (PySparkException, Py4JJavaError)


class NoSeasonError(ValueError):
    """None of the requested seasons could be read."""


class MissingColumnsError(ValueError):
    """No season carries a column the models need."""


def default_seasons(current_year: int | None = None) -> list[int]:
    """First supported season up to the current year, both included."""
    return list(range(FIRST_SEASON, (current_year or dt.date.today().year) + 1))


def cast_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the declared columns that ``df`` has; NaN becomes null, extra columns stay."""
    declared = {f.name: f.dataType for f in schema}
    columns = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        if name in declared:
            column = column.cast(declared[name])
            if isinstance(declared[name], (T.DoubleType, T.FloatType)):
                column = F.when(~F.isnan(column), column)
        columns.append(column.alias(name))
    return df.select(*columns)


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise MissingColumnsError(f"columns missing from every season: {', '.join(missing)}")
    return df


def union_seasons(frames: Iterable[DataFrame], schema: T.StructType) -> DataFrame:
    """Union by name; a column that one season lacks is null there."""
    typed = [cast_declared(frame, schema) for frame in frames]
    if not typed:
        raise NoSeasonError("no season could be read")
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), typed)
    return require_columns(merged, schema)


def season_frames(
    spark: SparkSession, root: str, seasons: Iterable[int] | None = None, skipped: list[int] | None = None
) -> dict[int, DataFrame]:
    """A lazy frame per readable season below ``root``; one that cannot be read is logged, skipped and added to ``skipped``.

    A season has the columns of all its files: a Spark job per season merges their
    footers.  A season that is missing, has a damaged footer or files whose types
    contradict each other can't be read.
    """
    frames = {}
    for season in seasons if seasons is not None else default_seasons():
        try:
            frames[season] = spark.read.option("basePath", root).option("mergeSchema", True).parquet(f"{root}/season={season}")
        except UNREADABLE as error:
            skip(season, root, error, skipped)
    return frames


def skip(season: int, root: str, error: Exception, skipped: list[int] | None) -> None:
    log.warning("skipping season %s of %s: %s", season, root, str(error).splitlines()[0])
    if skipped is not None:
        skipped.append(season)


def read_seasons(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    seasons: Iterable[int] | None = None,
    skipped: list[int] | None = None,
) -> DataFrame:
    """The union of :func:`season_frames`.

    The season comes from the directory, so a later filter on it leaves the other
    directories unread.
    """
    return union_seasons(season_frames(spark, root, seasons, skipped).values(), schema)
