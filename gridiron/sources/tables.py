"""Databases, tables by release, and views.

A model's rows live in one table of the database ``releases``, partitioned by the run that
wrote them (and by season).  Its fixed name, such as ``marts.fct_team_week_epa``, is a view
of the published rows: which run's rows these are, for each model and season, stands in one
pointer, a view of a single row.  So a run writes beside the published rows, is checked, and
one catalog call publishes all of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed database names; models land in exactly these.
RAW, STAGING, MARTS = "raw", "staging", "marts"
RELEASES = "releases"
POINTER = f"{RELEASES}.current_runs"
#: Stands for the season of a model without seasons, and for a null season.
WHOLE = 0

Runs = Mapping[str, Mapping[int, str]]


class ColumnTypeError(TypeError):
    """A run brings a column in another type than the stored one."""


def ensure_databases(spark: SparkSession, root: str | None = None) -> None:
    """Databases that are missing are made, below ``root`` if given, else in the warehouse."""
    for database in (RAW, STAGING, MARTS, RELEASES):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{root}/{database}'" if root else ""))


def published_runs(spark: SparkSession) -> dict[str, dict[int, str]]:
    """Model -> season -> run, as published."""
    return spark.table(POINTER).first().runs if spark.catalog.tableExists(POINTER) else {}


def stored(name: str) -> str:
    """The table that holds all runs' rows of a model."""
    return f"{RELEASES}.{name.replace('.', '__')}"


def _literal(runs: Runs) -> str:
    models = ", ".join(
        f"'{name}', map({', '.join(f'{season}, {run!r}' for season, run in sorted(of.items()))})" for name, of in sorted(runs.items()) if of
    )
    return f"CAST(map({models}) AS map<string, map<int, string>>)"


def _point(spark: SparkSession, runs: Runs) -> None:
    """The one call that publishes."""
    spark.sql(f"CREATE OR REPLACE VIEW {POINTER} AS SELECT {_literal(runs)} AS runs")


class Release:
    """What one run writes.  One run at a time; what a failed one wrote goes when the next one is published."""

    def __init__(self, spark: SparkSession):
        ensure_databases(spark)
        self.spark, self.run = spark, uuid.uuid4().hex
        self.before = published_runs(spark)
        self.runs = {name: dict(of) for name, of in self.before.items()}

    def table(self, name: str) -> DataFrame:
        """The model's rows as they will be when this run is published."""
        rows = self.spark.table(stored(name))
        return rows.where(self._chosen(name, rows.columns, _literal(self.runs))).drop("run_id")

    @staticmethod
    def _chosen(name: str, columns: list[str], runs: str) -> str:
        """The rows of the chosen runs: a condition on partition columns alone, so other runs' files aren't read."""
        season = f"coalesce(season, {WHOLE})" if "season" in columns[-1:] else str(WHOLE)
        return f"run_id = try_element_at(try_element_at({runs}, '{name}'), {season})"

    def _prepare(self, name: str, schema: T.StructType, partition_by: str | None) -> list[str]:
        """Makes the table, or adds the columns it lacks; returns its columns in order."""
        spark, table = self.spark, stored(name)
        fields = [f for f in schema if f.name != partition_by] + [f for f in schema if f.name == partition_by]
        if not spark.catalog.tableExists(table):
            columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
            columns.insert(len(columns) - bool(partition_by), "run_id string")
            parts = ", ".join(["run_id", *([partition_by] if partition_by else [])])
            spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet PARTITIONED BY ({parts})")
            return spark.table(table).columns
        have = {f.name: f.dataType for f in spark.table(table).schema}
        other = [f"{f.name}: {f.dataType.simpleString()}" for f in fields if f.name in have and have[f.name].simpleString() != f.dataType.simpleString()]
        if other:
            raise ColumnTypeError(f"columns of {name} in another type than stored: {', '.join(other)}")
        new = [f for f in fields if f.name not in have]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        return spark.table(table).columns

    def _aligned(self, df: DataFrame, name: str, columns: list[str]) -> DataFrame:
        """The table's columns in order; those that ``df`` lacks are null."""
        kinds = {f.name: f.dataType for f in self.spark.table(stored(name)).schema}
        own = {c: F.col(f"`{c}`") for c in df.columns} | {"run_id": F.lit(self.run)}
        return df.select(*(own.get(c, F.lit(None).cast(kinds[c])).alias(c) for c in columns))

    def write(self, df: DataFrame, name: str, partition_by: str | None = None, requested: Iterable[int] | None = None) -> None:
        """Replaces the model as a whole, or only the ``requested`` seasons; one that comes out empty goes."""
        columns = self._prepare(name, df.schema, partition_by)
        if any(run == self.run for run, _ in self._partitions(name)):  # written before by this run
            self.spark.sql(f"ALTER TABLE {stored(name)} DROP IF EXISTS PARTITION (run_id='{self.run}')")
        self._aligned(df, name, columns).write.insertInto(stored(name))
        held = {season: run for run, season in self._partitions(name) if run == self.run}
        asked = set(requested) if requested is not None else None
        kept = {s: r for s, r in self.runs.get(name, {}).items() if asked is not None and s not in asked}
        self.runs[name] = kept | {s: r for s, r in held.items() if asked is None or s in asked}

    def begin_seasons(self, name: str, schema: T.StructType, requested: Iterable[int] | None = None) -> None:
        """Before :meth:`write_season`: seasons that are asked for again stay as published until they are written."""
        self._prepare(name, schema, "season")
        if requested is None:
            self.runs[name] = {}

    def write_season(self, df: DataFrame, name: str, season: int) -> None:
        """Replaces one season by a job of its own; if it fails nothing of it is seen.  Seasons may be written side by side."""
        columns = self.spark.table(stored(name)).columns
        place = f"run_id='{self.run}', season={season}"
        about = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {stored(name)}").collect()}
        path = f"{about['Location']}/run_id={self.run}/season={season}"
        self._aligned(df, name, columns).drop("run_id", "season").write.mode("overwrite").parquet(path)
        self.spark.sql(f"ALTER TABLE {stored(name)} ADD IF NOT EXISTS PARTITION ({place}) LOCATION '{path}'")
        self.runs.setdefault(name, {})[season] = self.run

    def seasons(self, name: str) -> list[int]:
        """The seasons of which a model has rows, as they will be when this run is published."""
        return sorted(self.runs.get(name, {}))

    def end_seasons(self, name: str, seasons: Iterable[int], requested: Iterable[int] | None = None) -> None:
        """After :meth:`write_season` of all ``seasons``: of the requested ones, or of all, no others stay."""
        asked = set(requested) if requested is not None else None
        kept = set(seasons)
        self.runs[name] = {s: r for s, r in self.runs.get(name, {}).items() if s in kept or (asked is not None and s not in asked)}

    def _partitions(self, name: str) -> list[tuple[str, int]]:
        found = []
        for row in self.spark.sql(f"SHOW PARTITIONS {stored(name)}").collect():  # a row per run and season
            of = dict(part.split("=", 1) for part in row.partition.split("/"))
            season = of.get("season", str(WHOLE))
            found.append((of["run_id"], int(season) if season.lstrip("-").isdigit() else WHOLE))
        return found

    def publish(self, views: Mapping[str, str] | None = None) -> None:
        """Makes this run's rows the published ones of all models at once.

        Views are made first; they look up the published runs, so until the pointer is
        replaced they show the rows of the run before.  Then partitions go that neither
        this nor the run before points to, so that queries under way can end.
        """
        if not self.spark.catalog.tableExists(POINTER):
            _point(self.spark, {})
        for name in self.runs:
            columns = self.spark.table(stored(name)).columns
            shown = [c for c in columns if c != "run_id"]
            if self.spark.catalog.tableExists(name):
                if self.spark.catalog.getTable(name).tableType != "VIEW":
                    self.spark.sql(f"DROP TABLE {name}")
                elif self.spark.table(name).columns == shown:
                    continue
            chosen = self._chosen(name, columns, f"(SELECT runs FROM {POINTER})")
            create_view(self.spark, name, f"SELECT {', '.join(f'`{c}`' for c in shown)} FROM {stored(name)} WHERE {chosen}")
        for name, query in (views or {}).items():
            create_view(self.spark, name, query)
        _point(self.spark, self.runs)
        self._sweep()

    def _sweep(self) -> None:
        for name in self.runs:
            used = {(r, s) for of in (self.runs, self.before) for s, r in of.get(name, {}).items()}
            seasons = "season" in self.spark.table(stored(name)).columns[-1:]
            for run, season in self._partitions(name):
                if (run, season) not in used and (season != WHOLE or not seasons):
                    place = f"run_id='{run}'" + (f", season={season}" if seasons else "")
                    self.spark.sql(f"ALTER TABLE {stored(name)} DROP IF EXISTS PARTITION ({place})")


def by_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows grouped by the table's partition column before a write.

    Adaptive execution splits a partition value that holds many rows over
    several tasks and joins small ones, so neither a hot value nor a crowd of
    tiny files results.
    """
    return df.hint("rebalance", column)


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt to ranges of the columns and sorted by them before a write.

    A file then holds few values of the columns, so a filter on a leading one skips the
    other files' and row groups' data by their statistics.  The ranges are of about
    equal size, whatever the values' frequencies.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def create_view(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
