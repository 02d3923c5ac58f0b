"""Hand-written rows for tests: give the interesting columns, the rest gets defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridiron import schemas
from gridiron.operators.boxscore import KEY_COLUMNS, STATS

YARDS = {"passing_yards", "rushing_yards", "receiving_yards", "air_yards", "yards_after_catch"}

STATS_SCHEMA = T.StructType(
    [
        T.StructField("season", T.IntegerType()),
        T.StructField("week", T.IntegerType()),
        *[T.StructField(name, T.StringType()) for name in KEY_COLUMNS[2:]],
        *[T.StructField(s, T.DoubleType() if s in YARDS else T.LongType()) for s in STATS],
        T.StructField("fantasy_points", T.DoubleType()),
    ]
)

STATUS_SCHEMA = T.StructType()
for _name in "team player_id sleeper_id player_name position status owner_name".split():
    STATUS_SCHEMA.add(_name, "string")
for _name in "season week roster_id wins losses".split():
    STATUS_SCHEMA.add(_name, "integer")
STATUS_SCHEMA.add("is_my_roster", "boolean")


def _frame(spark: SparkSession, schema: T.StructType, defaults: dict, rows: list[dict]) -> DataFrame:
    unknown = {key for row in rows for key in row} - set(schema.fieldNames())
    assert not unknown, unknown
    return spark.createDataFrame([tuple({**defaults, **row}.get(f) for f in schema.fieldNames()) for row in rows], schema)


def plays(spark: SparkSession, *rows: dict) -> DataFrame:
    defaults = {"season": 2024, "week": 1, "game_id": "g", "posteam": "A", "defteam": "B", "play_type": "pass"}
    return _frame(spark, schemas.PLAYS, defaults, list(rows))


def stats(spark: SparkSession, *rows: dict) -> DataFrame:
    defaults = {s: 0.0 if s in YARDS else 0 for s in STATS}
    defaults |= {"season": 2024, "week": 1, "team": "A", "player_id": "p", "player_name": "P", "fantasy_points": 0.0}
    return _frame(spark, STATS_SCHEMA, defaults, list(rows))


def status(spark: SparkSession, *rows: dict) -> DataFrame:
    defaults = {"season": 2024, "week": 1, "team": "A", "player_id": "p", "player_name": "P", "position": "WR"}
    return _frame(spark, STATUS_SCHEMA, defaults, list(rows))


def dicts(df: DataFrame) -> list[dict]:
    return [row.asDict() for row in df.collect()]
