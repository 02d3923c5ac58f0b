"""League snapshot: two JSON documents (rosters, users) flattened to one row per rostered player."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridiron.schemas import LEAGUE_ROSTERS, LEAGUE_ROSTERS_JSON, LEAGUE_USER

UNKNOWN_OWNER = "unknown"


def read_league_rosters(spark: SparkSession, path: str) -> DataFrame:
    """Roster documents: JSON arrays, one file per league; files are read in parallel.

    A broken document and an element without roster_id (an error response) are errors.
    """
    rosters = spark.read.schema(LEAGUE_ROSTERS_JSON).json(path, multiLine=True, mode="FAILFAST")
    return rosters.withColumn("roster_id", _required("roster_id", "a league document has a roster without roster_id"))


def read_league_users(spark: SparkSession, path: str) -> DataFrame:
    """Users as (user_id, owner_name), the last document of a user winning.

    Documents are JSON arrays, one file per league, parsed element by element, so a
    file of any size is never held as a whole.  A user without ``display_name`` is named
    "unknown", a user whose ``display_name`` is null keeps the null: read as a variant,
    the one is no value and the other a value that is null.  A broken document and an
    element without user_id (an error response) are errors.
    """
    users = spark.read.schema(LEAGUE_USER).json(path, multiLine=True, mode="FAILFAST")
    # a file is read in order by one task, within which the ids increase
    placed = users.select("*", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id().alias("at")).alias("seq"))
    return last_user_wins(
        placed.select(
            _required("user_id", "a league document has a user without user_id").alias("user_id"),
            F.when(F.col("display_name").isNull(), UNKNOWN_OWNER)
            .otherwise(F.try_variant_get("display_name", "$", "string"))
            .alias("owner_name"),
            "seq",
        )
    )


def _required(column: str | Column, message: str) -> Column:
    return F.coalesce(column, F.raise_error(F.lit(message)))


def last_user_wins(users: DataFrame) -> DataFrame:
    """One row per user_id: the one with the highest ``seq``."""
    return users.groupBy("user_id").agg(F.max_by("owner_name", "seq").alias("owner_name"))


def flatten_league(rosters: DataFrame, users: DataFrame, my_user_id: str) -> DataFrame:
    """One row per (roster, player).

    Rosters without players yield no row.  An owner not among the users is
    "unknown".  The ownership flag compares ids, never names, and is false for
    a roster without owner.

    ``users`` must hold one row per user_id.  No broadcast hint: Spark
    broadcasts the smaller side when its size is below the session's threshold
    and shuffles otherwise.
    """
    named = users.select("user_id", "owner_name", F.lit(True).alias("known"))
    owned = rosters.join(named, F.col("owner_id").eqNullSafe(F.col("user_id")), "left")
    flat = owned.select(
        "roster_id",
        "owner_id",
        F.when(F.col("known"), F.col("owner_name")).otherwise(UNKNOWN_OWNER).alias("owner_name"),
        F.col("owner_id").eqNullSafe(F.lit(my_user_id)).alias("is_my_roster"),
        F.explode("players").alias("sleeper_id"),
        F.col("settings.wins").alias("wins"),
        F.col("settings.losses").alias("losses"),
    )
    return flat.select(*LEAGUE_ROSTERS.fieldNames())
