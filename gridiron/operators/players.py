"""Weekly player status and ownership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLAYER_WEEK_COLUMNS = (
    "season",
    "week",
    "team",
    "player_id",
    "sleeper_id",
    "player_name",
    "position",
    "status",
    "years_exp",
    "draft_number",
    "age",
)


def player_week(rosters: DataFrame) -> DataFrame:
    return rosters.select(*PLAYER_WEEK_COLUMNS)


def player_roster_status(weeks: DataFrame, league: DataFrame) -> DataFrame:
    """Every player-week with its current owner, if any.

    The league side is normally far below the session's broadcast threshold and
    Spark then broadcasts it by itself.  If it is not, both sides shuffle; rows
    without a league id match nothing, so they are spread by a second key over
    as many values as the shuffle has partitions instead of meeting in one task,
    and a hot id is left to the adaptive skew-join split.
    """
    partitions = int(weeks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.when(
        F.col("sleeper_id").isNull(),
        F.pmod(F.hash("season", "week", "team", "player_name", "player_id"), F.lit(partitions)),
    ).otherwise(F.lit(0))
    left = weeks.withColumn("spread", spread)
    right = league.select(
        "sleeper_id", "roster_id", "owner_name", "is_my_roster", "wins", "losses", F.lit(0).alias("spread")
    )
    return left.join(right, ["sleeper_id", "spread"], "left").select(
        "season",
        "week",
        "team",
        "player_id",
        "sleeper_id",
        "player_name",
        "position",
        "status",
        "roster_id",
        "owner_name",
        "is_my_roster",
        "wins",
        "losses",
    )
