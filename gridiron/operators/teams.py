"""Team efficiency per week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def team_week_epa(plays: DataFrame) -> DataFrame:
    """Plays and mean EPA per (season, team, week) from staged plays."""
    return plays.groupBy("season", F.col("possession_team").alias("team"), "week").agg(
        F.count("*").alias("plays"), F.avg("epa").alias("avg_epa")
    )
