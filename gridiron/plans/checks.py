"""Not-null checks with error and warn severity."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

ERROR, WARN = "error", "warn"

#: Table -> column -> severity.
NOT_NULL: dict[str, dict[str, str]] = {
    "stg_pbp": {"game_id": ERROR, "play_type": ERROR},
    "stg_rosters": {"player_id": WARN, "team": ERROR},
    "stg_sleeper_rosters": {"roster_id": ERROR, "sleeper_id": ERROR},
    "stg_pbp_player_stats": {"game_id": ERROR},
    "fct_team_week_epa": {"team": ERROR, "week": ERROR, "plays": ERROR},
    "fct_player_week": {"player_id": WARN, "week": ERROR, "sleeper_id": WARN},
    "fct_player_roster_status": {"player_id": WARN, "week": ERROR},
    "fct_player_game_stats": {"player_id": ERROR, "week": ERROR, "fantasy_points": ERROR},
}


class CheckFailedError(AssertionError):
    """A check of severity error found rows that break it."""


def check_source(df: DataFrame, parts: Mapping[str, str]) -> DataFrame:
    """(table_name, column_name, severity, failures) of the tables whose rows are those of ``df`` under a condition.

    All columns of all these tables are counted in one read.
    """
    checks = [(table, column, severity) for table in parts for column, severity in NOT_NULL[table].items()]
    counted = df.agg(
        *[
            F.count_if(F.expr(parts[table]) & F.col(column).isNull()).alias(f"{table}_{column}")
            for table, column, _ in checks
        ]
    )
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(severity).alias("severity"),
            F.col(f"{table}_{column}").alias("failures"),
        )
        for table, column, severity in checks
    ]
    return counted.select(F.inline(F.array(*entries)))


def quality_report(sources: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Report over sources, each with its tables and the condition that makes their rows; every source is read once."""
    return reduce(DataFrame.unionAll, [check_source(df, parts) for df, parts in sources])


def enforce(report: DataFrame) -> None:
    """Log broken warn checks and raise on broken error checks.  The report has one row per check."""
    broken = report.where("failures > 0").collect()
    for row in broken:
        log.warning("%s: %s.%s has %d null rows", row.severity, row.table_name, row.column_name, row.failures)
    errors = [f"{row.table_name}.{row.column_name} ({row.failures})" for row in broken if row.severity == ERROR]
    if errors:
        raise CheckFailedError("null values in " + ", ".join(errors))
