"""Fantasy score: a weighted sum of box-score stats."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridiron.functions.numbers import round_scaled

#: The default scoring rule.  The order fixes the order of addition.
DEFAULT_SCORING: dict[str, float] = {
    "passing_yards": 0.04,
    "passing_tds": 4,
    "interceptions": -1,
    "passing_two_pt": 2,
    "rushing_yards": 0.1,
    "rushing_tds": 6,
    "rushing_two_pt": 2,
    "receiving_yards": 0.1,
    "receptions": 0.5,
    "receiving_tds": 6,
    "receiving_two_pt": 2,
    "fumbles": -1,
    "fumbles_lost": -1,
    "fumble_recovery_tds": 6,
    "fg_made_0_19": 3,
    "fg_made_20_29": 3,
    "fg_made_30_39": 3,
    "fg_made_40_49": 4,
    "fg_made_50_59": 5,
    "fg_made_60_plus": 6,
    "fg_missed": -1,
    "pat_made": 1,
    "pat_missed": -1,
}


def fantasy_points(scoring: Mapping[str, float] = DEFAULT_SCORING) -> Column:
    """Score of a row, rounded to cents; terms are added in the order of ``scoring``."""
    if not scoring:
        return F.lit(0.0)
    terms = [f"{stat} * {float(weight)!r}D" for stat, weight in scoring.items()]
    return round_scaled(F.expr(" + ".join(terms)), 2)
