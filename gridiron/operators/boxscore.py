"""Player box scores.

A play credits up to six players, one per role.  ``ROLES`` states for every
role which column names the player and which metrics it earns; the single-role
aggregates and the full box score are both generated from it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridiron.functions.scoring import DEFAULT_SCORING, fantasy_points

WEEK_KEYS = ["season", "week", "player_id"]
NAME_KEYS = ["team", "player_name"]
KEY_COLUMNS = ["season", "week", "team", "player_id", "player_name"]


def _when(*parts: str) -> str:
    """Conjunction of conditions; a bare column name stands for a raised flag."""
    return " AND ".join(part if " " in part else f"{part} = 1" for part in parts)


def _made_from(distance: str) -> str:
    return _when("field_goal_attempt", "field_goal_result = 'made'", f"kick_distance {distance}")


@dataclass(frozen=True)
class Role:
    """Who is credited and with what: counted conditions and summed columns, by output name."""

    player: str
    name: str | None
    counts: Mapping[str, str]
    sums: Mapping[str, str] = field(default_factory=dict)

    @property
    def slots(self) -> dict[str, str]:
        """Metric -> generic slot: n0, n1, … for the counts, s0, s1, … for the sums."""
        counts = {metric: f"n{i}" for i, metric in enumerate(self.counts)}
        return counts | {metric: f"s{i}" for i, metric in enumerate(self.sums)}


_CONVERTED = _when("two_point_attempt", "two_point_conv_result = 'success'")

ROLES: dict[str, Role] = {
    "passing": Role(
        "passer_player_id",
        "passer_player_name",
        counts={
            "pass_attempts": _when("pass_attempt"),
            "completions": _when("complete_pass"),
            "passing_tds": _when("pass_touchdown"),
            "interceptions": _when("interception"),
            "passing_two_pt": _CONVERTED,
        },
        sums={"passing_yards": "passing_yards"},
    ),
    "rushing": Role(
        "rusher_player_id",
        "rusher_player_name",
        counts={
            "rush_attempts": _when("rush_attempt"),
            "rushing_tds": _when("rush_touchdown"),
            "rushing_two_pt": _CONVERTED,
        },
        sums={"rushing_yards": "rushing_yards"},
    ),
    # A target is any pass attempt with a receiver, a reception a completed one.
    "receiving": Role(
        "receiver_player_id",
        "receiver_player_name",
        counts={
            "targets": _when("pass_attempt"),
            "receptions": _when("complete_pass"),
            "receiving_tds": _when("pass_touchdown", "complete_pass"),
            "receiving_two_pt": _CONVERTED,
        },
        sums={
            "receiving_yards": "receiving_yards",
            "air_yards": "air_yards",
            "yards_after_catch": "yards_after_catch",
        },
    ),
    "kicking": Role(
        "kicker_player_id",
        "kicker_player_name",
        counts={
            "fg_made_0_19": _made_from("< 20"),
            "fg_made_20_29": _made_from("BETWEEN 20 AND 29"),
            "fg_made_30_39": _made_from("BETWEEN 30 AND 39"),
            "fg_made_40_49": _made_from("BETWEEN 40 AND 49"),
            "fg_made_50_59": _made_from("BETWEEN 50 AND 59"),
            "fg_made_60_plus": _made_from(">= 60"),
            "fg_missed": _when("field_goal_attempt", "field_goal_result <> 'made'"),
            "pat_made": _when("extra_point_attempt", "extra_point_result = 'good'"),
            "pat_missed": _when("extra_point_attempt", "extra_point_result <> 'good'"),
        },
    ),
    "fumbles": Role(
        "fumbled_1_player_id",
        None,
        counts={"fumbles": _when("fumble"), "fumbles_lost": _when("fumble_lost")},
    ),
    # Only a score by the recovering player counts, hence return_touchdown.
    "fumble_recovery_tds": Role(
        "fumble_recovery_1_player_id",
        None,
        counts={"fumble_recovery_tds": _when("return_touchdown")},
    ),
}

#: Roles that carry a team and a name, and thereby decide who is listed at all.
NAMING = [name for name, role in ROLES.items() if role.name]
ROLE_CODE = {name: code for code, name in enumerate(ROLES)}
NAMING_CODES = ", ".join(str(ROLE_CODE[name]) for name in NAMING)

#: The stats in their output order.
STATS = [
    "pass_attempts", "completions", "passing_yards", "passing_tds", "interceptions", "passing_two_pt",
    "rush_attempts", "rushing_yards", "rushing_tds", "rushing_two_pt",
    "targets", "receptions", "receiving_yards", "receiving_tds", "air_yards", "yards_after_catch", "receiving_two_pt",
    "fumbles", "fumbles_lost", "fumble_recovery_tds",
    "fg_made_0_19", "fg_made_20_29", "fg_made_30_39", "fg_made_40_49", "fg_made_50_59", "fg_made_60_plus",
    "fg_missed", "pat_made", "pat_missed",
]


# ---------------------------------------------------------------- one role


def role_box(plays: DataFrame, role_name: str) -> DataFrame:
    """Aggregate of one role; a sum over nulls only stays null."""
    role = ROLES[role_name]
    naming = [F.col(role.player).alias("player_id")]
    if role.name:
        naming = ["team", *naming, F.col(role.name).alias("player_name")]
    return (
        plays.where(f"{role.player} IS NOT NULL")
        .groupBy("season", "week", *naming)
        .agg(
            *[F.expr(f"count_if({condition}) AS {metric}") for metric, condition in role.counts.items()],
            *[F.expr(f"sum({column}) AS {metric}") for metric, column in role.sums.items()],
        )
    )


# ------------------------------------------------------------- all roles


def _credits(plays: DataFrame, role_names: list[str]) -> DataFrame:
    """One row per play and credited player: the play's columns plus role, player_id, player_name.

    Only role codes are unnested; id and name are picked afterwards, so that no
    struct is built per play and role.
    """
    credited = ", ".join(f"CASE WHEN {ROLES[n].player} IS NOT NULL THEN {ROLE_CODE[n]} END" for n in role_names)
    players = " ".join(f"WHEN {ROLE_CODE[n]} THEN {ROLES[n].player}" for n in role_names)
    names = " ".join(f"WHEN {ROLE_CODE[n]} THEN {ROLES[n].name}" for n in role_names if ROLES[n].name)
    return (
        plays.selectExpr("*", f"explode(array({credited})) AS role")
        .where("role IS NOT NULL")
        .selectExpr("*", f"CASE role {players} END AS player_id", f"CASE role {names} END AS player_name")
    )


def player_keys(plays: DataFrame) -> DataFrame:
    """Distinct (season, week, team, player_id, player_name) over the four naming roles.

    One scan; the distinct has a map-side partial step.
    """
    return _credits(plays, NAMING).select(*KEY_COLUMNS).distinct()


def credit_lines(plays: DataFrame) -> DataFrame:
    """One row per (season, week, player_id, role, team, player_name) with the role's metrics.

    All six roles come out of a single scan and a single shuffle.  The roles
    share generic metric slots, so the shuffled row is as wide as the widest
    role, not as the sum of the roles, and the aggregate keeps a fixed-width
    buffer (hash aggregation with map-side combine).  The two fumble roles have
    no team and no name of their own and are grouped per player and week.
    """

    def by_role(slot: str) -> list[tuple[int, str]]:
        """(role code, condition or column) of every role that uses a slot."""
        found = []
        for name, role in ROLES.items():
            sources = {**role.counts, **role.sums}
            found += [(ROLE_CODE[name], sources[metric]) for metric, s in role.slots.items() if s == slot]
        return found

    slots = sorted({slot for role in ROLES.values() for slot in role.slots.values()})
    metrics = []
    for slot in slots:
        cases = " ".join(f"WHEN {code} THEN {source}" for code, source in by_role(slot))
        value = f"CASE role {cases} END"
        metrics.append(f"CASE WHEN {value} THEN 1 ELSE 0 END AS {slot}" if slot[0] == "n" else f"{value} AS {slot}")

    return (
        _credits(plays, list(ROLES))
        .selectExpr(
            *WEEK_KEYS,
            "role",
            f"CASE WHEN role IN ({NAMING_CODES}) THEN team END AS team",
            "player_name",
            *metrics,
        )
        .groupBy(*WEEK_KEYS, "role", *NAME_KEYS)
        .agg(F.expr("count(*) AS plays"), *[F.expr(f"sum({slot}) AS {slot}") for slot in slots])
    )


def _finish(df: DataFrame, scoring: Mapping[str, float]) -> DataFrame:
    """Null stats become 0; keys, stats and score in output order."""
    return df.selectExpr(*KEY_COLUMNS, *[f"coalesce({stat}, 0) AS {stat}" for stat in STATS]).select(
        "*", fantasy_points(scoring).alias("fantasy_points")
    )


def _listings(plays: DataFrame) -> DataFrame:
    """One row per (season, week, player_id, team, player_name), all roles side by side.

    ``listed`` counts the plays in naming roles and is null for the row that
    holds only fumbles; ``in_<role>`` counts the plays of one naming role.  The
    lines are shuffled by player-week once, which also serves whatever is
    grouped by player-week afterwards.
    """
    return (
        credit_lines(plays)
        .repartition(*WEEK_KEYS)
        .groupBy(*WEEK_KEYS, *NAME_KEYS)
        .agg(
            F.expr(f"sum(CASE WHEN role IN ({NAMING_CODES}) THEN plays END) AS listed"),
            *[F.expr(f"sum(CASE WHEN role = {ROLE_CODE[name]} THEN plays END) AS in_{name}") for name in NAMING],
            *[
                F.expr(f"sum(CASE WHEN role = {ROLE_CODE[name]} THEN {slot} END) AS {metric}")
                for name, role in ROLES.items()
                for metric, slot in role.slots.items()
            ],
        )
    )


def player_game_stats(plays: DataFrame, scoring: Mapping[str, float] = DEFAULT_SCORING) -> DataFrame:
    """Box score and fantasy score per (season, week, team, player_id, player_name).

    The result is that of joining the distinct keys with the six role
    aggregates on (season, week, player_id): a player listed under several
    (team, name) pairs in a week gets every pairing, and a player who only
    fumbled or recovered gets none.  It is computed without those joins, in one
    scan and two shuffles.  A player listed once, the usual case, keeps the
    metrics of that row.  Only for a player listed several times in a week are
    the rows of a role gathered and unnested against each other.

    What is gathered is bounded by the result: k rows of a role belong to at
    least k listings and so stand for at least k * k result rows.  Plays
    themselves are never gathered.
    """
    player_week = "(PARTITION BY season, week, player_id)"
    nameless = [metric for role in ROLES.values() if not role.name for metric in role.slots]
    listings = _listings(plays)
    counted = listings.selectExpr(
        *[column for column in listings.columns if column not in nameless],
        f"count(listed) OVER {player_week} AS listings",
        *[f"sum({metric}) OVER {player_week} AS {metric}" for metric in nameless],
    ).where("listed IS NOT NULL")

    gathered = []
    for name in NAMING:
        row = ", ".join(f"{metric} AS each_{metric}" for metric in ROLES[name].slots)
        gathered.append(
            f"collect_list(CASE WHEN listings > 1 AND in_{name} > 0 THEN struct({row}) END) "
            f"OVER {player_week} AS all_{name}"
        )
    paired = counted.selectExpr("*", *gathered)
    for name in NAMING:
        paired = paired.selectExpr("*", f"inline_outer(all_{name})")
    stats = [
        f"coalesce(each_{metric}, CASE WHEN listings = 1 THEN {metric} END) AS {metric}"
        for name in NAMING
        for metric in ROLES[name].slots
    ]
    return _finish(paired.selectExpr(*KEY_COLUMNS, *nameless, *stats), scoring)


def player_game_stats_by_joins(plays: DataFrame, scoring: Mapping[str, float] = DEFAULT_SCORING) -> DataFrame:
    """The same result stated as joins; used to check :func:`player_game_stats`."""
    result = player_keys(plays)
    for name, role in ROLES.items():
        result = result.join(role_box(plays, name).drop(*(NAME_KEYS if role.name else [])), WEEK_KEYS, "left")
    return _finish(result, scoring)


def player_game_stats_by_player(plays: DataFrame, scoring: Mapping[str, float] = DEFAULT_SCORING) -> DataFrame:
    """One row per (season, week, player_id): stats summed over all (team, name) pairs.

    Team and name are those of the pair with most plays, ties going to the
    smaller name, then team.  All steps are aggregates with map-side combine.
    """
    # min over structs: most plays first, then name, then team.
    best = F.expr("min(CASE WHEN listed > 0 THEN struct(-listed AS rank, player_name, team) END) AS best")
    players = _listings(plays).groupBy(*WEEK_KEYS).agg(best, *[F.expr(f"sum({stat}) AS {stat}") for stat in STATS])
    return _finish(players.where("best IS NOT NULL").select("*", "best.team", "best.player_name"), scoring)
