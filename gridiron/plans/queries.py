"""Queries over the two player marts: own roster, trend, tiles, waiver and trade boards.

All functions take and return lazy DataFrames; call them with
``spark.table("marts.fct_player_game_stats")`` and
``spark.table("marts.fct_player_roster_status")`` or with anything of that shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridiron.functions.numbers import percent, round_half_even, sum_cents
from gridiron.operators.boxscore import KEY_COLUMNS, STATS

HIDDEN_POSITION = "K"
FREE_AGENT = "Free Agent"
DEFAULT_MIN_GAMES = 3
TEAM_WEEK = ["season", "week", "team"]

#: Stats shown per position, with their labels; the default is for any other position.
POSITION_METRICS: dict[str, list[tuple[str, str]]] = {
    "QB": [
        ("Pass Attempts", "pass_attempts"),
        ("Completions", "completions"),
        ("Passing Yards", "passing_yards"),
        ("Passing TDs", "passing_tds"),
        ("Interceptions", "interceptions"),
    ],
    "RB": [
        ("Rush Attempts", "rush_attempts"),
        ("Rushing Yards", "rushing_yards"),
        ("Rushing TDs", "rushing_tds"),
        ("Targets", "targets"),
        ("Receiving Yards", "receiving_yards"),
    ],
    "WR": [
        ("Targets", "targets"),
        ("Receptions", "receptions"),
        ("Receiving Yards", "receiving_yards"),
        ("Receiving TDs", "receiving_tds"),
    ],
    "TE": [
        ("Targets", "targets"),
        ("Receptions", "receptions"),
        ("Receiving Yards", "receiving_yards"),
        ("Receiving TDs", "receiving_tds"),
    ],
}
DEFAULT_TILES = [
    ("Targets", "targets"),
    ("Receiving Yards", "receiving_yards"),
    ("Rushing Yards", "rushing_yards"),
]
DEFAULT_BOARD_STATS = ["targets", "rushing_yards", "receiving_yards"]


# ------------------------------------------------------------------ base


def first_attributes(status: DataFrame) -> DataFrame:
    """Owner and position of every player, from the earliest (season, week, team) row.

    A minimum over structs: partial aggregation keeps one row per player and
    task, so a player with very many rows is no hot spot.  Remaining ties are
    broken by the attributes themselves, nulls first.
    """
    return (
        status.where(F.col("player_id").isNotNull())
        .groupBy("player_id")
        .agg(
            F.min(
                F.struct("season", "week", "team", "roster_id", "owner_name", "is_my_roster", "position")
            ).alias("first")
        )
        .select("player_id", "first.roster_id", "first.owner_name", "first.is_my_roster", "first.position")
    )


def player_week_base(stats: DataFrame, status: DataFrame) -> DataFrame:
    """The base of all user queries, from box scores and roster status."""
    return with_attributes(stats, first_attributes(status))


def with_attributes(stats: DataFrame, attributes: DataFrame) -> DataFrame:
    """Box scores with owner, position and the team's targets of that week; kickers hidden.

    ``attributes`` has one row per player, see :func:`first_attributes`.

    A null position is not a kicker and stays.  The team total is aggregated
    and joined back rather than computed over a window: a window would sort a
    hot team-week in one task, while an aggregate combines map-side and the
    join can be split.  Rows without a team get a null total.
    """
    owned = stats.join(attributes, "player_id", "left").where(
        ~F.col("position").eqNullSafe(F.lit(HIDDEN_POSITION))
    )
    team_targets = (
        owned.where(F.col("team").isNotNull()).groupBy(*TEAM_WEEK).agg(F.sum("targets").alias("team_targets"))
    )
    return owned.join(team_targets, TEAM_WEEK, "left").select(
        *KEY_COLUMNS,
        *STATS,
        "fantasy_points",
        "roster_id",
        "owner_name",
        "is_my_roster",
        "position",
        "team_targets",
    )


def seasons(base: DataFrame) -> DataFrame:
    """Seasons, newest first; the first is the default choice."""
    return base.select("season").distinct().orderBy(F.desc("season"))


# ------------------------------------------------------------- my roster


def my_rows(base: DataFrame, season: int, weeks: tuple[int, int] | None = None) -> DataFrame:
    """Rows of my roster in a season and, if given, a week range with both ends included."""
    rows = base.where((F.col("season") == season) & F.col("is_my_roster").eqNullSafe(True))
    return rows if weeks is None else rows.where(F.col("week").between(*weeks))


def available_weeks(rows: DataFrame) -> DataFrame:
    return rows.select("week").distinct().orderBy("week")


def week_bounds(rows: DataFrame) -> DataFrame:
    """First and last week present: the default week range."""
    return rows.agg(F.min("week").alias("min_week"), F.max("week").alias("max_week"))


def my_roster_totals(rows: DataFrame, all_tds: bool = False) -> DataFrame:
    """Totals per (player_name, position) of :func:`my_rows`, best score first.

    Rows without name or position are left out.  ``total_tds`` counts passing
    touchdowns only; ``all_tds`` adds a column with rushing and receiving ones.
    """
    keys = ["player_name", "position"]
    extra = [F.sum(F.col("passing_tds") + F.col("rushing_tds") + F.col("receiving_tds")).alias("all_tds")]
    totals = (
        rows.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.countDistinct("week").alias("games"),
            sum_cents(F.col("fantasy_points")).alias("fantasy_points"),
            F.sum("targets").alias("targets"),
            F.coalesce(F.sum("team_targets"), F.lit(0)).alias("team_targets"),
            F.sum("receptions").alias("receptions"),
            F.sum("receiving_yards").alias("receiving_yards"),
            F.sum("rushing_yards").alias("rushing_yards"),
            F.sum("passing_yards").alias("passing_yards"),
            F.sum("passing_tds").alias("total_tds"),
            *(extra if all_tds else []),
        )
    )
    return totals.withColumn("target_share_pct", percent(F.col("targets"), F.col("team_targets"))).orderBy(
        F.desc("fantasy_points"), *keys
    )


def top_player_name(totals: DataFrame) -> DataFrame:
    """One row with the first player of the totals: the default choice of the trend view."""
    return totals.orderBy(F.desc("fantasy_points"), "player_name", "position").limit(1).select("player_name")


def rows_of_player(rows: DataFrame, player: str | DataFrame) -> DataFrame:
    """Rows of a player given by name, or by a one-row DataFrame holding ``player_name``.

    The DataFrame form keeps the choice of the player inside the query; it is
    broadcast because it has exactly one row.
    """
    if isinstance(player, DataFrame):
        return rows.join(F.broadcast(player.select("player_name").limit(1)), "player_name", "left_semi")
    return rows.where(F.col("player_name") == player)


def player_trend(rows: DataFrame, player: str | DataFrame) -> DataFrame:
    """Fantasy points by week of one player."""
    return rows_of_player(rows, player).select("week", "fantasy_points").orderBy("week", "fantasy_points")


def position_tiles(rows: DataFrame, player: str | DataFrame) -> DataFrame:
    """Summed stats of one player as (tile, label, value), chosen by the position of the first week.

    Values are cut to whole numbers.  An unlisted or missing position shows the
    default stats.
    """
    shown = sorted({stat for tiles in [*POSITION_METRICS.values(), DEFAULT_TILES] for _, stat in tiles})
    sums = rows_of_player(rows, player).agg(
        F.min(F.struct("week", "position"))["position"].alias("position"),
        *[F.coalesce(F.sum(stat), F.lit(0)).cast("long").alias(stat) for stat in shown],
    )

    def tile_array(tiles: list[tuple[str, str]]) -> Column:
        return F.array(*[F.struct(F.lit(label).alias("label"), F.col(stat).alias("value")) for label, stat in tiles])

    chosen = F.when(F.lit(False), tile_array(DEFAULT_TILES))
    for position, tiles in POSITION_METRICS.items():
        chosen = chosen.when(F.col("position") == position, tile_array(tiles))
    return (
        sums.select(F.posexplode(chosen.otherwise(tile_array(DEFAULT_TILES))).alias("tile", "entry"))
        .select("tile", "entry.label", "entry.value")
        .orderBy("tile")
    )


# ---------------------------------------------------- waiver and trade boards


def unrostered(base: DataFrame, season: int) -> DataFrame:
    """Rows of players without an owner."""
    return base.where((F.col("season") == season) & F.col("owner_name").isNull())


def on_other_rosters(base: DataFrame, season: int) -> DataFrame:
    """Rows of players that someone else owns."""
    return base.where(
        (F.col("season") == season) & F.col("owner_name").isNotNull() & ~F.col("is_my_roster").eqNullSafe(True)
    )


def leaderboard(pool: DataFrame, position: str, min_games: int = DEFAULT_MIN_GAMES) -> DataFrame:
    """Players of a position with at least ``min_games`` weeks, best mean score first.

    A missing owner is named before grouping; rows lacking another key are left
    out.  Boards whose stats hold targets also get the target share.
    """
    keys = ["player_name", "position", "team", "owner_name"]
    stats = [s for _, s in POSITION_METRICS[position]] if position in POSITION_METRICS else DEFAULT_BOARD_STATS
    points = sum_cents(F.col("fantasy_points"))
    board = (
        pool.where(F.col("position") == position)
        .withColumn("owner_name", F.coalesce("owner_name", F.lit(FREE_AGENT)))
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.countDistinct("week").alias("games"),
            points.alias("total_fantasy_points"),
            round_half_even(points / F.count("fantasy_points"), 2).alias("avg_fantasy_points"),
            F.sum("team_targets").alias("team_targets"),
            *[F.sum(stat).alias(stat) for stat in stats],
        )
    )
    if "targets" in stats:
        board = board.withColumn("target_share_pct", percent(F.col("targets"), F.col("team_targets")))
    return board.where(F.col("games") >= min_games).orderBy(F.desc("avg_fantasy_points"), *keys)


def waiver_leaderboard(
    base: DataFrame, season: int, position: str, min_games: int = DEFAULT_MIN_GAMES
) -> DataFrame:
    return leaderboard(unrostered(base, season), position, min_games)


def trade_leaderboard(
    base: DataFrame, season: int, position: str, min_games: int = DEFAULT_MIN_GAMES
) -> DataFrame:
    return leaderboard(on_other_rosters(base, season), position, min_games)
