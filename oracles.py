"""SQL statements of the registered queries, for checking Spark's results in another engine.

Written as plain joins, filters and windows over the derived inputs, without
looking at how the Spark side computes them.
"""

from __future__ import annotations

import re

from gridiron import fixtures

SEASON = 2000
WEEKS = (3, 15)
MIN_GAMES = 3
#: A season without rows.
NO_SEASON = 1900

_RIGHT = "two_point_attempt = 1 AND two_point_conv_result = 'success'"
_MADE = "field_goal_attempt = 1 AND field_goal_result = 'made'"


def _n(condition: str, name: str) -> str:
    return f"CAST(count(CASE WHEN {condition} THEN 1 END) AS BIGINT) AS {name}"


#: role -> (player column, name column, aggregates)
_ROLES: dict[str, tuple[str, str | None, list[str]]] = {
    "passing": (
        "passer_player_id",
        "passer_player_name",
        [
            _n("pass_attempt = 1", "pass_attempts"),
            _n("complete_pass = 1", "completions"),
            "sum(passing_yards) AS passing_yards",
            _n("pass_touchdown = 1", "passing_tds"),
            _n("interception = 1", "interceptions"),
            _n(_RIGHT, "passing_two_pt"),
        ],
    ),
    "rushing": (
        "rusher_player_id",
        "rusher_player_name",
        [
            _n("rush_attempt = 1", "rush_attempts"),
            "sum(rushing_yards) AS rushing_yards",
            _n("rush_touchdown = 1", "rushing_tds"),
            _n(_RIGHT, "rushing_two_pt"),
        ],
    ),
    "receiving": (
        "receiver_player_id",
        "receiver_player_name",
        [
            _n("pass_attempt = 1", "targets"),
            _n("complete_pass = 1", "receptions"),
            "sum(receiving_yards) AS receiving_yards",
            _n("pass_touchdown = 1 AND complete_pass = 1", "receiving_tds"),
            "sum(air_yards) AS air_yards",
            "sum(yards_after_catch) AS yards_after_catch",
            _n(_RIGHT, "receiving_two_pt"),
        ],
    ),
    "fumbling": (
        "fumbled_1_player_id",
        None,
        [_n("fumble = 1", "fumbles"), _n("fumble_lost = 1", "fumbles_lost")],
    ),
    "recovering": (
        "fumble_recovery_1_player_id",
        None,
        [_n("return_touchdown = 1", "fumble_recovery_tds")],
    ),
    "kicking": (
        "kicker_player_id",
        "kicker_player_name",
        [
            _n(f"{_MADE} AND kick_distance < 20", "fg_made_0_19"),
            _n(f"{_MADE} AND kick_distance >= 20 AND kick_distance <= 29", "fg_made_20_29"),
            _n(f"{_MADE} AND kick_distance >= 30 AND kick_distance <= 39", "fg_made_30_39"),
            _n(f"{_MADE} AND kick_distance >= 40 AND kick_distance <= 49", "fg_made_40_49"),
            _n(f"{_MADE} AND kick_distance >= 50 AND kick_distance <= 59", "fg_made_50_59"),
            _n(f"{_MADE} AND kick_distance >= 60", "fg_made_60_plus"),
            _n("field_goal_attempt = 1 AND field_goal_result <> 'made'", "fg_missed"),
            _n("extra_point_attempt = 1 AND extra_point_result = 'good'", "pat_made"),
            _n("extra_point_attempt = 1 AND extra_point_result <> 'good'", "pat_missed"),
        ],
    ),
}

_STATS = [re.search(r" AS (\w+)$", a).group(1) for _, _, aggs in _ROLES.values() for a in aggs]

_POINTS = """round(passing_yards * CAST(0.04 AS DOUBLE) + passing_tds * 4 - interceptions + passing_two_pt * 2
    + rushing_yards * CAST(0.1 AS DOUBLE) + rushing_tds * 6 + rushing_two_pt * 2
    + receiving_yards * CAST(0.1 AS DOUBLE) + receptions * CAST(0.5 AS DOUBLE)
    + receiving_tds * 6 + receiving_two_pt * 2
    - fumbles - fumbles_lost + fumble_recovery_tds * 6
    + fg_made_0_19 * 3 + fg_made_20_29 * 3 + fg_made_30_39 * 3 + fg_made_40_49 * 4
    + fg_made_50_59 * 5 + fg_made_60_plus * 6 - fg_missed + pat_made - pat_missed, 2)"""


def _role_sql(role: str) -> str:
    player, name, aggs = _ROLES[role]
    keys = ["season", "week", f"{player} AS player_id"]
    if name:
        keys += ["team", f"{name} AS player_name"]
    return f"SELECT {', '.join(keys + aggs)} FROM pps WHERE {player} IS NOT NULL GROUP BY ALL"


def _box_sql() -> str:
    joins = " ".join(
        f"LEFT JOIN {r} ON {r}.player_id = pk.player_id AND {r}.season = pk.season AND {r}.week = pk.week"
        for r in _ROLES
    )
    stats = ", ".join(f"coalesce({s}, 0) AS {s}" for s in _STATS)
    return f"SELECT pk.season, pk.week, pk.team, pk.player_id, pk.player_name, {stats} FROM pk {joins}"


def _by_player_sql() -> str:
    """Each role summed over its (team, name) pairs; the name comes from the pair with most plays."""
    naming = [(p, n) for p, n, _ in _ROLES.values() if n]
    credited = " UNION ALL ".join(
        f"SELECT season, week, {p} AS player_id, team, {n} AS player_name FROM pps WHERE {p} IS NOT NULL"
        for p, n in naming
    )
    sums = []
    for role, (player, _, aggs) in _ROLES.items():
        keys = f"season, week, {player} AS player_id"
        sums.append(
            f"t_{role} AS (SELECT {keys}, {', '.join(aggs)} FROM pps WHERE {player} IS NOT NULL GROUP BY ALL)"
        )
    joins = " ".join(f"LEFT JOIN t_{r} USING (season, week, player_id)" for r in _ROLES)
    stats = ", ".join(f"coalesce({s}, 0) AS {s}" for s in _STATS)
    return f"""
        WITH credited AS ({credited}),
        pairs AS (SELECT season, week, player_id, team, player_name, count(*) AS n FROM credited GROUP BY ALL),
        named AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY season, week, player_id
                  ORDER BY n DESC, player_name ASC NULLS FIRST, team ASC NULLS FIRST) AS rn FROM pairs) WHERE rn = 1),
        {', '.join(sums)}
        SELECT season, week, team, player_id, player_name, {stats} FROM named {joins}"""


def _tables() -> dict[str, str]:
    tables = dict(fixtures.sql_tables())
    tables["pps"] = (
        "SELECT * EXCLUDE (posteam, defteam, play_type, yards_gained, epa), posteam AS team "
        "FROM plays WHERE play_type IS NOT NULL"
    )
    for role in _ROLES:
        tables[role] = _role_sql(role)
    tables["pk"] = " UNION ".join(
        f"SELECT season, week, team, player_id, player_name FROM {r}" for r, (_, name, _) in _ROLES.items() if name
    )
    tables["box"] = _box_sql()
    tables["stats"] = f"SELECT *, {_POINTS} AS fantasy_points FROM box"
    tables["status"] = """
        SELECT r.season, r.week, r.team, r.player_id, r.sleeper_id, r.player_name, r.position, r.status,
               l.roster_id, l.owner_name, l.is_my_roster, l.wins, l.losses
        FROM rosters AS r LEFT JOIN league AS l ON r.sleeper_id = l.sleeper_id"""
    tables["attrs"] = """
        SELECT player_id, roster_id, owner_name, is_my_roster, position
        FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY season NULLS FIRST, week NULLS FIRST,
                  team NULLS FIRST, roster_id NULLS FIRST, owner_name NULLS FIRST, is_my_roster NULLS FIRST,
                  position NULLS FIRST) AS rn
              FROM status WHERE player_id IS NOT NULL)
        WHERE rn = 1"""
    tables["owned"] = """
        SELECT s.*, a.roster_id, a.owner_name, a.is_my_roster, a.position
        FROM stats AS s LEFT JOIN attrs AS a ON s.player_id = a.player_id
        WHERE a.position IS DISTINCT FROM 'K'"""
    tables["base"] = """
        SELECT *, CASE WHEN team IS NOT NULL
            THEN CAST(sum(targets) OVER (PARTITION BY season, week, team) AS BIGINT) END AS team_targets
        FROM owned"""
    tables["mine"] = f"SELECT * FROM base WHERE season = {SEASON} AND is_my_roster"
    tables["mine_weeks"] = f"SELECT * FROM mine WHERE week BETWEEN {WEEKS[0]} AND {WEEKS[1]}"
    cents = "sum(CAST(round(fantasy_points * 100) AS BIGINT)) / CAST(100 AS DOUBLE)"
    tables["totals"] = f"""
        SELECT *, round_even(targets / nullif(team_targets, 0) * 100, 1) AS target_share_pct
        FROM (SELECT player_name, position,
                   count(DISTINCT week) AS games,
                   {cents} AS fantasy_points,
                   CAST(sum(targets) AS BIGINT) AS targets,
                   CAST(coalesce(sum(team_targets), 0) AS BIGINT) AS team_targets,
                   CAST(sum(receptions) AS BIGINT) AS receptions,
                   sum(receiving_yards) AS receiving_yards,
                   sum(rushing_yards) AS rushing_yards,
                   sum(passing_yards) AS passing_yards,
                   CAST(sum(passing_tds) AS BIGINT) AS total_tds
            FROM mine_weeks
            WHERE player_name IS NOT NULL AND position IS NOT NULL
            GROUP BY player_name, position)"""
    return tables


_TABLES = _tables()


#: The landed inputs in place of the whole ones.
_LANDED = {
    "all_plays": _TABLES["plays"],
    "all_rosters": _TABLES["rosters"],
    "all_league": _TABLES["league"].replace("FROM rosters", "FROM all_rosters"),
    **_TABLES,
    "plays": _TABLES["plays_landed"].replace("FROM plays", "FROM all_plays"),
    "rosters": _TABLES["rosters_landed"].replace("FROM rosters", "FROM all_rosters"),
    "league": _TABLES["league_landed"].replace("FROM league", "FROM all_league"),
}


def _with(select: str, tables: dict[str, str] | None = None) -> str:
    """Put the tables that a statement uses, directly or not, in front of it as CTEs."""
    tables, needed = tables or _TABLES, set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", text)) & tables.keys():
            if name not in needed:
                needed.add(name)
                visit(tables[name])

    visit(select)
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in tables.items() if name in needed)
    return f"WITH {ctes}\n{select}" if ctes else select


def _tiles(position: str | None) -> str:
    """Tiles of the player on my roster with the smallest id of a position; RB2-T15 has none."""
    if position is None:
        chosen = "SELECT min(player_name) AS player_name FROM mine_weeks WHERE player_id = 'RB2-T15'"
    else:
        chosen = (
            f"SELECT player_name FROM mine_weeks WHERE position = '{position}' ORDER BY player_id, player_name LIMIT 1"
        )
    # fixed values: labels and stats of the tiles
    per_position = {
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
        None: [
            ("Targets", "targets"),
            ("Receiving Yards", "receiving_yards"),
            ("Rushing Yards", "rushing_yards"),
        ],
    }
    parts = []
    for pos, tiles in per_position.items():
        for i, (label, stat) in enumerate(tiles):
            condition = f"pos = '{pos}'" if pos else "coalesce(pos, '') NOT IN ('QB', 'RB', 'WR', 'TE')"
            parts.append(
                f"SELECT CAST({i} AS INTEGER) AS tile, '{label}' AS label, "
                f"CAST((SELECT trunc(coalesce(sum({stat}), 0)) FROM picked) AS BIGINT) AS value "
                f"FROM first_position WHERE {condition}"
            )
    return _with(
        f"SELECT * FROM (WITH chosen AS ({chosen}), "
        "picked AS (SELECT * FROM mine_weeks WHERE player_name IN (SELECT player_name FROM chosen)), "
        "first_position AS (SELECT (SELECT position FROM picked ORDER BY week, position NULLS FIRST LIMIT 1) AS pos) "
        f"{' UNION ALL '.join(parts)})"
    )


_BOARD = {
    "qb": ["pass_attempts", "completions", "passing_yards", "passing_tds", "interceptions"],
    "rb": ["rush_attempts", "rushing_yards", "rushing_tds", "targets", "receiving_yards"],
    "wr": ["targets", "receptions", "receiving_yards", "receiving_tds"],
    "te": ["targets", "receptions", "receiving_yards", "receiving_tds"],
}
#: The board of a position without a list of its own.
_BOARD_FALLBACK = ["targets", "rushing_yards", "receiving_yards"]
_FULLBACKS = "(SELECT * REPLACE (CASE WHEN player_id LIKE 'RB2-%' THEN 'FB' ELSE position END AS position) FROM base)"


def _board(pool: str, position: str) -> str:
    stats = _BOARD.get(position, _BOARD_FALLBACK)
    extra = ", ".join(
        f"sum({s}) AS {s}" if s.endswith("yards") else f"CAST(sum({s}) AS BIGINT) AS {s}" for s in stats
    )
    share = (
        ", round_even(targets / nullif(team_targets, 0) * 100, 1) AS target_share_pct" if "targets" in stats else ""
    )
    condition = {
        "waiver": "owner_name IS NULL",
        "trade": "owner_name IS NOT NULL AND is_my_roster IS DISTINCT FROM true",
    }[pool]
    return _with(
        f"""
        SELECT * EXCLUDE (avg_points), round_even(avg_points, 2) AS avg_fantasy_points{share}
        FROM (SELECT *, total_fantasy_points / n AS avg_points
              FROM (SELECT player_name, position, team, coalesce(owner_name, 'Free Agent') AS owner_name,
                           count(DISTINCT week) AS games,
                           sum(CAST(round(fantasy_points * 100) AS BIGINT)) / CAST(100 AS DOUBLE) AS total_fantasy_points,
                           count(*) AS n,
                           CAST(sum(team_targets) AS BIGINT) AS team_targets, {extra}
                    FROM {"base" if position in _BOARD else _FULLBACKS}
                    WHERE season = {SEASON} AND {condition} AND position = '{position.upper()}'
                      AND player_name IS NOT NULL AND team IS NOT NULL
                    GROUP BY 1, 2, 3, 4))
        WHERE games >= {MIN_GAMES}"""
    ).replace("* EXCLUDE (avg_points)", "* EXCLUDE (avg_points, n)")


def _quality(tables: dict[str, str] | None = None, unread: str = "") -> str:
    checks = [
        ("stg_pbp", "(SELECT * FROM plays WHERE play_type IS NOT NULL AND posteam IS NOT NULL)", [("game_id", "error"), ("play_type", "error")]),
        ("stg_rosters", "rosters", [("player_id", "warn"), ("team", "error")]),
        ("stg_sleeper_rosters", "league", [("roster_id", "error"), ("sleeper_id", "error")]),
        ("stg_pbp_player_stats", "pps", [("game_id", "error")]),
        (
            "fct_team_week_epa",
            "(SELECT season, posteam AS team, week, count(*) AS plays FROM plays "
            "WHERE play_type IS NOT NULL AND posteam IS NOT NULL GROUP BY ALL)",
            [("team", "error"), ("week", "error"), ("plays", "error")],
        ),
        ("fct_player_week", "rosters", [("player_id", "warn"), ("week", "error"), ("sleeper_id", "warn")]),
        ("fct_player_roster_status", "status", [("player_id", "warn"), ("week", "error")]),
        ("fct_player_game_stats", "stats", [("player_id", "error"), ("week", "error"), ("fantasy_points", "error")]),
    ]
    return _with(
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{severity}' AS severity, "
            f"count(*) - count({column}) AS failures FROM {source}"
            for table, source, columns in checks
            for column, severity in columns
        )
        + unread,
        tables,
    )


def _unread() -> str:
    """The report's rows of seasons that could not be read."""
    return "".join(
        f" UNION ALL SELECT 'raw.{table}', 'season={season}', 'warn', 1"
        for table in ("pbp", "rosters")
        for season in (min(fixtures.LANDED_SEASONS), fixtures.DAMAGED_SEASON)
    )


def oracle_sql() -> dict[str, str]:
    statements = {
        "stg_pbp": _with(
            "SELECT season, game_id, week, posteam AS possession_team, defteam AS defense_team, play_type, "
            "yards_gained, epa FROM plays WHERE play_type IS NOT NULL AND posteam IS NOT NULL"
        ),
        "stg_pbp_without_no_play": _with(
            "SELECT season, game_id, week, posteam AS possession_team, defteam AS defense_team, play_type, "
            "yards_gained, epa FROM plays WHERE posteam IS NOT NULL AND play_type <> 'no_play'"
        ),
        "stg_pbp_player_stats": _with("SELECT * FROM pps"),
        "stg_rosters": _with("SELECT * FROM rosters"),
        "stg_league_rosters": _with("SELECT * FROM league"),
        "season_union": _with(
            "SELECT season, week, game_id, posteam, play_type, yards_gained, "
            "CASE WHEN season % 2 = 1 THEN epa END AS epa, CASE WHEN season % 2 = 0 THEN air_yards END AS air_yards "
            "FROM plays"
        ),
        "team_week_epa": _with(
            "SELECT season, posteam AS team, week, count(*) AS plays, avg(epa) AS avg_epa FROM plays "
            "WHERE play_type IS NOT NULL AND posteam IS NOT NULL GROUP BY season, posteam, week"
        ),
        "player_passing": _with("SELECT * FROM passing"),
        "player_rushing": _with("SELECT * FROM rushing"),
        "player_receiving": _with("SELECT * FROM receiving"),
        "player_fumbles": _with("SELECT * FROM fumbling"),
        "player_fumble_recovery_tds": _with("SELECT * FROM recovering"),
        "player_kicking": _with("SELECT * FROM kicking"),
        "player_keys": _with("SELECT * FROM pk"),
        "player_game_stats": _with("SELECT * FROM stats"),
        "player_game_stats_by_player": _with(f"SELECT *, {_POINTS} AS fantasy_points FROM ({_by_player_sql()})"),
        "player_week": _with(
            "SELECT season, week, team, player_id, sleeper_id, player_name, position, status, years_exp, "
            "draft_number, age FROM rosters"
        ),
        "player_roster_status": _with("SELECT * FROM status"),
        "player_week_base": _with("SELECT * FROM base"),
        "seasons": _with("SELECT DISTINCT season FROM base ORDER BY season DESC"),
        "available_weeks": _with("SELECT DISTINCT week FROM mine ORDER BY week"),
        "week_bounds": _with("SELECT min(week) AS min_week, max(week) AS max_week FROM mine"),
        "my_roster_totals": _with("SELECT * FROM totals ORDER BY fantasy_points DESC, player_name, position"),
        "my_roster_totals_all_tds": _with(
            "SELECT t.*, a.all_tds FROM totals AS t JOIN (SELECT player_name, position, "
            "CAST(sum(passing_tds + rushing_tds + receiving_tds) AS BIGINT) AS all_tds "
            "FROM mine_weeks GROUP BY ALL) AS a USING (player_name, position) "
            "ORDER BY fantasy_points DESC, player_name, position"
        ),
        "player_trend": _with(
            "SELECT week, fantasy_points FROM mine_weeks WHERE player_name = (SELECT player_name FROM totals "
            "ORDER BY fantasy_points DESC, player_name, position LIMIT 1) ORDER BY week, fantasy_points"
        ),
        "quality_report": _quality(),
        "tiles_fallback": _tiles(None),
        "waiver_fallback": _board("waiver", "fb"),
        "trade_fallback": _board("trade", "fb"),
        "my_roster_totals_no_season": _with("SELECT * FROM totals WHERE false"),
        "landed_plays": _with(
            "SELECT season, week, game_id, posteam, play_type, yards_gained, "
            "CASE WHEN season % 2 = 1 OR week % 2 = 0 THEN epa END AS epa, "
            "CASE WHEN season % 2 = 0 THEN air_yards END AS air_yards FROM plays_landed"
        ),
        "landed_rosters": _with("SELECT * FROM rosters_landed"),
        "landed_league": _with("SELECT * FROM league_landed"),
        "weekly_run_report": _quality(_LANDED, _unread()),
        "weekly_run_staging": _with(
            "SELECT season, game_id, week, posteam AS possession_team, defteam AS defense_team, play_type, "
            "yards_gained, epa FROM plays WHERE play_type IS NOT NULL AND posteam IS NOT NULL",
            _LANDED,
        ),
        "weekly_run_base": _with("SELECT * FROM base", _LANDED),
    }
    for position in _BOARD:
        statements[f"tiles_{position}"] = _tiles(position.upper())
        for pool in ("waiver", "trade"):
            statements[f"{pool}_{position}"] = _board(pool, position)
    return statements
