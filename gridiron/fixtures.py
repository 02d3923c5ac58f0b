"""Football inputs derived from the generic test tables ``lineitem`` and ``customer``.

The expressions are written in the subset that Spark SQL and other SQL engines
share, so the same derivation serves the Spark queries and their SQL checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridiron.sources.league import UNKNOWN_OWNER

MY_USER_ID = "0"


def _flag(condition: str) -> str:
    return f"cast(case when {condition} then 1 else 0 end as double)"


#: Successive projections from a line item to a play; every step sees the columns of the one before.
PLAY_STEPS: list[dict[str, str]] = [
    {
        "k": "l_orderkey",
        "p": "l_partkey",
        "s": "l_suppkey",
        "n": "l_linenumber",
        "q": "l_quantity",
        "season": "cast(year(l_shipdate) as int)",
        "week": "cast(l_orderkey % 18 + 1 as int)",
        "b": "(l_orderkey * 7 + l_linenumber) % 20",
        "own": "'T' || lpad(cast(l_suppkey % 32 as string), 2, '0')",
        "opp": "'T' || lpad(cast((l_suppkey + 16) % 32 as string), 2, '0')",
    },
    {
        "cmp": "b <= 8 and p % 3 <> 0",
        "rush": "b between 9 and 14",
        "fum": "b <= 14 and (k + p) % 29 = 0",
        "tp": "b in (8, 14) and k % 5 = 0",
        "rcv": "case when b <= 8 and p % 11 <> 0 then 'WR' || cast(p % 4 as string) || '-' || own end",
        "rsh": "case when b between 9 and 14 then "
        "(case when p % 7 = 0 then 'QB0-' else 'RB' || cast(p % 3 as string) || '-' end) || own end",
    },
]

#: Final columns of a play.
PLAY_COLUMNS: dict[str, str] = {
    "season": "season",
    "week": "week",
    "game_id": "cast(season as string) || '_' || lpad(cast(week as string), 2, '0') || '_' "
    "|| least(own, opp) || '_' || greatest(own, opp)",
    "posteam": "case when (k + n) % 41 = 0 then null when b = 17 then opp else own end",
    "defteam": "case when (k + n) % 41 = 0 then null when b = 17 then own else opp end",
    "play_type": "case when b <= 8 then 'pass' when b <= 14 then 'run' when b < 19 then "
    "(case b when 15 then 'field_goal' when 16 then 'extra_point' when 17 then 'kickoff' else 'no_play' end) end",
    "yards_gained": "case when cmp or rush then q - 10 end",
    "epa": "(q - 25) / cast(8 as double)",
    "passer_player_id": "case when b <= 8 then 'QB0-' || own end",
    "passer_player_name": "case when b <= 8 then (case when k % 199 = 0 then 'Q. ' else 'Q.' end) || own end",
    "pass_attempt": _flag("b <= 8"),
    "complete_pass": _flag("cmp"),
    "passing_yards": "case when cmp then q - 10 end",
    "pass_touchdown": _flag("cmp and p % 23 = 0"),
    "interception": _flag("b <= 8 and p % 39 = 0"),
    "rusher_player_id": "rsh",
    "rusher_player_name": "case when rsh is not null then (case when p % 7 = 0 then 'Q.' || own else 'R.' || rsh end) end",
    "rush_attempt": _flag("rush"),
    "rushing_yards": "case when rush then q - 20 end",
    "rush_touchdown": _flag("rush and p % 19 = 0"),
    "receiver_player_id": "rcv",
    "receiver_player_name": "'W.' || rcv",
    "receiving_yards": "case when cmp and rcv is not null then q - 10 end",
    "air_yards": "case when b <= 8 then q - 15 end",
    "yards_after_catch": "case when cmp then cast(p % 12 as double) end",
    "two_point_attempt": _flag("tp"),
    "two_point_conv_result": "case when tp then (case when p % 2 = 0 then 'success' else 'failure' end) end",
    "fumbled_1_player_id": "case when fum then coalesce(rcv, rsh, 'QB0-' || own) end",
    "fumble": _flag("fum"),
    "fumble_lost": _flag("fum and p % 2 = 0"),
    "fumble_recovery_1_player_id": "case when fum then (case when p % 2 = 0 then 'LB0-' || opp else 'RB0-' || own end) end",
    "fumble_recovery_1_team": "case when fum then (case when p % 2 = 0 then opp else own end) end",
    "kicker_player_id": "case when b between 15 and 17 then 'K0-' || own end",
    "kicker_player_name": "case when b between 15 and 17 then 'K.' || own end",
    "field_goal_attempt": _flag("b = 15"),
    "field_goal_result": "case when b = 15 then "
    "(case when p % 5 = 0 then 'missed' when p % 17 = 0 then 'blocked' else 'made' end) end",
    "kick_distance": "case when b = 15 then cast(18 + p % 47 as double) end",
    "extra_point_attempt": _flag("b = 16"),
    "extra_point_result": "case when b = 16 then (case when p % 13 = 0 then 'failed' else 'good' end) end",
    "touchdown": _flag("(cmp and p % 23 = 0) or (rush and p % 19 = 0) or (fum and k % 4 = 0)"),
    "return_touchdown": _flag("fum and k % 4 = 0"),
}

#: Roster slots of a team: (number, slot, position).
SLOTS: list[tuple[int, str, str | None]] = [
    (0, "QB0", "QB"),
    (1, "RB0", "RB"),
    (2, "RB1", "RB"),
    (3, "RB2", "RB"),
    (4, "WR0", "WR"),
    (5, "WR1", "WR"),
    (6, "WR2", "WR"),
    (7, "WR3", "TE"),
    (8, "K0", "K"),
    (9, "LB0", "LB"),
    (10, "DEV", None),
]

#: Columns of a roster row over (season, week, t, team, i, slot, pos).
ROSTER_COLUMNS: dict[str, str] = {
    "season": "season",
    "week": "week",
    "team": "team",
    "player_id": "case when slot = 'DEV' then null else slot || '-' || team end",
    "sleeper_id": "case when slot in ('DEV', 'LB0') or (t * 11 + i) % 13 = 0 then null "
    "else cast(1000 + t * 11 + i as string) end",
    "player_name": "slot || ' ' || team",
    "position": "case when slot = 'RB2' and t % 5 = 0 then null else pos end",
    "years_exp": "cast((t + i) % 12 as double)",
    "draft_number": "case when (t + i) % 4 = 0 then null else cast((t * 11 + i) % 256 + 1 as double) end",
    "age": "cast(21 + (t + i) % 12 as double)",
    "status": "case when slot = 'DEV' then 'DEV' when (week + i) % 9 = 0 then 'INA' "
    "when (week + i) % 11 = 0 then 'RES' else 'ACT' end",
}

#: Ids of prospects, players on a team's roster who have no plays; there are as many as parts.
FIRST_PROSPECT = 100000

#: Columns of a prospect's roster row over (season, week, t, team, part).
PROSPECT_COLUMNS: dict[str, str] = {
    "season": "season",
    "week": "week",
    "team": "team",
    "player_id": "'FA-' || cast(part as string)",
    "sleeper_id": f"cast({FIRST_PROSPECT} + part as string)",
    "player_name": "'Prospect ' || cast(part as string)",
    "position": "case part % 5 when 0 then 'QB' when 1 then 'RB' when 2 then 'WR' when 3 then 'TE' end",
    "years_exp": "cast(part % 3 as double)",
    "draft_number": "case when part % 2 = 0 then cast(part % 256 + 1 as double) end",
    "age": "cast(21 + part % 4 as double)",
    "status": "'DEV'",
}

#: The customer that holds a player of the league: a prospect goes to the customer of its number, if there is one.
HOLDER = (
    f"case when cast(sleeper_id as bigint) >= {FIRST_PROSPECT} then cast(sleeper_id as bigint) - {FIRST_PROSPECT} "
    "else cast(sleeper_id as bigint) % 16 end"
)

TEAM_WEEK_COLUMNS: dict[str, str] = {
    "season": "cast(year(l_shipdate) as int)",
    "week": "cast(l_orderkey % 18 + 1 as int)",
    "t": "l_suppkey % 32",
    "team": "'T' || lpad(cast(l_suppkey % 32 as string), 2, '0')",
}
#: A team's name from its number ``t``.
TEAM_OF_T = "'T' || lpad(cast(t as string), 2, '0')"


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def plays(spark: SparkSession, sf_dir: str, by_season: bool = False) -> DataFrame:
    """One play per line item; ``by_season`` sorts each task's, while they are narrow, for a write by season."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for step in PLAY_STEPS:
        df = df.selectExpr(*([] if step is PLAY_STEPS[0] else ["*"]), *select_list(step))
        if by_season and step is PLAY_STEPS[0]:
            df = df.sortWithinPartitions("season")
    return df.selectExpr(*select_list(PLAY_COLUMNS))


def _slots(teams: DataFrame) -> DataFrame:
    """A row for every roster slot of a row's team."""
    slots = ", ".join(
        f"struct({i} AS i, '{s}' AS slot, {f"'{p}'" if p else 'CAST(NULL AS STRING)'} AS pos)" for i, s, p in SLOTS
    )
    return teams.selectExpr("*", f"inline(array({slots}))")


def _slot_rosters(lines: DataFrame) -> DataFrame:
    """Eleven roster slots for every team-week that has a line item."""
    team_weeks = lines.selectExpr(*select_list(TEAM_WEEK_COLUMNS)).distinct()
    return _slots(team_weeks).selectExpr(*select_list(ROSTER_COLUMNS))


def _prospects(parts: DataFrame) -> DataFrame:
    """Roster rows of prospects from (season, week, t, part)."""
    return parts.selectExpr("*", f"{TEAM_OF_T} AS team").selectExpr(*select_list(PROSPECT_COLUMNS))


def _team_parts(lines: DataFrame) -> DataFrame:
    """The prospect of every line item as numbers, which are narrow while copies are dropped."""
    return lines.selectExpr(*(f"{TEAM_WEEK_COLUMNS[name]} AS {name}" for name in ("season", "week", "t")), "l_partkey AS part")


def rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven roster slots for every team-week that has a line item, and a prospect for each of its parts."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return _slot_rosters(lines).unionByName(_prospects(_team_parts(lines).distinct()))


def _league_ids(lines: DataFrame) -> DataFrame:
    """The distinct league ids of all rosters; an id depends on team and slot or on the part, not on season and week."""
    teams = lines.selectExpr(f"{TEAM_WEEK_COLUMNS['t']} AS t").distinct()
    parts = lines.selectExpr("l_partkey AS part").distinct()
    slots = _slots(teams).selectExpr(f"{ROSTER_COLUMNS['sleeper_id']} AS sleeper_id")
    ids = slots.unionByName(parts.selectExpr(f"{PROSPECT_COLUMNS['sleeper_id']} AS sleeper_id"))
    return ids.where("sleeper_id is not null").distinct()


def league_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nested roster documents and users, as a league service would deliver them: every customer has a roster.

    The players of a roster are a sixteenth of the 32 x 11 ids of the slots at most and a
    prospect, so the collected arrays have a fixed bound.
    """
    ids = _league_ids(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    held = ids.groupBy(F.expr(HOLDER).alias("owner")).agg(F.collect_list("sleeper_id").alias("players"))
    owners = spark.read.parquet(f"{sf_dir}/customer.parquet")
    documents = owners.join(held, owners.c_custkey == held.owner, "left").selectExpr(
        "cast(c_custkey + 1 as int) as roster_id",
        "case when c_custkey <> 10 then cast(c_custkey as string) end as owner_id",
        "case when c_custkey <> 11 then players end as players",
        "case when c_custkey <> 11 then named_struct("
        "'wins', cast(c_custkey % 7 as int), 'losses', cast(13 - c_custkey % 7 as int)) end as settings",
    )
    users = owners.where("c_custkey <> 8").selectExpr(
        "cast(c_custkey as string) as user_id",
        "case when c_custkey <> 9 then c_name end as owner_name",
    )
    return documents, users


#: Seasons asked of the landed files: the first is missing, one is damaged, a later one isn't asked for.
LANDED_SEASONS = range(1994, 2001)
DAMAGED_SEASON = 1996


def land_plays(spark: SparkSession, sf_dir: str, root: str, whole: bool = True) -> None:
    """Season files of the plays as a feed delivers them; a damaged file lies beside one season's.

    Unless ``whole``, odd seasons lack ``air_yards`` and the files of even ones differ: those of
    odd weeks lack ``epa``.
    """
    df = plays(spark, sf_dir, by_season=True)
    if whole:
        df.write.partitionBy("season").parquet(root)
    else:
        df.where("season % 2 = 1").drop("air_yards").write.partitionBy("season").parquet(root)
        for odd, dropped in ((0, []), (1, ["epa"])):
            part = df.where(f"season % 2 = 0 AND week % 2 = {odd}").drop(*dropped)
            part.write.mode("append").partitionBy("season").parquet(root)
    _damage(spark, f"{root}/season={DAMAGED_SEASON}")


#: Line items whose prospects one task makes.
LINES_PER_TASK = 500_000


def land_rosters(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Season files of the rosters, damaged like those of the plays.

    The number of tasks follows that of the line items, and they sort numbers rather
    than roster rows, so a task's memory does not grow with the input.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    _slot_rosters(lines).write.partitionBy("season").parquet(root)
    tasks = lines.count() // LINES_PER_TASK + 1
    parts = _team_parts(lines).repartition(tasks, "season", "week", "t", "part").distinct().sortWithinPartitions("season")
    _prospects(parts).write.mode("append").partitionBy("season").parquet(root)
    _damage(spark, f"{root}/season={DAMAGED_SEASON}")


def _damage(spark: SparkSession, path: str) -> None:
    spark.range(1).selectExpr("'no Parquet file' AS value").write.mode("append").text(path)


def land_league(spark: SparkSession, sf_dir: str, rosters_root: str, users_root: str, size: int = 100) -> None:
    """League documents as JSON arrays, a file for every ``size`` customers.

    A customer with c_custkey % 7 = 3 is in an earlier document too, by another name; one with
    c_custkey % 13 = 5 lacks the key of the name, where a null name is written as null.
    """
    documents, users = league_documents(spark, sf_dir)
    elements = documents.selectExpr(f"cast(roster_id div {size} as int) AS league", "to_json(struct(*)) AS element")
    _documents(elements, rosters_root)
    key = "cast(user_id as int)"
    name = (
        f"CASE WHEN {key} % 13 = 5 THEN '' "
        "ELSE ', \"display_name\": ' || coalesce('\"' || owner_name || '\"', 'null') END"
    )
    named = users.selectExpr(f"{key} div {size} + 1 AS league", "user_id", f"{name} AS name")
    former = users.where(f"{key} % 7 = 3").selectExpr(
        f"{key} div {size} AS league", "user_id", "', \"display_name\": \"formerly ' || user_id || '\"' AS name"
    )
    _documents(named.unionByName(former).selectExpr("league", "'{\"user_id\": \"' || user_id || '\"' || name || '}' AS element"), users_root)


#: Documents that lie in one folder and are written by one task.
LEAGUES_PER_FOLDER = 50


def _documents(elements: DataFrame, root: str) -> None:
    """One array a league, a file each; later leagues' files sort after earlier ones'.

    Folders are numbered in as many digits, and within one a single task names its files in order.
    The number of tasks is given, since the documents are few bytes but many files.
    """
    arrays = elements.groupBy("league").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("element")), F.lit("]")).alias("value"))
    foldered = arrays.withColumn("folder", F.expr(f"{10**12} + league div {LEAGUES_PER_FOLDER}"))
    tasks = int(elements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = foldered.repartition(tasks, "folder").sortWithinPartitions("folder", "league")
    dealt.drop("league").write.option("maxRecordsPerFile", 1).partitionBy("folder").text(root)


# ----------------------------------------------------- the same, as SQL text


def _sql_types(text: str) -> str:
    return text.replace(" as string)", " as varchar)")


def sql_tables() -> dict[str, str]:
    """Name -> SQL text of the derived inputs for a database that holds the generic tables."""
    source = "lineitem"
    for step in PLAY_STEPS:
        kept = "" if step is PLAY_STEPS[0] else "*, "
        source = f"(SELECT {kept}{', '.join(select_list(step))} FROM {source})"
    slots = ", ".join(f"({i}, '{s}', {'NULL' if p is None else repr(p)})" for i, s, p in SLOTS)
    landed = f"season BETWEEN {min(LANDED_SEASONS)} AND {max(LANDED_SEASONS)} AND season <> {DAMAGED_SEASON}"
    return {
        "plays": _sql_types(f"SELECT {', '.join(select_list(PLAY_COLUMNS))} FROM {source}"),
        "rosters": _sql_types(
            f"SELECT {', '.join(select_list(ROSTER_COLUMNS))} "
            f"FROM (SELECT DISTINCT {', '.join(select_list(TEAM_WEEK_COLUMNS))} FROM lineitem) AS tw, "
            f"(VALUES {slots}) AS sl(i, slot, pos) "
            f"UNION ALL SELECT {', '.join(select_list(PROSPECT_COLUMNS))} "
            f"FROM (SELECT DISTINCT {', '.join(select_list(TEAM_WEEK_COLUMNS))}, l_partkey AS part FROM lineitem) AS tw"
        ),
        "league": f"""
            SELECT CAST(c_custkey + 1 AS INTEGER) AS roster_id,
                   CASE WHEN c_custkey <> 10 THEN CAST(c_custkey AS VARCHAR) END AS owner_id,
                   CASE WHEN c_custkey IN (8, 10) THEN '{UNKNOWN_OWNER}' WHEN c_custkey <> 9 THEN c_name END AS owner_name,
                   c_custkey = {MY_USER_ID} AS is_my_roster,
                   ids.sleeper_id,
                   CAST(c_custkey % 7 AS INTEGER) AS wins,
                   CAST(13 - c_custkey % 7 AS INTEGER) AS losses
            FROM customer
            JOIN (SELECT DISTINCT sleeper_id FROM rosters WHERE sleeper_id IS NOT NULL) AS ids
              ON {HOLDER} = c_custkey
            WHERE c_custkey <> 11""",
        "league_landed": f"""
            SELECT * REPLACE (CASE WHEN (roster_id - 1) % 13 = 5 THEN '{UNKNOWN_OWNER}' ELSE owner_name END AS owner_name)
            FROM league""",
        "plays_landed": f"SELECT * FROM plays WHERE {landed}",
        "rosters_landed": f"SELECT * FROM rosters WHERE {landed}",
    }
