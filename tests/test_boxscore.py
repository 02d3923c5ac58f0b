"""Staging, team and player box scores."""

import random

import pytest
from pyspark.sql import functions as F

from gridiron import fixtures
from gridiron.functions.scoring import DEFAULT_SCORING
from gridiron.operators import boxscore, staging, teams
from tests.rows import dicts, plays


def same_rows(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def staged(spark, *rows):
    return staging.stg_pbp_player_stats(plays(spark, *rows))


def one(df, **keys):
    rows = [r for r in dicts(df) if all(r[k] == v for k, v in keys.items())]
    assert len(rows) == 1, rows
    return rows[0]


def test_staging_filters_null_not_the_text(spark):
    df = plays(
        spark,
        {"game_id": "kept"},
        {"game_id": "no_play", "play_type": "no_play"},
        {"game_id": "untyped", "play_type": None},
        {"game_id": "nobody", "posteam": None},
    )
    ids = lambda d: {r.game_id for r in d.collect()}
    assert ids(staging.stg_pbp(df)) == {"kept", "no_play"}
    assert ids(staging.stg_pbp_player_stats(df)) == {"kept", "no_play", "nobody"}
    assert ids(staging.stg_pbp(df, exclude_no_play=True)) == {"kept"}
    assert ids(staging.stg_pbp_player_stats(df, exclude_no_play=True)) == {"kept", "nobody"}
    assert len(staging.STG_PBP_PLAYER_STATS.columns) == 37


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "plays")
    plays(spark, {}).write.parquet(path)
    df = teams.team_week_epa(staging.stg_pbp(spark.read.parquet(path)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(play_type), IsNotNull(posteam)]" in plan
    assert "ReadSchema: struct<season:int,week:int,posteam:string,play_type:string,epa:double>" in plan


def test_team_week_mean_skips_nulls(spark):
    df = teams.team_week_epa(staging.stg_pbp(plays(spark, {"epa": 1.0}, {"epa": None}, {"epa": 2.0})))
    assert dicts(df) == [{"season": 2024, "team": "A", "week": 1, "plays": 3, "avg_epa": 1.5}]


def test_kick_distances_at_the_bucket_borders(spark):
    kick = {"kicker_player_id": "k", "kicker_player_name": "K", "field_goal_attempt": 1.0, "field_goal_result": "made"}
    distances = [19, 20, 29, 30, 39, 40, 49, 50, 59, 60]
    df = staged(spark, *[{**kick, "kick_distance": float(d)} for d in distances])
    row = one(boxscore.role_box(df, "kicking"))
    made = [row[f"fg_made_{b}"] for b in ("0_19", "20_29", "30_39", "40_49", "50_59", "60_plus")]
    assert made == [1, 2, 2, 2, 2, 1]


def test_null_flags_and_results_count_on_neither_side(spark):
    kick = {"kicker_player_id": "k", "kicker_player_name": "K"}
    df = staged(
        spark,
        {**kick, "field_goal_attempt": 1.0, "field_goal_result": None, "kick_distance": 30.0},
        {**kick, "field_goal_attempt": None, "field_goal_result": "missed"},
        {**kick, "field_goal_attempt": 1.0, "field_goal_result": "blocked"},
        {**kick, "extra_point_attempt": 1.0, "extra_point_result": None},
        {**kick, "extra_point_attempt": 1.0, "extra_point_result": "failed"},
        {**kick, "extra_point_attempt": 1.0, "extra_point_result": "good"},
    )
    for box in (boxscore.role_box(df, "kicking"), boxscore.player_game_stats(df)):
        row = one(box)
        assert (row["fg_missed"], row["pat_made"], row["pat_missed"], row["fg_made_30_39"]) == (1, 1, 1, 0)


def test_sum_of_nulls_stays_null_in_a_role_and_is_zero_in_the_box(spark):
    df = staged(spark, {"passer_player_id": "q", "passer_player_name": "Q", "pass_attempt": 1.0})
    assert one(boxscore.role_box(df, "passing"))["passing_yards"] is None
    assert one(boxscore.player_game_stats(df))["passing_yards"] == 0.0


def test_two_point_conversions_need_attempt_and_success(spark):
    def play(attempt, result):
        people = {f"{r}_player_id": r for r in ("passer", "rusher", "receiver")}
        return {**people, "two_point_attempt": attempt, "two_point_conv_result": result}

    df = staged(spark, play(1.0, "success"), play(1.0, "failure"), play(0.0, "success"), play(None, "success"))
    for role, metric in (("passing", "passing"), ("rushing", "rushing"), ("receiving", "receiving")):
        assert one(boxscore.role_box(df, role))[f"{metric}_two_pt"] == 1


def test_receiver_stats(spark):
    catch = {"receiver_player_id": "w", "receiver_player_name": "W", "pass_attempt": 1.0}
    df = staged(
        spark,
        {**catch, "complete_pass": 1.0, "pass_touchdown": 1.0, "receiving_yards": 12.0, "air_yards": 9.0},
        {**catch, "complete_pass": 0.0, "pass_touchdown": 1.0, "air_yards": 20.0},
    )
    row = one(boxscore.player_game_stats(df))
    assert (row["targets"], row["receptions"], row["receiving_tds"]) == (2, 1, 1)
    assert (row["receiving_yards"], row["air_yards"]) == (12.0, 29.0)


def test_recovery_counts_return_touchdowns_only_and_needs_another_stat(spark):
    fumble = {"fumbled_1_player_id": "r", "fumble": 1.0, "fumble_lost": 1.0}
    df = staged(
        spark,
        {"rusher_player_id": "r", "rusher_player_name": "R", "rush_attempt": 1.0, **fumble},
        {"fumble_recovery_1_player_id": "r", "return_touchdown": 0.0, "touchdown": 1.0},
        {"fumble_recovery_1_player_id": "d", "return_touchdown": 1.0, "touchdown": 1.0},
    )
    recoveries = {r.player_id: r.fumble_recovery_tds for r in boxscore.role_box(df, "fumble_recovery_tds").collect()}
    assert recoveries == {"r": 0, "d": 1}
    for box in (boxscore.player_game_stats(df), boxscore.player_game_stats_by_player(df)):
        row = one(box)  # the defender has no other stat and is not listed
        assert (row["player_id"], row["fumbles"], row["fumbles_lost"], row["fumble_recovery_tds"]) == ("r", 1, 1, 0)
        assert row["fantasy_points"] == -2.0


def test_player_listed_under_two_pairs_gets_every_pairing(spark):
    df = staged(
        spark,
        {"passer_player_id": "x", "passer_player_name": "X", "passing_yards": 10.0, "pass_attempt": 1.0},
        {"passer_player_id": "x", "passer_player_name": "X.", "passing_yards": 20.0, "pass_attempt": 1.0},
        {"rusher_player_id": "x", "rusher_player_name": "X", "rushing_yards": 5.0, "posteam": None},
        {"fumbled_1_player_id": "x", "fumble": 1.0},
    )
    got = sorted(
        (r.team or "", r.player_name, r.passing_yards, r.rushing_yards, r.fumbles)
        for r in boxscore.player_game_stats(df).collect()
    )
    pairs = [("", "X"), ("A", "X"), ("A", "X.")]
    assert got == sorted((t, n, y, 5.0, 1) for t, n in pairs for y in (10.0, 20.0))
    row = one(boxscore.player_game_stats_by_player(df))
    assert (row["passing_yards"], row["rushing_yards"], row["fumbles"]) == (30.0, 5.0, 1)
    assert (row["team"], row["player_name"]) == (None, "X")  # all pairs have one play: smallest name, then team


def test_most_plays_decide_the_name(spark):
    df = staged(
        spark,
        {"passer_player_id": "x", "passer_player_name": "A"},
        {"passer_player_id": "x", "passer_player_name": "B"},
        {"rusher_player_id": "x", "rusher_player_name": "B"},
    )
    assert one(boxscore.player_game_stats_by_player(df))["player_name"] == "B"


def test_score_is_the_weighted_sum(spark):
    df = staged(
        spark,
        {
            "passer_player_id": "q",
            "passer_player_name": "Q",
            "pass_attempt": 1.0,
            "pass_touchdown": 1.0,
            "passing_yards": 33.0,
            "interception": 1.0,
        },
    )
    assert one(boxscore.player_game_stats(df))["fantasy_points"] == 4.32
    custom = one(boxscore.player_game_stats(df, {"passing_yards": 0.005, "interceptions": -2}))
    assert custom["fantasy_points"] == -1.84  # -1.835 rounds away from zero
    assert len(DEFAULT_SCORING) == 23


def random_plays(spark, n, hot_share=0.0, seed=1):
    """Random plays; a share of them goes to one player, team and week."""
    rng = random.Random(seed)
    flags = "pass_attempt complete_pass pass_touchdown interception rush_attempt rush_touchdown two_point_attempt".split()
    rows = []
    for _ in range(n):
        hot = rng.random() < hot_share
        pick = lambda prefix: "hot" if hot else rng.choice([None, f"{prefix}{rng.randint(0, 8)}", f"x{rng.randint(0, 3)}"])
        row = {
            "week": 1 if hot else rng.randint(1, 3),
            "posteam": rng.choice(["A", "B", None]),
            "passing_yards": rng.choice([None, 3.0, 7.0]),
            "rushing_yards": rng.choice([None, 2.0]),
            "receiving_yards": rng.choice([None, 9.0]),
            "two_point_conv_result": rng.choice([None, "success", "failure"]),
            "fumbled_1_player_id": pick("r"),
            "fumble": 1.0,
            "fumble_recovery_1_player_id": pick("d"),
            "return_touchdown": rng.choice([0.0, 1.0]),
            **{f: rng.choice([None, 0.0, 1.0]) for f in flags},
        }
        for role in ("passer", "rusher", "receiver", "kicker"):
            player = pick(role)
            row[f"{role}_player_id"] = player
            row[f"{role}_player_name"] = player and rng.choice([player.upper(), None, player])
        rows.append(row)
    return staged(spark, *rows)


@pytest.mark.parametrize("hot_share", [0.0, 0.4])
def test_single_pass_equals_the_joins(spark, hot_share):
    df = random_plays(spark, 150, hot_share).cache()
    assert same_rows(boxscore.player_game_stats(df), boxscore.player_game_stats_by_joins(df))


def test_a_player_week_of_300_names(spark):
    rows = [{"passer_player_id": "x", "passer_player_name": f"X{i}", "passing_yards": float(i)} for i in range(300)]
    rows += [{"rusher_player_id": "x", "rusher_player_name": f"X{i}", "rushing_yards": 1.0} for i in range(2)]
    rows += [{"passer_player_id": "y", "passer_player_name": "Y", "passing_yards": 5.0}]
    df = staged(spark, *rows).cache()
    stats = boxscore.player_game_stats(df)
    assert stats.count() == 300 * 300 * 2 + 1
    assert same_rows(stats, boxscore.player_game_stats_by_joins(df))


def test_single_pass_equals_the_joins_on_the_fixture(spark, sf_dir):
    df = staging.stg_pbp_player_stats(fixtures.plays(spark, sf_dir))
    assert same_rows(boxscore.player_game_stats(df), boxscore.player_game_stats_by_joins(df))


def test_single_pass_scans_once(spark, tmp_path):
    path = str(tmp_path / "plays")
    plays(spark, {}).write.parquet(path)
    df = boxscore.player_game_stats(staging.stg_pbp_player_stats(spark.read.parquet(path)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan


def test_by_player_is_unique_and_totals_agree(spark, sf_dir):
    df = staging.stg_pbp_player_stats(fixtures.plays(spark, sf_dir))
    box = boxscore.player_game_stats_by_player(df)
    assert box.groupBy("season", "week", "player_id").count().where("count > 1").isEmpty()
    targets = box.agg(F.sum("targets")).first()[0]
    assert targets == df.where("receiver_player_id IS NOT NULL AND pass_attempt = 1").count()
    pbp = staging.stg_pbp(fixtures.plays(spark, sf_dir))
    assert teams.team_week_epa(pbp).agg(F.sum("plays")).first()[0] == pbp.count()
