"""Player-week base, own roster, tiles and boards on hand-written marts."""

import pytest

from gridiron.functions.numbers import percent, round_half_even, round_scaled
from gridiron.operators import players
from gridiron.plans import queries as q
from tests.rows import dicts, stats, status


def by(df, key):
    return {row[key]: row for row in dicts(df)}


def test_ownership_join(spark):
    weeks = status(
        spark,
        {"player_id": "a", "sleeper_id": "1"},
        {"player_id": "b", "sleeper_id": None},
        {"player_id": "c", "sleeper_id": "3"},
    ).select("season", "week", "team", "player_id", "sleeper_id", "player_name", "position", "status")
    league = spark.createDataFrame(
        [("1", 1, "me", True, 1, 0), ("1", 2, "you", False, 0, 1), (None, 3, "null", False, 0, 0)],
        "sleeper_id string, roster_id int, owner_name string, is_my_roster boolean, wins int, losses int",
    )
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = sorted((r.player_id, r.roster_id or 0) for r in players.player_roster_status(weeks, league).collect())
        assert got == [("a", 1), ("a", 2), ("b", 0), ("c", 0)]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_attributes_come_from_the_earliest_row(spark):
    rows = status(
        spark,
        {"week": 2, "position": "WR", "owner_name": "late"},
        {"week": 1, "position": "TE", "owner_name": "early"},
        {"season": 2025, "week": 1, "position": "QB"},
        {"player_id": None, "position": "LB"},
    )
    assert dicts(q.first_attributes(rows)) == [
        {"player_id": "p", "roster_id": None, "owner_name": "early", "is_my_roster": None, "position": "TE"}
    ]


def test_base_hides_kickers_only_and_totals_targets_per_team_week(spark):
    base = q.player_week_base(
        stats(
            spark,
            {"player_id": "w", "targets": 3},
            {"player_id": "n", "targets": 4},
            {"player_id": "k", "targets": 5},
            {"player_id": "unknown", "targets": 6},
            {"player_id": "w", "targets": 7, "week": 2},
            {"player_id": "w", "targets": 8, "team": None},
        ),
        status(spark, {"player_id": "w"}, {"player_id": "n", "position": None}, {"player_id": "k", "position": "K"}),
    )
    got = {(r["player_id"], r["week"], r["team"]): r["team_targets"] for r in dicts(base)}
    assert got == {
        ("w", 1, "A"): 13,
        ("n", 1, "A"): 13,
        ("unknown", 1, "A"): 13,
        ("w", 2, "A"): 7,
        ("w", 1, None): None,
    }


@pytest.fixture(scope="module")
def base(spark):
    mine = {"is_my_roster": True, "owner_name": "me", "roster_id": 1}
    other = {"is_my_roster": False, "owner_name": "you", "roster_id": 2}
    roster = status(
        spark,
        {"player_id": "m", "position": "WR", **mine},
        {"player_id": "q", "position": "QB", **mine},
        {"player_id": "x", "position": None, **mine},
        {"player_id": "o", "position": "WR", **other},
        {"player_id": "f", "position": "WR"},
        {"player_id": "lb", "position": "LB"},
    )
    rows = []
    for week, points in ((1, 1.11), (2, 2.22), (3, 3.3)):
        rows += [
            {"player_id": "m", "player_name": "M", "week": week, "targets": 2, "fantasy_points": points, "receiving_yards": 1.9},
            {"player_id": "q", "player_name": "Q", "week": week, "passing_tds": 1, "rushing_tds": 1, "fantasy_points": 9.0},
            {"player_id": "x", "player_name": "X", "week": week, "targets": 1, "rushing_yards": 2.5},
            {"player_id": "o", "player_name": "O", "week": week, "targets": 1, "team": "B", "fantasy_points": points},
            {"player_id": "f", "player_name": "F", "week": week, "targets": 0, "team": "C", "fantasy_points": points},
            {"player_id": "lb", "player_name": "LB", "week": week, "team": "C"},
        ]
    rows.append({"player_id": "m", "player_name": "M", "season": 2023, "fantasy_points": 50.0})
    # Mean 0.125: two decimals round half to even.
    rows += [
        {"player_id": "f", "player_name": "Tie", "team": "C", "week": w, "fantasy_points": p}
        for w, p in ((1, 0.12), (2, 0.13))
    ]
    return q.player_week_base(stats(spark, *rows), roster).cache()


def test_seasons_newest_first(base):
    assert [r["season"] for r in dicts(q.seasons(base))] == [2024, 2023]


def test_my_roster_totals(base):
    rows = q.my_rows(base, 2024)
    assert [r["week"] for r in dicts(q.available_weeks(rows))] == [1, 2, 3]
    assert dicts(q.week_bounds(rows)) == [{"min_week": 1, "max_week": 3}]
    totals = dicts(q.my_roster_totals(rows, all_tds=True))
    assert [r["player_name"] for r in totals] == ["Q", "M"]  # best first; X has no position
    quarterback, receiver = totals
    assert (quarterback["total_tds"], quarterback["all_tds"]) == (3, 6)
    assert (receiver["games"], receiver["fantasy_points"], receiver["targets"]) == (3, 6.63, 6)
    assert (receiver["team_targets"], receiver["target_share_pct"]) == (9, 66.7)
    ranged = by(q.my_roster_totals(q.my_rows(base, 2024, (2, 3))), "player_name")
    assert (ranged["M"]["games"], ranged["M"]["fantasy_points"]) == (2, 5.52)


def test_empty_season_keeps_the_schema(base):
    rows = q.my_rows(base, 1999)
    totals = q.my_roster_totals(rows)
    assert totals.count() == 0
    assert totals.columns == q.my_roster_totals(q.my_rows(base, 2024)).columns
    assert q.player_trend(rows, q.top_player_name(totals)).count() == 0
    assert [r["value"] for r in dicts(q.position_tiles(rows, "M"))] == [0, 0, 0]


def test_trend_and_tiles(base):
    rows = q.my_rows(base, 2024)
    assert [tuple(r) for r in q.player_trend(rows, "M").collect()] == [(1, 1.11), (2, 2.22), (3, 3.3)]
    assert q.player_trend(rows, q.top_player_name(q.my_roster_totals(rows))).count() == 3
    tiles = [(r.tile, r.label, r.value) for r in q.position_tiles(rows, "M").collect()]
    assert tiles == [(0, "Targets", 6), (1, "Receptions", 0), (2, "Receiving Yards", 5), (3, "Receiving TDs", 0)]
    fallback = [(r.label, r.value) for r in q.position_tiles(rows, "X").collect()]
    assert fallback == [("Targets", 3), ("Receiving Yards", 0), ("Rushing Yards", 7)]


def test_boards(base):
    waiver = dicts(q.waiver_leaderboard(base, 2024, "WR"))
    assert [(r["player_name"], r["owner_name"], r["games"]) for r in waiver] == [("F", "Free Agent", 3)]
    assert waiver[0]["target_share_pct"] is None  # no targets in the team
    assert waiver[0]["avg_fantasy_points"] == 2.21
    loose = by(q.waiver_leaderboard(base, 2024, "WR", min_games=2), "player_name")
    assert loose["Tie"]["avg_fantasy_points"] == 0.12
    trade = dicts(q.trade_leaderboard(base, 2024, "WR"))
    assert [(r["player_name"], r["owner_name"], r["target_share_pct"]) for r in trade] == [("O", "you", 100.0)]
    assert "target_share_pct" not in q.trade_leaderboard(base, 2024, "QB").columns


def test_board_of_an_unlisted_position(base):
    board = q.waiver_leaderboard(base, 2024, "LB")
    assert board.columns[-4:] == ["targets", "rushing_yards", "receiving_yards", "target_share_pct"]
    assert board.count() == 1


def test_rounding(spark):
    row = spark.range(1).select(
        round_scaled(spark_lit(0.285), 2).alias("below"),
        round_scaled(spark_lit(-0.125), 2).alias("away"),
        round_half_even(spark_lit(0.125), 2).alias("even"),
        percent(spark_lit(1), spark_lit(0)).alias("nothing"),
    )
    assert tuple(row.first()) == (0.28, -0.13, 0.12, None)


def spark_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)
