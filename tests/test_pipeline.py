"""The whole run over landed files, and the checks."""

import json

import pytest
from pyspark.sql import functions as F

from gridiron import fixtures
from gridiron.operators import boxscore, players, staging, teams
from gridiron.plans import checks, pipeline
from gridiron.plans import queries as q
from gridiron.sources import league, tables
from tests.rows import dicts
from tests.test_boxscore import same_rows


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    fixtures.plays(spark, sf_dir).write.partitionBy("season").parquet(str(root / "pbp"))
    fixtures.rosters(spark, sf_dir).write.partitionBy("season").parquet(str(root / "rosters"))
    documents, users = fixtures.league_documents(spark, sf_dir)
    (root / "rosters.json").write_text(json.dumps([r.asDict(True) for r in documents.collect()]))
    named = [{"user_id": u.user_id, "display_name": u.owner_name} for u in users.collect()]
    (root / "users.json").write_text(json.dumps(named))
    return root


def config(root, **changes):
    arguments = {
        "plays_root": str(root / "pbp"),
        "rosters_root": str(root / "rosters"),
        "league_rosters": str(root / "rosters.json"),
        "league_users": str(root / "users.json"),
        "my_user_id": fixtures.MY_USER_ID,
        "seasons": range(1990, 2005),
    }
    return pipeline.PipelineConfig(**{**arguments, **changes})


@pytest.fixture(scope="module")
def report(spark, landed):
    return pipeline.run_pipeline(spark, config(landed))


def test_tables_and_views(spark, report):
    names = {
        "raw": {"pbp", "rosters", "sleeper_rosters"},
        "staging": {"stg_pbp", "stg_pbp_player_stats", "stg_rosters", "stg_sleeper_rosters"},
        "marts": {
            "fct_team_week_epa",
            "fct_player_week",
            "fct_player_roster_status",
            "fct_player_game_stats",
            "player_attributes",
            "player_week_base",
        },
    }
    kinds = {db: {t.name: t.tableType for t in spark.catalog.listTables(db) if not t.isTemporary} for db in (*names, "releases")}
    assert {db: kinds[db] for db in names} == {db: dict.fromkeys(of, "VIEW") for db, of in names.items()}
    rows = {f"{db}__{name}": "MANAGED" for db in ("raw", "marts") for name in names[db]}
    assert kinds["releases"] == rows | {"current_runs": "VIEW"}


def test_marts_equal_the_lazy_datasets(spark, sf_dir, report):
    plays, rosters = fixtures.plays(spark, sf_dir), fixtures.rosters(spark, sf_dir)
    flat = league.flatten_league(*fixtures.league_documents(spark, sf_dir), fixtures.MY_USER_ID)
    weeks = players.player_week(staging.stg_rosters(rosters))
    expected = {
        "fct_team_week_epa": teams.team_week_epa(staging.stg_pbp(plays)),
        "fct_player_game_stats": boxscore.player_game_stats(staging.stg_pbp_player_stats(plays)),
        "fct_player_week": weeks,
        "fct_player_roster_status": players.player_roster_status(weeks, staging.stg_league_rosters(flat)),
    }
    expected["player_week_base"] = q.player_week_base(
        expected["fct_player_game_stats"], expected["fct_player_roster_status"]
    )
    for name, df in expected.items():
        assert same_rows(spark.table(f"marts.{name}"), df), name


def test_report(spark, report):
    rows = {(r.table_name, r.column_name): (r.severity, r.failures) for r in report.collect()}
    unread = {key: rows.pop(key) for key in list(rows) if key[0].startswith("raw.")}
    assert len(unread) == 16 and unread["raw.pbp", "season=1990"] == (checks.WARN, 1)
    assert len(rows) == 18
    assert sum(severity == checks.ERROR for severity, _ in rows.values()) == 14
    broken = {key for key, (_, failures) in rows.items() if failures}
    assert broken == {
        ("stg_rosters", "player_id"),
        ("fct_player_week", "player_id"),
        ("fct_player_week", "sleeper_id"),
        ("fct_player_roster_status", "player_id"),
    }


def test_broken_error_check_raises_and_warning_does_not(spark):
    rows = [("t", "c", checks.WARN, 5), ("t", "d", checks.ERROR, 0)]
    schema = "table_name string, column_name string, severity string, failures bigint"
    checks.enforce(spark.createDataFrame(rows, schema))
    with pytest.raises(checks.CheckFailedError, match=r"t\.e \(2\)"):
        checks.enforce(spark.createDataFrame([*rows, ("t", "e", checks.ERROR, 2)], schema))


def test_board_over_marts_prunes_the_season(spark, report):
    board = q.waiver_leaderboard(spark.table("marts.player_week_base"), 2000, "WR", min_games=1)
    plan = board._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "(season" in scans[0].split("PartitionFilters")[1].split("PushedFilters")[0]
    assert board.count() > 0


def test_damaged_season_is_reported_and_kept(spark, landed, report, tmp_path):
    before = spark.table("raw.pbp").where("season = 2000").count()
    spark.read.parquet(str(landed / "pbp" / "season=1999")).write.parquet(str(tmp_path / "pbp" / "season=1999"))
    (tmp_path / "pbp" / "season=2000").mkdir()
    (tmp_path / "pbp" / "season=2000" / "part-0.parquet").write_bytes(b"no Parquet file")
    run = config(landed, plays_root=str(tmp_path / "pbp"), seasons=[1999, 2000], only_seasons=True)
    rows = {(r.table_name, r.column_name): r.severity for r in pipeline.run_pipeline(spark, run).collect()}
    assert {k: v for k, v in rows.items() if k[0].startswith("raw.")} == {("raw.pbp", "season=2000"): checks.WARN}
    assert before and spark.table("raw.pbp").where("season = 2000").count() == before


def test_refresh_of_one_season_leaves_the_others(spark, landed, report, tmp_path):
    before = {r.season: r["count"] for r in spark.table("marts.fct_player_game_stats").groupBy("season").count().collect()}
    changed = spark.read.parquet(str(landed / "pbp" / "season=2000")).where("week <= 2")
    changed.write.parquet(str(tmp_path / "pbp" / "season=2000"))
    pipeline.run_pipeline(
        spark, config(landed, plays_root=str(tmp_path / "pbp"), seasons=[2000], only_seasons=True)
    )
    stats = spark.table("marts.fct_player_game_stats")
    after = {r.season: r["count"] for r in stats.groupBy("season").count().collect()}
    assert after.keys() == before.keys()
    assert {s for s in after if after[s] != before[s]} == {2000}
    assert dicts(stats.where("season = 2000").agg(F.max("week").alias("w"))) == [{"w": 2}]


def test_player_grain_without_no_play(spark, landed):
    assert not spark.table("staging.stg_pbp").where("play_type = 'no_play'").isEmpty()
    pipeline.run_pipeline(spark, config(landed, grain="player", exclude_no_play=True))
    assert spark.table("staging.stg_pbp").where("play_type = 'no_play'").isEmpty()
    assert (
        spark.table("marts.fct_player_game_stats").groupBy("season", "week", "player_id").count().where("count > 1").isEmpty()
    )


def counts(spark):
    return {name: spark.table(name).count() for name in tables.published_runs(spark)}


def test_a_run_that_breaks_a_check_leaves_the_run_before(spark, landed, report, tmp_path):
    before, runs = counts(spark), tables.published_runs(spark)
    broken = spark.read.parquet(str(landed / "pbp" / "season=2000")).withColumn("game_id", F.lit(None).cast("string"))
    broken.write.parquet(str(tmp_path / "pbp" / "season=2000"))
    with pytest.raises(checks.CheckFailedError, match="game_id"):
        pipeline.run_pipeline(spark, config(landed, plays_root=str(tmp_path / "pbp"), seasons=[2000], only_seasons=True))
    assert counts(spark) == before and tables.published_runs(spark) == runs


@pytest.mark.parametrize("step", ["create_view", "_point"])
def test_a_run_killed_while_it_publishes_leaves_the_run_before(spark, landed, report, monkeypatch, step):
    before, runs = counts(spark), tables.published_runs(spark)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(tables, step, killed)
        with pytest.raises(KeyboardInterrupt):
            pipeline.run_pipeline(spark, config(landed, seasons=range(1995, 1998)))
    assert counts(spark) == before and tables.published_runs(spark) == runs
    pipeline.run_pipeline(spark, config(landed))  # the next run publishes, and what the killed one wrote goes
    assert tables.published_runs(spark)["raw.pbp"].keys() == runs["raw.pbp"].keys()
    used = {run for of in (*runs.values(), *tables.published_runs(spark).values()) for run in of.values()}
    held = {r.partition.split("/")[0].split("=")[1] for r in spark.sql("SHOW PARTITIONS releases.raw__pbp").collect()}
    assert held <= used


def test_boards_skip_the_files_of_other_positions(spark, report):
    """Files of the base hold ranges of positions, so most of a season's bytes are skipped by their statistics."""
    base = spark.table("marts.player_week_base")
    files = base.where("position is not null").select(F.input_file_name().alias("f"), "season", "position")
    held = files.groupBy("season", "f").agg(F.countDistinct("position").alias("n")).collect()
    by_season = {s: sum(r.season == s for r in held) for s in {r.season for r in held}}
    kinds = base.select("position").where("position is not null").distinct().count()
    # in files that follow the order of positions, each of f files but the first adds at most one position it shares with the one before
    assert all(sum(r.n for r in held if r.season == s) <= kinds + n - 1 for s, n in by_season.items())
    plan = q.waiver_leaderboard(base, 2000, "WR", min_games=1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(position,WR)" in plan


def test_published_rows_alone_are_read(spark, report):
    plan = spark.table("marts.fct_team_week_epa").where("season = 2000")._jdf.queryExecution().executedPlan().toString()
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line]
    filters = scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "run_id" in filters and "season" in filters and "Subquery" not in plan


def release(spark, *writes):
    made = tables.Release(spark)
    for df, name, *more in writes:
        made.write(df, name, *more)
    return made


def test_failed_write_keeps_the_old_rows(spark):
    release(spark, (spark.range(3), "raw.kept")).publish()
    with pytest.raises(Exception):
        release(spark, (spark.range(4).selectExpr("cast(raise_error('broken') as bigint) AS id"), "raw.kept")).publish()
    assert spark.table("raw.kept").count() == 3
    with pytest.raises(tables.ColumnTypeError, match="id: string"):
        release(spark, (spark.sql("SELECT 'x' AS id"), "raw.kept"))
    assert spark.table("raw.kept").count() == 3


def test_refresh_drops_empty_seasons_and_follows_columns(spark):
    both = spark.sql("SELECT 1 AS a, 1 AS b, 2024 AS season UNION ALL SELECT 2, 2, 2025 UNION ALL SELECT 3, 3, 2026")
    release(spark, (both, "raw.drift", "season")).publish()
    draft = release(spark, (spark.sql("SELECT 3 AS a, 4 AS c, 2024 AS season"), "raw.drift", "season", [2024, 2025]))
    assert {tuple(r) for r in draft.table("raw.drift").select("a", "season").collect()} == {(3, 2024), (3, 2026)}
    assert {tuple(r) for r in spark.table("raw.drift").collect()} == {(1, 1, 2024), (2, 2, 2025), (3, 3, 2026)}  # as before
    draft.publish()
    rows = {tuple(r) for r in spark.table("raw.drift").select("a", "b", "c", "season").collect()}
    assert rows == {(3, None, 4, 2024), (3, 3, None, 2026)}


def test_season_that_fails_while_it_is_read_is_left_out(spark, landed, report, tmp_path):
    """A damaged second file, and a damaged page behind a sound footer."""
    for season in (1998, 1999, 2000):
        one = spark.read.parquet(str(landed / "pbp" / f"season={season}")).coalesce(1)
        one.write.parquet(str(tmp_path / "pbp" / f"season={season}"))
    (tmp_path / "pbp" / "season=1999" / "part-9.parquet").write_bytes(b"no Parquet file")
    (page,) = (tmp_path / "pbp" / "season=2000").glob("part-*.parquet")
    data = bytearray(page.read_bytes())
    data[4 : len(data) // 2] = bytes(len(data) // 2 - 4)
    page.write_bytes(bytes(data))
    for crc in (tmp_path / "pbp" / "season=2000").glob(".*.crc"):
        crc.unlink()
    rows = pipeline.run_pipeline(spark, config(landed, plays_root=str(tmp_path / "pbp"), seasons=[1998, 1999, 2000])).collect()
    assert {r.column_name for r in rows if r.table_name == "raw.pbp"} == {"season=1999", "season=2000"}
    assert [r.season for r in spark.table("raw.pbp").select("season").distinct().collect()] == [1998]
    assert [r.season for r in spark.table("marts.fct_team_week_epa").select("season").distinct().collect()] == [1998]
