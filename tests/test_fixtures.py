"""Landing the derived inputs."""

import json
from pathlib import Path

import pytest

from gridiron import fixtures
from gridiron.sources import league
from gridiron.sources import tables as tables_by_release


@pytest.fixture
def tables(spark, tmp_path):
    """Line items with copies and null keys, and customers."""
    spark.range(6000).selectExpr(
        "id div 3 AS l_orderkey",
        "CASE WHEN id % 101 <> 0 THEN id % 700 END AS l_partkey",
        "CASE WHEN id % 97 <> 0 THEN id % 40 END AS l_suppkey",
        "CAST(id % 3 + 1 AS int) AS l_linenumber",
        "CAST(id % 50 AS double) AS l_quantity",
        "timestamp'1995-01-01' + make_dt_interval(CAST(id % 2400 AS int)) AS l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(1200).selectExpr("id AS c_custkey", "'Customer ' || id AS c_name").write.parquet(str(tmp_path / "customer.parquet"))
    return str(tmp_path)


def test_landed_rosters_are_made_by_more_tasks_if_there_are_more_lines(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "LINES_PER_TASK", 1000, raising=False)
    root = tmp_path / "landed"
    fixtures.land_rosters(spark, tables, str(root))
    wanted = fixtures.rosters(spark, tables).where(f"season <> {fixtures.DAMAGED_SEASON}")
    landed = spark.read.parquet(*(str(p) for p in root.glob("season=*") if not p.name.endswith(str(fixtures.DAMAGED_SEASON))))
    columns = [c for c in wanted.columns if c != "season"]
    assert wanted.count() == landed.count() > 0
    assert wanted.select(columns).exceptAll(landed.select(columns)).isEmpty()
    assert all(len(list(Path(p).glob("*.parquet"))) >= 4 for p in root.glob("season=199[579]"))


def test_league_documents_share_folders_and_stay_in_order(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "LEAGUES_PER_FOLDER", 4, raising=False)
    rosters, users = tmp_path / "rosters", tmp_path / "users"
    fixtures.land_league(spark, tables, str(rosters), str(users), size=10)
    files = sorted(users.rglob("*.txt"))
    assert len(files) == 121 and len({f.parent for f in files}) == 31  # 1200 customers, ten a document; names of 0 to 120 tens
    present = [[u for u in json.loads(f.read_text()) if not (u.get("display_name") or "").startswith("formerly")] for f in files]
    first = [min((int(user["user_id"]) for user in of), default=-1) for of in present]
    assert first == sorted(first)
    assert len(list(rosters.rglob("*.txt"))) == 121  # roster ids start at 1


def test_a_user_is_named_by_the_later_document(spark, tables, tmp_path):
    rosters, users = tmp_path / "rosters", tmp_path / "users"
    fixtures.land_league(spark, tables, str(rosters), str(users), size=1)  # 1200 documents, the former name one before
    named = {r.user_id: r.owner_name for r in league.read_league_users(spark, str(users)).collect()}
    assert named["10"] == "Customer 10" and named["997"] == "Customer 997" and named["1011"] == "Customer 1011"
    assert not [name for name in named.values() if name and name.startswith("formerly")]


def test_league_ids_are_those_of_the_rosters(spark, tables):
    rosters, users = fixtures.league_documents(spark, tables)
    held = [player for r in rosters.collect() for player in r.players or ()]
    ids = fixtures.rosters(spark, tables).select("sleeper_id").where("sleeper_id IS NOT NULL").distinct()
    wanted = [r.sleeper_id for r in ids.where(f"{fixtures.HOLDER} BETWEEN 0 AND 1199 AND {fixtures.HOLDER} <> 11").collect()]
    assert sorted(held) == sorted(wanted)
    # one row per id: the work of line items is a distinct of parts and one of teams, not of team-weeks
    assert "l_shipdate" not in rosters._sc._jvm.PythonSQLUtils.explainString(rosters._jdf.queryExecution(), "simple")


def test_a_release_holds_only_the_seasons_written_last(spark, tmp_path):
    name = f"{tables_by_release.MARTS}.seasons_written"
    release = tables_by_release.Release(spark)
    rows = spark.createDataFrame([(1, 1999), (2, 2000), (3, 2001)], "a int, season int")
    release.begin_seasons(name, rows.schema)
    for season in (1999, 2000, 2001):
        release.write_season(rows.where(f"season = {season}"), name, season)
    release.end_seasons(name, [1999, 2000, 2001])
    assert release.seasons(name) == [1999, 2000, 2001] and release.table(name).count() == 3
    release.end_seasons(name, [2001], requested=[2000, 2001])  # 2000 is asked for and has no rows
    assert release.seasons(name) == [1999, 2001]
    assert sorted(r.a for r in release.table(name).collect()) == [1, 3]
    release.end_seasons(name, [2001])
    assert [r.a for r in release.table(name).collect()] == [3]
    spark.sql(f"DROP TABLE {tables_by_release.stored(name)}")
