"""Every registered query against its SQL statement."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

QUERIES = entry.queries()
STATEMENTS = entry.oracle_sql()
#: Asks for a season without rows.
EMPTY = {"my_roster_totals_no_season"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert STATEMENTS.keys() <= QUERIES.keys()
    without = QUERIES.keys() - STATEMENTS.keys()
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query(spark, duck, sf_dir, name):
    rows, problems = compare(spark, duck, QUERIES[name], STATEMENTS[name], sf_dir)
    assert not problems
    assert (rows > 0) == (name not in EMPTY)


def test_a_changed_input_changes_the_answer(spark, tmp_path, sf_dir):
    """Nothing is kept from an earlier call over the same folder."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for table in ("customer", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    before = QUERIES["seasons"](spark, str(tmp_path)).count()
    lines.where("year(l_shipdate) = 1999").write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert (before, QUERIES["seasons"](spark, str(tmp_path)).count()) == (7, 1)


def test_registered_box_score_is_one_scan_and_two_shuffles(spark, sf_dir):
    plan = QUERIES["player_game_stats"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 2


def test_entry_is_lazy_and_has_rows(spark):
    df = entry.entry(spark)
    assert "fantasy_points" in df.columns
    assert df.count() > 0
