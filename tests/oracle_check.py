"""Compare registered queries with their SQL statements in DuckDB.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _type_family(name: str) -> str:
    name = name.lower()
    return {"bigint": "long", "integer": "int", "varchar": "string", "boolean": "boolean", "double": "double"}.get(name, name)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(row[i] for i in order) for row in rows]
    return sorted(ordered, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Row count and the list of differences: schema, count, values."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    sql_types = {n: _type_family(str(t)) for n, t in zip(names, con.execute(f"DESCRIBE {sql}").df()["column_type"])}
    expected = _rows(names, con.execute(sql).fetchall())
    actual = _rows(df.columns, df.collect())
    spark_types = {n: {"bigint": "long"}.get(t, t) for n, t in df.dtypes}
    problems = []
    if spark_types != sql_types:
        problems.append(f"schema {sorted(set(spark_types.items()) ^ set(sql_types.items()))}")
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} against {len(expected)}")
    elif actual != expected:
        wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    if any(isinstance(v, float) and math.isnan(v) for row in actual for v in row):
        problems.append("NaN in the result")
    return len(actual), problems


def main() -> int:
    import __spark_entry__ as entry
    from tests.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if name not in sql or wanted and name not in wanted:
            continue
        start = time.time()
        count, problems = compare(spark, con, query, sql[name], sf_dir)
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:32s} {count:8d} rows {time.time() - start:6.2f}s {'; '.join(problems)}")
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
