"""Runs queries and their SQL side by side.

As a script: ``oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark_result: DataFrame, connection, sql: str) -> tuple[int, str]:
    """Row count and a description of what differs ('' when equal)."""
    ours = _bag(spark_result.columns, [tuple(r) for r in spark_result.collect()])
    relation = connection.sql(sql)
    theirs = _bag(relation.columns, relation.fetchall())
    if sorted(spark_result.columns) != sorted(relation.columns):
        return sum(ours.values()), f"columns {spark_result.columns} against {relation.columns}"
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        return sum(ours.values()), (
            f"{sum(only_ours.values())} rows only here, e.g. {list(only_ours)[:2]};"
            f" {sum(only_theirs.values())} only in SQL, e.g. {list(only_theirs)[:2]}"
        )
    return sum(ours.values()), ""


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as registry
    from conftest import new_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = new_session(), connect(sf_dir)
    queries, sql = registry.queries(), registry.oracle_sql()
    for name in sys.argv[2:] or sql:
        start = time.time()
        result = queries[name](spark, sf_dir)
        rows, problem = difference(result, connection, sql[name])
        seconds = time.time() - start
        print(f"{name:32s} {rows:8d} rows {seconds:6.2f}s  {problem or 'ok'}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
