"""Compare registered queries with their SQL twins.

    python -m tests.compare [data directory] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _comparable(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(_comparable(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(value is not None, str(type(value)), value) for value in row])


def difference(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if rows and column names are equal, otherwise what differs."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    wanted = _sorted_rows(names, result.fetchall())
    got = _sorted_rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if len(wanted) != len(got):
        return f"{len(got)} rows against {len(wanted)}"
    for mine, theirs in zip(got, wanted, strict=True):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"row {mine} against {theirs}"
    return None


def main() -> int:
    from storelens.plans.oracle import ORACLE
    from storelens.plans.registry import QUERIES
    from storelens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names:
        started = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problem = difference(frame, connection, ORACLE[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        kind = "sql" if name in ORACLE else "rows"
        print(f"{name:28s} {kind:5s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
