"""Run registered queries beside their SQL in DuckDB and compare every value.

    python check_oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from rowmill.registry import Query, all_queries
from rowmill.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _bag(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(query: Query, spark: SparkSession, connection, sf_dir: str) -> str | None:
    """None when equal, else what differs; queries without SQL are only run."""
    result: DataFrame = query.run(spark, sf_dir)
    allowed = {"bigint", "int", "double", "string", "boolean", "date", "timestamp_ntz"}
    odd = [f"{n} {t}" for n, t in result.dtypes if t not in allowed]
    if odd:
        return f"column types {odd}"
    rows = [tuple(row) for row in result.collect()]
    if query.sql is None:
        return None if rows else "no rows"
    answer = connection.execute(query.sql)
    names = [column[0] for column in answer.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    ours, theirs = _bag(result.columns, rows), _bag(names, answer.fetchall())
    if ours == theirs:
        return None if ours else "no rows on either side"
    extra = sorted(set(ours) - set(theirs))[:3]
    missing = sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} rows != {len(theirs)} rows; only ours {extra}; only SQL {missing}"[:1500]


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_oracle(args.sf)
    bad = 0
    for name, query in all_queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            problem = difference(query, spark, connection, args.sf)
        except Exception as error:  # noqa: BLE001 - report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if query.sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
