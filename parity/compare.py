"""Run queries and their SQL side by side: ``python -m parity.compare SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from parity import oracle_sql, spark_queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _ordered(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty where column names and the multiset of rows are equal."""
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    ours, theirs = _ordered(rows, df.columns), _ordered(result.fetchall(), names)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(unequal)} of {len(ours)} rows differ, first {unequal[0]}" if unequal else ""


def main() -> int:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(sf_dir), spark_queries.registry(), oracle_sql.registry()
    failed = 0
    for name in wanted or queries:
        started = time.time()
        try:
            problem = differences(queries[name](spark, sf_dir), con, oracles[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name:28s} {time.time() - started:6.2f}s {problem or 'equal'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
