"""Runs queries next to their oracles and reports differences.

    python -m daybook_checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from daybook.session import RECOMMENDED_CONF
from daybook_checks.oracles import ORACLES
from daybook_checks.queries import QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, repr(v)) for v in row)


def differences(spark: SparkSession, con, name: str, sf_dir: str) -> tuple[int, list]:
    """Row count of the query, and rows only one side has (first few of each)."""
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    ours = sorted((tuple(r) for r in frame.select(*columns).collect()), key=_sortable)
    result = con.execute(ORACLES[name])
    theirs_columns = [d[0] for d in result.description]
    if sorted(theirs_columns) != columns:
        return len(ours), [("columns", columns, sorted(theirs_columns))]
    order = [theirs_columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_sortable)
    if ours == theirs:
        return len(ours), []
    bad = [pair for pair in zip(ours, theirs, strict=False) if pair[0] != pair[1]]
    return len(ours), [("rows", len(ours), len(theirs), "unequal", len(bad)), *bad[:3]]


def main(argv: list[str]) -> int:
    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    for key, value in {**RECOMMENDED_CONF, "spark.sql.shuffle.partitions": "8"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        rows, diff = differences(spark, con, name, sf_dir)
        print(f"{'ok  ' if not diff else 'DIFF'} {name:22s} {rows:8d} rows {time.time() - start:6.2f}s")
        for line in diff:
            print("     ", line)
        failed += bool(diff)
    missing = sorted(set(QUERIES) ^ set(ORACLES))
    if missing:
        print("without counterpart:", missing)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
