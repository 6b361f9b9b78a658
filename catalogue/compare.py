"""Run queries in Spark and DuckDB and compare the rows: ``python -m catalogue.compare [sf] [key ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from catalogue.oracle import oracle
from catalogue.queries import QUERIES
from murmura.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


def differences(spark, con, sf_dir: str, key: str) -> tuple[int, list[str]]:
    df = QUERIES[key](spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    result = con.execute(oracle()[key])
    columns = [c[0] for c in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return len(ours), [f"columns {sorted(df.columns)} / {sorted(columns)}"]
    left, right = rows(df.columns, ours), rows(columns, theirs)
    if left == right:
        return len(ours), []
    return len(ours), [f"rows {len(left)} / {len(right)}"] + [
        f"{a} / {b}" for a, b in zip(left, right) if a != b
    ][:3]


def main() -> None:
    sf, keys = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(sf_dir)
    failed = 0
    for key in keys or QUERIES:
        started = time.time()
        try:
            n, wrong = differences(spark, con, sf_dir, key)
        except Exception as error:  # report and go on with the next query
            n, wrong = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {key} rows={n} {time.time() - started:.1f}s", flush=True)
        for line in wrong:
            print("     ", line[:1500])
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
