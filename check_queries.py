"""Run registered queries next to their SQL check and compare all rows.

    python check_queries.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter

import duckdb

from wellspring import fixtures
from wellspring.registry import ORACLES, QUERIES, load
from wellspring.session import build_session


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, plain(r[i])) for i in order) for r in rows)


def compare(spark, connection, sf_dir: str, name: str, queries=None, oracles=None) -> str:
    """Run query `name` of `queries` and compare it with its SQL in `oracles` (default: the registry's)."""
    queries, oracles = queries or QUERIES, oracles or ORACLES
    df = queries[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if name not in oracles:
        return f"rows {len(got)} (no check)"
    cursor = connection.execute(oracles[name])
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a == b:
        return f"ok {len(got)}"
    extra, missing = list((a - b).items())[:2], list((b - a).items())[:2]
    return f"FAIL {len(got)} vs {len(want)}\n   only spark: {extra}\n   only sql:   {missing}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    load()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for t in fixtures.BASE:
        connection.execute(f"create view {t} as from '{sf_dir}/{t}.parquet'")
    failed = 0
    for name in QUERIES:
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            result = compare(spark, connection, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            result = f"FAIL {type(e).__name__}: {str(e)[:1500]}"
        failed += result.startswith("FAIL")
        print(f"{name:34} {time.time() - start:6.2f}s  {result}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
