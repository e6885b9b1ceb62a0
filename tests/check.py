"""Compare registered queries with their check SQL: names, types, row count and values.

Usage: python tests/check.py [scale] [key ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata"


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.10g}") + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(plain(v) for v in row) for row in zip(*columns)]
    return names, [str(table.schema.field(n).type) for n in names], sorted(rows, key=repr)


def same_type(a: str, b: str) -> bool:
    clean = [t.replace("large_", "").replace("timestamp[us]", "timestamp") for t in (a, b)]
    return clean[0] == clean[1] or all(t.startswith("list") for t in clean)


def compare(spark, con, key: str, folder: str, queries, oracles) -> str:
    df = queries[key](spark, folder)
    ours = rows_of(df.toArrow())
    if key not in oracles:
        return f"rows only ({len(ours[2])})"
    theirs = rows_of(con.execute(oracles[key]).to_arrow_table())
    if ours[0] != theirs[0]:
        return f"MISMATCH names {ours[0]} {theirs[0]}"
    bad = [(n, a, b) for n, a, b in zip(ours[0], ours[1], theirs[1]) if not same_type(a, b)]
    if bad:
        return f"MISMATCH types {bad}"
    if len(ours[2]) != len(theirs[2]):
        return f"MISMATCH rows {len(ours[2])} {len(theirs[2])}"
    diff = [(a, b) for a, b in zip(ours[2], theirs[2]) if a != b]
    if diff:
        return f"MISMATCH values in {len(diff)} of {len(ours[2])}: {ours[0]} {diff[:2]}"
    return f"ok ({len(ours[2])})"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from shiftloom.session import local_session

    args = sys.argv[1:]
    scale = args[0] if args else "0.01"
    folder = f"{DATA}/sf{scale}"
    spark, con = local_session(8), duck(folder)
    qs, os_ = queries(), oracle_sql()
    failed = 0
    for key in args[1:] or sorted(qs):
        begun = time.time()
        try:
            result = compare(spark, con, key, folder, qs, os_)
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        failed += not (result.startswith("ok") or result.startswith("rows"))
        print(f"{key:28s} {time.time() - begun:6.2f}s {result}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
