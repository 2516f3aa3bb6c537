"""Run queries and their oracle side by side: ``python -m checks.compare [sf] [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

import duckdb

from checks.registry import ORACLE, QUERIES
from taxaloom.session import local_session


def rows_of(frame) -> list[str]:
    columns = sorted(frame.columns)
    return sorted(map(repr, frame[columns].astype(object).values.tolist()))


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return duck


def main(sf: str = "0.01", *wanted: str) -> int:
    sf_dir = f"/root/testdata/sf{sf}"
    spark, duck = local_session(8), views(sf_dir)
    bad = 0
    for name in wanted or QUERIES:
        try:
            start = time.time()
            found = QUERIES[name](spark, sf_dir).toPandas()
            seconds = time.time() - start
            if name not in ORACLE:
                print(f"rows  {name} {len(found)} {seconds:.1f}s", flush=True)
                continue
            start = time.time()
            wanted_rows = duck.execute(ORACLE[name]).df()
            duck_seconds = time.time() - start
            a, b = rows_of(found), rows_of(wanted_rows)
            types = {c: (str(found[c].dtype), str(wanted_rows[c].dtype)) for c in found.columns
                     if c in wanted_rows and found[c].dtype != wanted_rows[c].dtype}
            ok = sorted(found.columns) == sorted(wanted_rows.columns) and a == b
            bad += not ok or bool(types)
            print(f"{'ok   ' if ok else 'DIFF '} {name} {len(a)} {len(b)} {seconds:.1f}s"
                  f" duck {duck_seconds:.1f}s {types or ''}", flush=True)
            if not ok:
                print("  columns", sorted(found.columns), sorted(wanted_rows.columns))
                print("  only spark", sorted(set(a) - set(b))[:3])
                print("  only duck ", sorted(set(b) - set(a))[:3])
        except Exception as error:
            bad += 1
            print(f"FAIL  {name} {type(error).__name__} {str(error)[:600]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print("bad", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
