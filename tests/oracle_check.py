"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    want_cols, want = [d[0] for d in rel.description], rel.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = _rows(got, got_cols), _rows(want, want_cols)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{sum(p != q for p, q in zip(a, b))} rows differ, first {str(x)[:300]} != {str(y)[:300]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from noticemill.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if args and name not in args:
            continue
        t = time.time()
        try:
            if name in sqls:
                diff = compare(spark, con, fn, sqls[name], sf_dir)
            else:
                diff = None if fn(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - t:.1f}s {diff or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
