"""Run contract queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Compares row count, column names, and the sorted multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v + 0.0 if os.environ.get("EXACT") else round(v, 9) + 0.0
    if hasattr(v, "as_tuple"):  # Decimal
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(norm(v) for v in r) for r in sdf.collect()]
    ts = time.time() - t
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = [tuple(norm(v) for v in r) for r in res.fetchall()]
    ok_cols = s_cols == d_cols
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    if ok_cols:
        s_sorted = sorted((tuple(r[i] for i in order) for r in s_rows), key=key)
        d_sorted = sorted((tuple(r[i] for i in order) for r in d_rows), key=key)
        ok_vals = s_sorted == d_sorted
    else:
        ok_vals = False
    status = "OK " if (ok_cols and ok_vals and len(s_rows) == len(d_rows)) else "BAD"
    print(f"{status} {name:32s} spark={len(s_rows):6d} duck={len(d_rows):6d} "
          f"cols={'ok' if ok_cols else 'DIFF'} vals={'ok' if ok_vals else 'DIFF'} {ts:5.1f}s",
          flush=True)
    if not ok_cols:
        print("   spark:", s_cols, "\n   duck: ", d_cols)
    elif not ok_vals:
        sset, dset = set(s_sorted), set(d_sorted)
        names = [s_cols[i] for i in order]
        print("   cols:", names)
        for r in sorted(sset - dset, key=key)[:4]:
            print("   spark only:", r)
        for r in sorted(dset - sset, key=key)[:4]:
            print("   duck only: ", r)
    return status == "OK "


def main():
    import __spark_entry__ as E
    from skylane.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in (names or sorted(qs)):
        if n not in sqls:
            print(f"--  {n:32s} (no oracle)")
            continue
        bad += not compare(spark, con, n, qs[n], sqls[n], sf_dir)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
