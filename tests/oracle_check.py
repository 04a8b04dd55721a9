"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0  # exact: the driver hashes values, so no extra rounding here
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    t1 = time.time()
    cols = sorted(sdf.columns)
    if sql is None:
        return True, f"{name}: rows-only {len(srows)} ({t1 - t0:.1f}s)"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    if sorted(dcols) != cols:
        return False, f"{name}: columns differ spark={cols} duck={sorted(dcols)}"
    a = sorted((tuple(norm(r[c]) for c in cols) for r in srows), key=repr)
    b = sorted((tuple(norm(r[c]) for c in cols) for r in drows), key=repr)
    if len(a) != len(b):
        return False, f"{name}: rows spark={len(a)} duck={len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{name}: {len(bad)} rows differ, first spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{name}: ok {len(a)} rows ({t1 - t0:.1f}s)"


def main():
    from ledgerlens.session import get_spark
    import __spark_entry__ as E
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    fails = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            ok, msg = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        fails += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{fails} failures")


if __name__ == "__main__":
    main()
