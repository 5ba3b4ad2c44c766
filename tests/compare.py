"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
    ok = ok_cols and a == b
    detail = ""
    if not ok_cols:
        detail = f"cols spark={sorted(s_cols)} duck={sorted(d_cols)}"
    elif a != b:
        sa, sb = set(a), set(b)
        only_s, only_d = sorted(sa - sb, key=repr)[:3], sorted(sb - sa, key=repr)[:3]
        detail = f"spark-only={only_s}\n    duck-only={only_d}"
    return ok, len(s_rows), len(d_rows), t1 - t0, detail


def main(argv):
    import __spark_entry__ as E
    from creditflow.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    names = argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            ok, ns, nd, secs, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            ok, ns, nd, secs, detail = False, -1, -1, 0, repr(exc)[:2000]
        bad += not ok
        print(f"{name}: {'OK' if ok else 'FAIL'} spark={ns} duck={nd} {secs:.1f}s {detail}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
