"""Run registered queries against their DuckDB oracles (like the driver does).

Usage: ``python tests/oracle_check.py [sf_dir] [name-substring ...]``.
Prints one line per query: rows, column match, value match, seconds.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if hasattr(v, "item") and not hasattr(v, "__len__"):
        v = v.item()
    if v is None or (hasattr(v, "__class__") and v.__class__.__name__ in ("NAType", "NaTType")):
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9) + 0.0
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    dd = con.execute(sql).df()
    sc, sr = rows_of(sp)
    dc, dr = rows_of(dd)
    ok_cols = sc == dc
    ok_rows = len(sr) == len(dr)
    ok_vals = ok_cols and sr == dr
    print(f"{name:40s} rows={len(sr):6d}/{len(dr):6d} cols={'ok' if ok_cols else 'DIFF'} "
          f"vals={'ok' if ok_vals else 'DIFF'} spark={t1 - t0:.2f}s", flush=True)
    if not ok_cols:
        print("   spark cols", sc, "\n   duck cols ", dc)
    elif not ok_vals:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        print("   first diffs:", diff)
    return ok_cols and ok_rows and ok_vals


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    pats = argv[2:]
    import __spark_entry__ as E
    from paramo.session import local_session
    spark = local_session(int(os.environ.get("CHECK_CPUS", "8")))
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        if name not in os_:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"{name:40s} rows={n:6d} (no oracle) spark={time.time() - t0:.2f}s", flush=True)
            continue
        try:
            if not compare(spark, name, fn, os_[name], sf_dir, con):
                bad.append(name)
        except Exception as e:  # report and continue
            print(f"{name:40s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
