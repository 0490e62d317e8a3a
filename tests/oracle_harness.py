"""Run registered queries against their DuckDB oracle SQL and compare rows.

Usage:  python tests/oracle_harness.py [sf_dir] [name ...]
Comparison: same row count, same column names, and equal multisets of rows
after sorting columns by name, rounding floats to 6 places and turning
arrays into tuples.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    import numpy as np
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6) + 0.0
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (pd.Timestamp,)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (bool, np.bool_)):
        return int(v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark, con, name, q, sf_dir):
    t0 = time.time()
    sp = q.run(spark, sf_dir).toPandas()
    t1 = time.time()
    if q.sql is None:
        return {"name": name, "ok": None, "rows": len(sp), "spark_s": round(t1 - t0, 2)}
    dk = con.execute(q.sql).df()
    sc, sr = rows_of(sp)
    dc, dr = rows_of(dk)
    res = {"name": name, "rows": len(sr), "oracle_rows": len(dr), "spark_s": round(t1 - t0, 2)}
    if sc != dc:
        res.update(ok=False, why=f"columns {sc} vs {dc}")
    elif len(sr) != len(dr):
        res.update(ok=False, why="row count")
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        res.update(ok=False, why=f"values e.g. {bad}")
    else:
        res.update(ok=True)
    return res


def main():
    from tidemark.plans.registry import load_all
    from tidemark.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs = load_all()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad}")


if __name__ == "__main__":
    main()
