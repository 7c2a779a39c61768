"""Run registered queries on Spark and their oracle SQL on DuckDB, and compare.

usage: python tools/oracle_check.py [--sf DIR] [name ...]

Comparison: same column names (sorted), same row count, and the same
multiset of rows after normalising numbers (ints as ints, floats as repr).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT or v is pd.NA:
            return None
    except Exception:
        pass
    if isinstance(v, bool):
        return v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(norm(x) for x in v.tolist())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", type=int, default=3)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()

    from pricelens.registry import oracles, queries
    from pricelens.session import build_session

    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(a.sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, os_ = queries(), oracles()
    names = a.names or list(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sp = qs[n](spark, a.sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if n not in os_:
            print(f"ROWS {n}: {len(sp)} rows (no oracle) spark {ts:.1f}s")
            continue
        try:
            dk = con.execute(os_[n]).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        c1, r1 = rows_of(sp)
        c2, r2 = rows_of(dk)
        if c1 != c2:
            print(f"FAIL {n}: columns {c1} vs {c2}")
            bad += 1
            continue
        if len(r1) != len(r2):
            print(f"FAIL {n}: rows {len(r1)} vs {len(r2)}")
            bad += 1
            continue
        if r1 != r2:
            diff = [(x, y) for x, y in zip(r1, r2) if x != y]
            print(f"FAIL {n}: {len(diff)} differing rows of {len(r1)}; e.g.")
            for x, y in diff[: a.show]:
                print("   spark ", x)
                print("   duckdb", y)
            bad += 1
            continue
        print(f"OK   {n}: {len(r1)} rows, spark {ts:.1f}s")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
