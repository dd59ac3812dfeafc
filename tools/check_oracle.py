"""Run registry queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [--only a01,a02] [--write-types]

Comparison mirrors the driver: row count, column names (sorted) and an
order-insensitive hash of the values; on a hash mismatch the first differing
rows are printed with a numeric tolerance check.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    return repr(v)


def table_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def close(a, b):
    if a == b:
        return True
    try:
        return abs(float(a) - float(b)) <= 1e-6 * max(1.0, abs(float(a)))
    except (TypeError, ValueError):
        return False


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--only", default="")
    ap.add_argument("--write-types", action="store_true")
    a = ap.parse_args()
    from riskweave.session import build_session
    from riskweave.plans import registry
    from riskweave.plans import oracle as O
    spark = build_session("local[8]")
    con = duck(a.sf)
    names = [n for n in registry.QUERIES if not a.only or any(n.startswith(p) for p in a.only.split(","))]
    types = O.result_types()
    if a.write_types:
        for n in names:
            df = registry.QUERIES[n](spark, a.sf)
            types[n] = [[f.name, registry.kind_of(f.dataType)] for f in df.schema.fields]
        with open(O._TYPES_FILE, "w") as fh:
            json.dump(types, fh, indent=0, sort_keys=True)
        print("types written for", len(names))
    oracle = registry.oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        df = registry.QUERIES[n](spark, a.sf)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        ts = time.time() - t0
        if n not in oracle:
            print(f"{n:32s} rows-only  spark={len(srows)} ({ts:.1f}s)")
            continue
        try:
            res = con.execute(oracle[n])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{n:32s} ORACLE ERROR {str(e)[:300]}")
            continue
        hs, ls = table_hash(scols, srows)
        ho, lo = table_hash(ocols, orows)
        ok = (len(srows) == len(orows)) and sorted(scols) == sorted(ocols) and hs == ho
        status = "OK" if ok else "MISMATCH"
        print(f"{n:32s} {status:8s} rows {len(srows)}/{len(orows)} ({ts:.1f}s)")
        if not ok:
            bad += 1
            if sorted(scols) != sorted(ocols):
                print("   cols spark-only", sorted(set(scols) - set(ocols)), "oracle-only", sorted(set(ocols) - set(scols)))
            else:
                diff = [(x, y) for x, y in zip(ls, lo) if x != y][:3]
                for x, y in diff:
                    xs, ys = x.split("|"), y.split("|")
                    tol = all(close(p, q) for p, q in zip(xs, ys))
                    keys = sorted(scols)
                    d = [(keys[i], xs[i], ys[i]) for i in range(len(xs)) if xs[i] != ys[i]]
                    print("   diff", "(within tol)" if tol else "", d[:6])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
