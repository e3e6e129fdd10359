"""Run each registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tests/compare.py [sf_dir] [query ...]
Compares row count, column names and the order-insensitive multiset of rows
(floats compared after rounding to 9 significant digits).
"""
import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from pacekit.plans.analog import TABLES  # noqa: E402
from pacekit.session import build_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    ok = 0
    for n in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[n](spark, sf)
            cols = sdf.columns
            srows = [tuple(norm(v) for v in r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        if n not in sql:
            print(f"ROWS {n}: {len(srows)} rows (no oracle) {time.time()-t0:.1f}s")
            continue
        try:
            cur = con.execute(sql[n])
            dcols = [d[0] for d in cur.description]
            drows = [tuple(norm(v) for v in r) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            continue
        if sorted(cols) != sorted(dcols):
            print(f"FAIL {n}: columns differ spark={cols} duck={dcols}")
            continue
        idx = [dcols.index(c) for c in cols]
        drows = [tuple(r[i] for i in idx) for r in drows]
        a, b = sorted(srows, key=key), sorted(drows, key=key)
        if a == b:
            ok += 1
            print(f"OK   {n}: {len(a)} rows {time.time()-t0:.1f}s")
        else:
            print(f"FAIL {n}: spark={len(a)} duck={len(b)} rows")
            sa, sb = set(a), set(b)
            only_s, only_d = [r for r in a if r not in sb][:3], [r for r in b if r not in sa][:3]
            for r in only_s:
                print("   spark:", dict(zip(cols, r)))
            for r in only_d:
                print("   duck :", dict(zip(cols, r)))
    print(f"{ok} ok")


if __name__ == "__main__":
    main()
