"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python scripts/check_oracles.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the
values (floats rounded to 6 decimals, timestamps as ISO text).
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tributary.session import build_session  # noqa: E402
from tributary.plans.registry import load_all  # noqa: E402
from tributary.sources.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]
    return [columns[i] for i in order], len(rows), h, lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    bad = 0
    for name, q in sorted(load_all().items()):
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(q.sql)
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sn, sh, sl = digest(scols, srows)
        dc, dn, dh, dl = digest(dcols, drows)
        if sc == dc and sn == dn and sh == dh:
            print(f"OK   {name}: {sn} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {name}: cols {sc} vs {dc}; rows {sn} vs {dn}")
            only_s = sorted(set(sl) - set(dl))[:3]
            only_d = sorted(set(dl) - set(sl))[:3]
            print("   spark-only:", only_s)
            print("   duck-only: ", only_d)
    spark.stop()
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
