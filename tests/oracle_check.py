"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver does.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from plume.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted(repr([norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(keys).encode()).hexdigest()[:16]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from plume.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.sql(sqls[name])
            ocols, orows = res.columns, res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(ocols)
        ok_n = len(srows) == len(orows)
        ok_h = digest(scols, srows) == digest(ocols, orows)
        status = "OK  " if ok_cols and ok_n and ok_h else "FAIL"
        if status == "FAIL":
            bad += 1
        print(f"{status} {name}: rows {len(srows)}/{len(orows)} cols {'=' if ok_cols else (scols, ocols)} "
              f"hash {'=' if ok_h else '!='} {ts:.1f}s")
        if status == "FAIL" and ok_n and ok_cols:
            o = sorted(range(len(scols)), key=lambda i: scols[i])
            oo = sorted(range(len(ocols)), key=lambda i: ocols[i])
            a = sorted(repr([norm(r[i]) for i in o]) for r in srows)
            b = sorted(repr([norm(r[i]) for i in oo]) for r in orows)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diff:
                print("   spark :", x[:300]); print("   oracle:", y[:300])
    print(f"done, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
