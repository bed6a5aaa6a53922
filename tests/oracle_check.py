"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares column names, row counts and the multiset of rows (floats rounded).
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as E  # noqa: E402
from rosterframe.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    ts = time.time() - t0
    scols = df.columns
    if sql is None:
        return key, "rows-only", len(srows), None, ts
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    sc, sm = canon(scols, srows)
    dc, dm = canon(dcols, drows)
    if sc != dc:
        return key, f"COLUMNS {sorted(set(sc) ^ set(dc))}", len(srows), len(drows), ts
    if sm != dm:
        diff = list((sm - dm).items())[:2], list((dm - sm).items())[:2]
        return key, f"VALUES differ {diff}", len(srows), len(drows), ts
    return key, "ok", len(srows), len(drows), ts


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or sorted(qs):
        try:
            res = check(spark, con, sf_dir, key, qs[key], sqls.get(key))
        except Exception as e:  # noqa: BLE001
            res = (key, f"ERROR {type(e).__name__}: {str(e)[:400]}", None, None, 0)
        ok = res[1] in ("ok", "rows-only")
        bad += not ok
        print(f"{res[0]:38s} {res[1][:600]:10s} spark={res[2]} oracle={res[3]} {res[4]:.1f}s", flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
