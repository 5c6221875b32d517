"""Run a registered Spark query and its DuckDB oracle, compare as multisets.

Columns are compared by name (sorted), rows order-insensitively; doubles are
compared after rounding to 9 significant digits. Usable as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

VIEWS = ("events", "nation", "region")


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"  # compare doubles bit for bit


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if EXACT:
            return v
        if v == 0:
            return 0.0
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return cols, sorted(out, key=_key)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from fareline.oracle import ORACLE_SQL
    from fareline.plans.catalog import QUERIES

    con = con or duck(sf_dir)
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    cur = con.execute(ORACLE_SQL[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    sc, sr = canon(df.columns, s_rows)
    dc, dr = canon(d_cols, d_rows)
    res = {
        "name": name,
        "spark_rows": len(sr),
        "oracle_rows": len(dr),
        "columns_match": sc == dc,
        "values_match": sc == dc and sr == dr,
        "spark_sec": round(t1 - t0, 3),
    }
    if not res["values_match"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["only_spark"], res["only_oracle"] = diff_s, diff_d
    return res


if __name__ == "__main__":
    from fareline.plans.catalog import QUERIES
    from fareline.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session()
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:400]}
        ok = r.get("values_match")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
