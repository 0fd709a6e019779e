"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [key-regex]

Comparison: same column names, same row count, equal multiset of rows after
sorting columns by name (values stringified; floats via repr after rounding).
"""

from __future__ import annotations

import math
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _cell(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key, build, sql, sf_dir):
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"key": key, "status": "rows-only", "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"key": key, "rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        out["status"] = "ok"
    else:
        sa, sb = set(a), set(b)
        out["status"] = "MISMATCH"
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_duck"] = sorted(sb - sa)[:3]
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pat = re.compile(sys.argv[2]) if len(sys.argv) > 2 else None
    from tillwise.session import get_session
    from tillwise.catalog import REGISTRY, oracle_text
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for key, e in REGISTRY.items():
        if pat and not pat.search(key):
            continue
        try:
            r = compare(spark, con, key, e.build, oracle_text(e), sf_dir)
        except Exception as ex:  # report and continue
            r = {"key": key, "status": f"ERROR {type(ex).__name__}: {str(ex)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"done: {bad} failing", flush=True)


if __name__ == "__main__":
    main()
