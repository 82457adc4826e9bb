"""Run registered queries in Spark and their SQL twins in DuckDB, and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, rows (spark/duckdb), and OK / MISMATCH.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        try:
            import pandas as pd
            v = pd.Timestamp(v)
            if v.tzinfo is not None:
                v = v.tz_convert("UTC").tz_localize(None)
            return v.isoformat()
        except Exception:
            return str(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return f"{name:28s} spark={len(srows):8d} ({t1 - t0:5.1f}s) rows-only"
    rel = con.sql(sql)
    drows = rel.fetchall()
    dcols = rel.columns
    t2 = time.time()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    ok = sc == dc and sr == dr
    msg = f"{name:28s} spark={len(srows):8d} duck={len(drows):8d} ({t1 - t0:5.1f}s/{t2 - t1:5.1f}s) {'OK' if ok else 'MISMATCH'}"
    if not ok:
        if sc != dc:
            msg += f"\n   cols spark={sc}\n   cols duck ={dc}"
        else:
            a, b = set(sr), set(dr)
            msg += f"\n   only spark: {sorted(a - b, key=str)[:3]}\n   only duck : {sorted(b - a, key=str)[:3]}"
    return msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from hexflow.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            line = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            line = f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += ("MISMATCH" in line) or ("ERROR" in line)
        print(line, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
