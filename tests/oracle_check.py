"""Run every registered query and its DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column-name match and an order-insensitive
value hash match.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    lines = sorted("|".join(_norm(r[k]) for k in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from skygrid.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        t1 = time.time()
        if name not in sqls:
            print(f"{name:26s} rows={len(rows):8d} (no oracle) {t1 - t0:6.2f}s")
            continue
        res = con.execute(sqls[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        ok_rows = len(rows) == len(orows)
        ok_cols = sorted(cols) == sorted(ocols)
        ok_hash = ok_cols and digest(cols, rows) == digest(ocols, orows)
        status = "OK " if ok_rows and ok_cols and ok_hash else "BAD"
        bad += status == "BAD"
        print(f"{status} {name:26s} rows={len(rows):8d}/{len(orows):8d} cols={ok_cols} hash={ok_hash} "
              f"{t1 - t0:6.2f}s", flush=True)
        if status == "BAD" and not ok_cols:
            print("   spark:", cols, "\n   duck: ", ocols)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
