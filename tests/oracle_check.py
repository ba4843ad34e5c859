"""Spark result vs DuckDB oracle on the driver tables (the driver's gate,
re-run locally).  Usage: python tests/oracle_check.py [sf_dir] [key ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(_norm(r[c]) for c in sorted(sdf.columns)) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    d_rows = [tuple(_norm(dict(zip(cols, r))[c]) for c in sorted(cols)) for r in cur.fetchall()]
    ok_cols = sorted(sdf.columns) == sorted(cols)
    same = ok_cols and Counter(s_rows) == Counter(d_rows)
    detail = ""
    if not same:
        if not ok_cols:
            detail = f"cols spark={sorted(sdf.columns)} duck={sorted(cols)}"
        else:
            a, b = Counter(s_rows), Counter(d_rows)
            detail = f"only spark: {list((a - b).elements())[:3]} only duck: {list((b - a).elements())[:3]}"
    print(f"{'OK ' if same else 'BAD'} {name:24s} rows={len(s_rows)}/{len(d_rows)} "
          f"spark={t1 - t0:.1f}s {detail}", flush=True)
    return same


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from railflow.session import get_session
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = []
    for name in qs:
        if only and name not in only:
            continue
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"--  {name:24s} rows={n} (no oracle)")
            continue
        try:
            if not compare(spark, con, name, qs[name], sqls[name], sf_dir):
                bad.append(name)
        except Exception as e:  # report and go on
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}")
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
