"""Run registered queries in Spark and their SQL in DuckDB, compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and row values (order-insensitive, doubles
to 6 places, NaN/inf kept as text).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for r in records:
        out.append(tuple(_norm(r[i]) for i in order))
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(ts, 2))
    d = con.execute(sql)
    d_cols = [c[0] for c in d.description]
    d_rows = d.fetchall()
    res = dict(name=name, rows=len(s_rows), duck_rows=len(d_rows), spark_s=round(ts, 2))
    if sorted(s_cols) != sorted(d_cols):
        res.update(ok=False, why=f"columns {sorted(s_cols)} != {sorted(d_cols)}")
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if len(a) != len(b):
        res.update(ok=False, why="row count")
        return res
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    res.update(ok=not bad)
    if bad:
        res["why"] = f"{len(bad)} rows differ, first: {bad[0]}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from wearcast.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        failed += r.get("ok") is False
        print(r, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
