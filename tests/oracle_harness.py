"""Run a query in Spark and its SQL in DuckDB on the same parquet folder and
compare: same column names, same row count, same multiset of rows."""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, spark_df, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        sa, sb = set(a), set(b)
        problems.append(f"values differ: only spark {list(sa - sb)[:3]} only duck {list(sb - sa)[:3]}")
    return problems


if __name__ == "__main__":
    import os
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from covtab.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in oracle:
            n = fn(spark, sf_dir).count()
            print(f"{name:24s} rows-only {n} rows {time.time() - t:.1f}s")
            continue
        p = compare(spark, con, name, fn(spark, sf_dir), oracle[name])
        bad += bool(p)
        print(f"{name:24s} {'OK ' if not p else 'BAD'} {time.time() - t:.1f}s {'; '.join(p)}")
    print("mismatches:", bad)
