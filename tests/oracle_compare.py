"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Comparison mirrors the driver's: columns sorted by name, row counts equal,
and the multiset of rows equal (floats compared after rounding to 9 digits).

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone='UTC'")
    return con


def compare(spark_df, con, sql):
    s_cols = sorted(spark_df.columns)
    rows = spark_df.select(*s_cols).collect()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_sorted = [tuple(r[i] for i in order) for r in d_rows]
    problems = []
    if s_cols != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} oracle={sorted(d_cols)}")
        return problems, len(rows), len(d_rows)
    if len(rows) != len(d_rows):
        problems.append(f"row count spark={len(rows)} oracle={len(d_rows)}")
    a = Counter(tuple(_norm(v) for v in r) for r in rows)
    b = Counter(tuple(_norm(v) for v in r) for r in d_sorted)
    if a != b:
        only_a = list((a - b).elements())[:3]
        only_b = list((b - a).elements())[:3]
        problems.append(f"values differ; spark-only {only_a}; oracle-only {only_b}")
    return problems, len(rows), len(d_rows)


def main(argv):
    from starloom.session import get_spark
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name not in sql:
                n = df.count()
                print(f"{name:34s} rows-only {n} ({time.time() - t:.1f}s)", flush=True)
                continue
            problems, ns, nd = compare(df, con, sql[name])
        except Exception as e:  # noqa: BLE001
            problems, ns, nd = [f"ERROR {type(e).__name__}: {str(e)[:600]}"], -1, -1
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{name:34s} {status} spark={ns} oracle={nd} ({time.time() - t:.1f}s)", flush=True)
        for p in problems:
            print("    " + p, flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
