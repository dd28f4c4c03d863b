"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime) and v.time() == datetime.time(0):
        v = v.date()
    if hasattr(v, "item"):
        v = v.item()
    return v


def rows_of(df_pd) -> list[tuple]:
    cols = sorted(df_pd.columns)
    out = [tuple(_norm(r[c]) for c in cols) for _, r in df_pd.iterrows()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as e
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = e.queries()[name](spark, sf_dir)
    sp = sdf.toPandas()
    t1 = time.time()
    od = con.sql(e.oracle_sql()[name]).df()
    t2 = time.time()
    if sorted(sp.columns) != sorted(od.columns):
        return False, f"columns differ: {sorted(sp.columns)} vs {sorted(od.columns)}"
    a, b = rows_of(sp), rows_of(od)
    if len(a) != len(b):
        return False, f"row count {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    msg = f"{len(a)} rows spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s"
    if bad:
        return False, msg + f"; {len(bad)} differ, first: {bad[0][0]} vs {bad[0][1]}"
    return True, msg


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    import __spark_entry__ as e
    names = argv[1:] or sorted(e.oracle_sql())
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    fails = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as ex:  # noqa: BLE001
            ok, msg = False, f"error: {str(ex)[:800]}"
        fails += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n}: {msg}", flush=True)
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
