"""Spark-vs-DuckDB comparison in the shape the round checker uses.

Row count, column names and an order-insensitive value comparison (rows
sorted after normalising every value to text).
"""

from __future__ import annotations

import math
import os
import sys

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 9))
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def normalise(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in
            df[cols].astype(object).where(pd.notna(df[cols]), None).itertuples(index=False)]
    return sorted(rows)


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} duck={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count differs: spark={len(s)} duck={len(d)}"
    a, b = normalise(s), normalise(d)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s)} rows"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from fraudflow.session import get_spark

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    if os.environ.get("BARE"):
        # a plain session, as an outside checker would build it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = get_spark("local[8]")
    if os.environ.get("SPARK_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["SPARK_TZ"])
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            df = fn(spark, sf)
            if name in sqls:
                ok, msg = compare(df, sqls[name], con)
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    print(f"{bad} failing")
