"""Batch table sources and sinks (SRC1, SRC2, SNK3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TRANSACTION_SCHEMA


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv",
                      schema=TRANSACTION_SCHEMA) -> DataFrame:
    """SRC1: labelled transactions with the declared schema.

    CSV: header row, PERMISSIVE (a malformed cell becomes null, the row is
    kept).  Parquet / JSON / ORC read with the same schema.
    """
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("mode", "PERMISSIVE").csv(path)
    return r.format(fmt).load(path)


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: exploratory CSV read with inferred types (empty cell -> null).

    Inference costs a full extra pass over the files; production reads use
    ``read_transactions``.
    """
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def write_sorted(df: DataFrame, path: str, order: str = "timestamp", fmt: str = "csv") -> None:
    """SNK3: total sort (range-partitioned, so part files are in key order)
    and write with a header, no index column."""
    w = df.orderBy(F.col(order).asc_nulls_first(), *[c for c in df.columns if c != order]).write
    if fmt == "csv":
        w.mode("overwrite").option("header", True).csv(path)
    else:
        w.mode("overwrite").format(fmt).save(path)
