"""Intermediate tables on shared storage."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, work_path


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes inside give up their shuffle files when they are done, instead of when the driver happens to collect garbage."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back.

    Used where a result is read more than once, where a lost executor mustn't
    cost a long recomputation, and where a side of a join should come from a
    plain shuffle, so that Spark can split a hot key of the other side.
    """
    path = work_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


GROUP_BYTES = 32 << 20  # of text, whose words a task takes in as one group


def group_count(docs: DataFrame, text_col: str = "text") -> int:
    """How many groups the words of ``docs`` are dealt to: of about GROUP_BYTES of text, and two a shuffle partition at least."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP_BYTES))


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()``, stored, without the tables that were stored on the way: they are removed."""
    path = work_path(spark, name)
    with scratch(spark, f"{name}-scratch"):
        df = make()
        with shuffles_dropped(spark):
            df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
