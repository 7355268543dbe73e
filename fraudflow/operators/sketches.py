"""Mergeable sketches of distinct senders (AG16, Q4).

A window's distinct senders are kept as a HyperLogLog sketch instead of a
number.  Sketches of small windows are stored once and merged by union into
any larger window, without the transactions: two minutes to a day, or the
parts of a table loaded one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import WINDOW_2M
from .windows import flatten_window

LG_K = 12  # 4,096 registers: a standard error of about 1.6 %


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def sender_sketches(fraud: DataFrame, duration: str = WINDOW_2M, lg_k: int = LG_K) -> DataFrame:
    """receiver_account, window_start, window_end, senders (a sketch), of a batch or a stream; null senders don't count."""
    known = F.col("sender_account")
    return flatten_window(fraud.groupBy(F.window("event_time", duration).alias("window"), "receiver_account")
                          .agg(F.hll_sketch_agg(known, lg_k).alias("senders")))


def merge_windows(sketches: DataFrame, duration: str) -> DataFrame:
    """The sketches of larger windows, by union of the stored ones, filed under the window that holds their start."""
    start = F.col("window_start").cast("timestamp")
    return flatten_window(sketches.groupBy(F.window(start, duration).alias("window"), "receiver_account")
                          .agg(F.hll_union_agg("senders").alias("senders")))


def distinct_senders() -> Column:
    """The estimate of a sketch."""
    return F.hll_sketch_estimate("senders")


def suspicious_from_sketches(sketches: DataFrame, threshold: int = 10, suffix: str = "_2m") -> DataFrame:
    """Q4 read from stored sketches: receivers of at least ``threshold`` senders."""
    name = f"approx_distinct_senders{suffix}"
    out = sketches.withColumn(name, distinct_senders()).where(F.col(name) >= threshold)
    return out.select("receiver_account", name, "window_start", "window_end")
