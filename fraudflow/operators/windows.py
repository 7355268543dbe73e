"""Event-time window aggregates (Q1-Q4, Q6; AG12-AG16, ST1-ST2, FN20).

Every function is ``DataFrame -> DataFrame`` and works unchanged on a batch
frame and on a streaming frame that carries a watermark (see
``with_event_time``).  Each is one ``groupBy(window, key)`` aggregate:
Spark runs it as partial (map-side) + final aggregation, so a hot window or
a hot transaction type never moves more than one partial row per task
through the shuffle.

Money is summed as DECIMAL(38, 10) (``money_sum``): exact, so equal on every
partitioning, for amounts up to 1e28.  Results are doubles and not rounded.  A
NaN or infinite amount counts as a row but adds nothing to sums and averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import parse_event_time, safe_div
from ..schema import WATERMARK_2M, WINDOW_2M

def money(c="amount") -> Column:
    """Amount as an exact decimal; NaN, infinite and unrepresentable ones are null."""
    return F.col(c).try_cast("decimal(38,10)")


def money_sum(c="amount") -> Column:
    """Sum of the representable amounts, 0.0 without any, null where it exceeds the decimal."""
    total = F.coalesce(F.try_sum(money(c)), F.when(F.count(money(c)) == 0, F.lit(0)))
    return total.cast("double")


def money_avg(c="amount") -> Column:
    return F.when(F.count(money(c)) > 0, F.try_sum(money(c)).cast("double") / F.count(money(c)))


def with_event_time(df: DataFrame, watermark: str | None = WATERMARK_2M,
                    text_col: str = "timestamp", out: str = "event_time") -> DataFrame:
    """FN1 + ST1: parse the text timestamp and (optionally) set a watermark.

    A frame that already has ``event_time`` keeps it.  Streams need the
    watermark on a TIMESTAMP column; batch frames keep TIMESTAMP_NTZ.
    """
    if out not in df.columns:
        df = df.withColumn(out, parse_event_time(text_col))
    if watermark is not None:
        df = df.withColumn(out, F.col(out).cast("timestamp")).withWatermark(out, watermark)
    return df


def _windowed(df: DataFrame, duration: str, keys: list[str], aggs: list[Column],
              time_col: str = "event_time", flatten: bool = True) -> DataFrame:
    w = F.window(F.col(time_col), duration).alias("window")
    agg = df.groupBy(w, *keys).agg(*aggs)
    return flatten_window(agg) if flatten else agg


def flatten_window(df: DataFrame) -> DataFrame:
    """FN20: ``window`` struct -> window_start / window_end (wall clock)."""
    names = [c for c in df.columns if c != "window"]
    return df.select(*names,
                     F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window.end").cast("timestamp_ntz").alias("window_end"))


def fraud_loss(fraud: DataFrame, duration: str = WINDOW_2M, suffix: str = "_2m") -> DataFrame:
    """Q2: fraud count and loss per window."""
    return _windowed(fraud, duration, [], [
        F.count(F.lit(1)).alias(f"fraud_count{suffix}"), money_sum().alias(f"fraud_loss{suffix}")])


def fraud_minmax(fraud: DataFrame, duration: str = WINDOW_2M, suffix: str = "_2m") -> DataFrame:
    """Q3: min / max fraud amount per window."""
    return _windowed(fraud, duration, [], [
        F.min("amount").alias(f"min_fraud_amount{suffix}"),
        F.max("amount").alias(f"max_fraud_amount{suffix}")])


def fraud_rate(flagged: DataFrame, is_fraud: Column, duration: str = WINDOW_2M,
               suffix: str = "_2m") -> DataFrame:
    """Q1 as one conditional aggregate over a flagged stream.

    ``is_fraud`` marks the fraud rows of the full stream (e.g.
    ``fraud_source IS NOT NULL``).  One pass, no stream-stream join: the
    total, the fraud count and the rate come out of the same aggregate.
    """
    out = _windowed(flagged, duration, [], [
        F.count(F.lit(1)).alias(f"total_tx{suffix}"),
        F.count_if(F.coalesce(is_fraud, F.lit(False))).alias(f"fraud_tx{suffix}")])
    return out.withColumn(f"fraud_rate{suffix}", safe_div(f"fraud_tx{suffix}", f"total_tx{suffix}"))


def window_counts(df: DataFrame, name: str, duration: str = WINDOW_2M,
                  flatten: bool = True) -> DataFrame:
    """count(*) per window (the two sides of the JN5 form of Q1).  Streams
    that are joined afterwards keep the ``window`` struct (``flatten=False``):
    it carries the watermark the stream-stream join needs."""
    return _windowed(df, duration, [], [F.count(F.lit(1)).alias(name)], flatten=flatten)


def fraud_rate_join(total: DataFrame, fraud: DataFrame, suffix: str = "_2m") -> DataFrame:
    """Q1, JN5 form: totals LEFT JOIN fraud counts on the window, missing -> 0.

    On streams (append mode) both sides are watermarked window aggregates
    joined on their ``window`` struct; a window is emitted once the global
    watermark (the minimum of both inputs') passes it.  The batch form is
    ``fraud_rate`` (one aggregate, no join).
    """
    if "window" in total.columns and "window" in fraud.columns:
        j = flatten_window(total.join(fraud.select("window", f"fraud_tx{suffix}"), "window", "left"))
    else:
        f = fraud.select("window_start", "window_end", f"fraud_tx{suffix}")
        j = total.join(f, ["window_start", "window_end"], "left")
    return (j.withColumn(f"fraud_tx{suffix}", F.coalesce(F.col(f"fraud_tx{suffix}"), F.lit(0)).cast("bigint"))
             .withColumn(f"fraud_rate{suffix}", safe_div(f"fraud_tx{suffix}", f"total_tx{suffix}")))


def suspicious_receivers(fraud: DataFrame, duration: str = WINDOW_2M, threshold: int = 10,
                         exact: bool = False, suffix: str = "_2m") -> DataFrame:
    """Q4: receivers reached by >= threshold distinct senders in a window.

    ``exact=False`` is the original HyperLogLog form (rsd 0.05);
    ``exact=True`` counts distinct senders exactly (two-level aggregate).
    """
    name = f"approx_distinct_senders{suffix}" if not exact else f"distinct_senders{suffix}"
    agg = (F.count_distinct("sender_account") if exact
           else F.approx_count_distinct("sender_account"))
    out = _windowed(fraud, duration, ["receiver_account"], [agg.alias(name)])
    return out.where(F.col(name) >= threshold)


def summary_total_by_type(raw: DataFrame, duration: str = WINDOW_2M, suffix: str = "_2m") -> DataFrame:
    """Q6 part 1: totals per (window, transaction_type) from the raw stream."""
    return _windowed(raw, duration, ["transaction_type"], [
        F.count(F.lit(1)).alias(f"total_tx{suffix}"), money_sum().alias(f"total_amount{suffix}"),
        money_avg().alias(f"avg_amount{suffix}")])


def summary_fraud_by_type(fraud: DataFrame, duration: str = WINDOW_2M, suffix: str = "_2m") -> DataFrame:
    """Q6 part 2: fraud count per (window, transaction_type) from the fraud stream."""
    return _windowed(fraud, duration, ["transaction_type"], [
        F.count(F.lit(1)).alias(f"fraud_tx{suffix}")])


def summary_by_type(flagged: DataFrame, is_fraud: Column, duration: str = WINDOW_2M,
                    suffix: str = "_2m") -> DataFrame:
    """Q6 in one stateful aggregate over a flagged stream: totals, fraud
    count and rate per (window, transaction_type).

    The stream form of the merged summary: no second stream, no join, and
    totals and fraud counts close on the same watermark.
    """
    out = _windowed(flagged, duration, ["transaction_type"], [
        F.count(F.lit(1)).alias(f"total_tx{suffix}"), money_sum().alias(f"total_amount{suffix}"),
        money_avg().alias(f"avg_amount{suffix}"),
        F.count_if(F.coalesce(is_fraud, F.lit(False))).alias(f"fraud_tx{suffix}")])
    return out.withColumn(f"fraud_rate{suffix}", safe_div(f"fraud_tx{suffix}", f"total_tx{suffix}"))
