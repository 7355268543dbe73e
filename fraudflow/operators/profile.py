"""Table profiling (AG1-AG8, AG10): the exploratory statistics, distributed.

Wide-to-long is done with ``DataFrame.unpivot`` so one aggregate pass
covers every column; all aggregates combine map-side.  Exact quartiles are
computed on value counts with block prefix sums (``exact_quantiles``)
instead of collecting a column's values into one buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


STAT_DECIMALS = 6


def _long(df: DataFrame, cols: list[str], value_type: str = "string") -> DataFrame:
    """Unpivot ``cols`` to (column_name, value), dropping null values."""
    wide = df.select(*[F.col(c).cast(value_type).alias(c) for c in cols])
    return (wide.unpivot([], cols, "column_name", "value")
                .where(F.col("value").isNotNull()))


def value_counts_top(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """AG3: per column, the k most frequent non-null values (ties: value asc)."""
    counts = _long(df, cols).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value"))
    # row_number <= k is planned with a partial group limit before the shuffle
    return (counts.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= k))


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """AG4: exact number of distinct non-null values per column."""
    return (_long(df, cols).select("column_name", "value").distinct()
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")))


def null_counts(df: DataFrame) -> DataFrame:
    """AG5: nulls per column (one aggregate pass, then unpivoted)."""
    cols = df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", "null_count")


def table_profile(df: DataFrame) -> DataFrame:
    """AG7: column, non-null count, type (the ``info`` listing)."""
    cols = df.columns
    one = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    types = F.create_map(*[x for c, t in df.dtypes for x in (F.lit(c), F.lit(t))])
    return (one.unpivot([], cols, "column_name", "non_null_count")
               .withColumn("dtype", types[F.col("column_name")]))


def exact_quantiles(long: DataFrame, qs: dict[str, float], partitions: int | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation, as pandas / ``quantile_cont``)
    per ``column_name`` of a long (column_name, value) frame.

    1. ``(column_name, value) -> cnt``: a partial aggregate, so a value
       holding a third of all rows becomes one row — every sort key below
       is unique and range partitioning stays balanced.
    2. The counted values are range-partitioned into blocks (checkpointed,
       so block ids are stable); per-block totals (one row per block and
       column) give each block's starting rank.
    3. For each target rank the containing block is found on those small
       totals; only those blocks (at most 2 per quantile and column) are
       scanned with a running sum to pick the value at the rank.
    """
    spark = long.sparkSession
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (counts.repartitionByRange(n, "column_name", "value")
                    .withColumn("_blk", F.spark_partition_id())
                    .checkpoint(eager=True))
    blocks = placed.groupBy("column_name", "_blk").agg(F.sum("cnt").alias("_bn"))
    before = Window.partitionBy("column_name").orderBy("_blk").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
    total = Window.partitionBy("column_name")
    blocks = blocks.withColumn("_tot", F.sum("_bn").over(total))
    # target ranks: floor / ceil of h = (N - 1) * q for every quantile
    tgt = blocks.select("column_name", "_tot").distinct().select(
        "column_name", F.explode(F.array(*[
            F.struct(F.lit(name).alias("q"), F.lit(side).alias("side"),
                     (F.floor if side == "lo" else F.ceil)((F.col("_tot") - 1) * q).alias("pos"),
                     ((F.col("_tot") - 1) * q - F.floor((F.col("_tot") - 1) * q)).alias("frac"))
            for name, q in qs.items() for side in ("lo", "hi")])).alias("t")).select("column_name", "t.*")
    # equi-join on the column, range condition on the block's rank span
    at = tgt.join(blocks, "column_name").where(
        (F.col("pos") >= F.col("_off")) & (F.col("pos") < F.col("_off") + F.col("_bn")))
    wanted = at.select("column_name", "_blk", "_off").distinct()
    inside = Window.partitionBy("column_name", "_blk").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (placed.join(wanted, ["column_name", "_blk"], "inner")
                    .withColumn("_end", F.col("_off") + F.sum("cnt").over(inside)))
    hit = ranked.join(at.select("column_name", "_blk", "q", "side", "pos", "frac"),
                      ["column_name", "_blk"]).where(
        (F.col("pos") >= F.col("_end") - F.col("cnt")) & (F.col("pos") < F.col("_end")))
    aggs = []
    for name in qs:
        lo = F.max(F.when((F.col("q") == name) & (F.col("side") == "lo"), F.col("value")))
        hi = F.max(F.when((F.col("q") == name) & (F.col("side") == "hi"), F.col("value")))
        fr = F.max(F.when(F.col("q") == name, F.col("frac")))
        aggs.append((lo + fr * (hi - lo)).alias(name))
    return hit.groupBy("column_name").agg(*aggs)


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """AG6 / AG10: count, mean, sample std, min, 25/50/75 % (linear
    interpolation), max per numeric column; nulls ignored."""
    long = _long(df, cols, "double")
    stats = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"))
    quants = exact_quantiles(long, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    out = stats.join(quants, "column_name", "left")
    r = lambda c: F.round(F.col(c), STAT_DECIMALS).alias(c)
    return out.select("column_name", F.col("count").cast("bigint").alias("count"),
                      r("mean"), r("std"), r("min"), r("p25"), r("p50"), r("p75"), r("max"))


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """AG8: count and percentage per label value (nulls excluded)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("count"))
    # the aggregate has one row per label value: a global window over it is tiny
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(F.col("count") * 100.0 / total, STAT_DECIMALS))


def overall_counts(df: DataFrame, label: str = "is_fraud", key: str = "sender_account") -> DataFrame:
    """AG1: total rows, fraud rows and distinct non-null fraud senders, one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_tx"),
        F.count_if(F.col(label)).alias("fraud_tx"),
        F.count_distinct(F.when(F.col(label), F.col(key))).alias("distinct_bad_senders"))
