"""Distributed global row numbers (the DataFrame form of ``zipWithIndex``).

``row_number() OVER (ORDER BY ...)`` without a partition moves every row
into one task.  Here the frame is range-partitioned on the sort key (a hot
key value is spread over many partitions because the key includes the
tie-breakers), sorted within partitions, and each row gets its position
inside its partition; the offsets of the partitions come from one small
aggregate (one row per partition) and a running sum over those rows.

The positioned frame is checkpointed (reliable checkpoint in the shared
``spark.checkpoint.dir``) so the partition ids used for the offsets and the
rows they describe come from the same materialisation, also after an
executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | row in partition


def _sort_cols(order: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_row_number(df: DataFrame, order: list, out: str = "rn",
                      partitions: int | None = None, group: str | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row in the total order ``order``.

    ``order`` should be a unique key (add tie-breakers): range partitioning
    cannot split equal keys, so a repeated key value would stay in one
    task.  Counted values (see ``profile.exact_quantiles``) avoid that.

    With ``group`` the numbering restarts for every value of that column
    (the column must be the first sort key); still no single-task group.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # the deployment's shuffle width (sized to the data by the cluster conf)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = _sort_cols(order)
    positioned = (df.repartitionByRange(n, *cols)
                    .sortWithinPartitions(*cols)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_loc", F.monotonically_increasing_id()
                                - F.shiftleft(F.spark_partition_id().cast("bigint"), _LOCAL_BITS))
                    .checkpoint(eager=True))
    keys = ["_pid"] + ([group] if group else [])
    sizes = positioned.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # one row per (partition[, group]): tiny, so an unpartitioned window is fine
    w = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    if group:
        # first local position of the group inside each partition
        starts = positioned.groupBy(*keys).agg(F.min("_loc").alias("_first"))
        offs = offs.join(starts, keys)
    else:
        offs = offs.withColumn("_first", F.lit(0).cast("bigint"))
    # ungrouped: one row per partition, a proven bound -> broadcast; grouped
    # offsets grow with the number of groups, so the planner / AQE decides
    res = positioned.join(F.broadcast(offs) if not group else offs, keys)
    return (res.withColumn(out, F.col("_off") + F.col("_loc") - F.col("_first"))
               .drop("_pid", "_loc", "_off", "_first"))
