"""Exact areas under the ROC and precision-recall curves (ML10), distributed.

Rows are counted by score first (a partial aggregate: a score that a third of
the rows share is one row), and the counted scores are range-partitioned into
blocks, best first.  Totals of the blocks, one row each, give every block the
positives and negatives before it; inside a block a running sum does.  No
binning of scores, no task that sees them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def score_curve(scored: DataFrame, label: str = "is_fraud", score: str = "fraud_probability",
                partitions: int | None = None) -> DataFrame:
    """One row for each distinct score: threshold, pos, neg (at this score), tp, fp (at it or above),
    positives, negatives (in all).

    Rows without a label or score are left out.  The counted scores are
    checkpointed, so that blocks and their totals describe the same rows.
    """
    spark = scored.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    y = F.col(label).cast("double") == 1
    counts = (scored.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold"))
              .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))
    placed = (counts.repartitionByRange(n, F.col("threshold").desc())
              .withColumn("_block", F.spark_partition_id()).checkpoint(eager=True))
    # one row a block: a window over them is small, and so is their broadcast
    before = Window.partitionBy().orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    blocks = placed.groupBy("_block").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n")).select(
        F.col("_block").alias("_b"), F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_fp"),
        F.sum("_p").over(total).alias("positives"), F.sum("_n").over(total).alias("negatives"))
    inside = Window.partitionBy("_block").orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = placed.withColumns({"_ip": F.sum("pos").over(inside), "_in": F.sum("neg").over(inside)})
    rows = rows.join(F.broadcast(blocks), F.col("_block") == F.col("_b"))
    return rows.select("threshold", "pos", "neg", (F.col("_tp") + F.col("_ip")).alias("tp"), (F.col("_fp") + F.col("_in")).alias("fp"),
                       "positives", "negatives")


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def exact_auc(scored: DataFrame, label: str = "is_fraud", score: str = "fraud_probability",
              partitions: int | None = None) -> DataFrame:
    """One row: positives, negatives, thresholds, area_under_roc, area_under_pr.

    Trapezoids between neighbouring scores.  The ROC area is a quotient of
    whole numbers: twice the negatives' pairs with better positives, plus
    ties, over twice all pairs.  The precision-recall curve starts at recall 0
    with the precision of the best score.  An area is null if there are no
    positives, the ROC area also without negatives.
    """
    c = score_curve(scored, label, score, partitions)
    big = lambda x: F.col(x).cast("decimal(19,0)")
    pairs = F.sum((big("neg") * (2 * (big("tp") - big("pos")) + big("pos"))).cast("decimal(38,0)"))
    seen = F.col("tp") + F.col("fp")
    now = F.col("tp") / seen
    tp0, seen0 = F.col("tp") - F.col("pos"), seen - F.col("pos") - F.col("neg")
    last = F.when(seen0 > 0, tp0 / seen0).otherwise(now)
    one = c.agg(F.coalesce(F.max("positives"), F.lit(0)).alias("positives"), F.coalesce(F.max("negatives"), F.lit(0)).alias("negatives"),
                F.count("*").alias("thresholds"), pairs.alias("pairs"), F.sum(F.col("pos") * (now + last) / 2).alias("under"))
    p, n = F.col("positives"), F.col("negatives")
    return one.select("positives", "negatives", "thresholds",
                      _share(F.col("pairs").cast("double"), 2 * p.cast("double") * n).alias("area_under_roc"),
                      _share(F.col("under"), p).alias("area_under_pr"))
