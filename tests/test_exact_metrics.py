"""ML4, ML10, AG16: exact areas, exact medians, mergeable sketches."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from fraudflow.operators.auc import exact_auc, score_curve
from fraudflow.operators.sketches import distinct_senders, merge_windows, relative_error, sender_sketches
from fraudflow.plans.imputer import MedianImputer, exact_medians


def scored(spark, rows):
    return spark.createDataFrame(rows, "is_fraud int, fraud_probability double").repartition(5)


@pytest.mark.parametrize("seed,distinct", [(0, 3), (1, 40), (2, 100_000)])
def test_areas_equal_the_unbinned_evaluator(spark, seed, distinct):
    rng = random.Random(seed)
    rows = [(int(rng.random() < s), round(s * distinct) / distinct) for s in (rng.random() for _ in range(4000))]
    df = scored(spark, rows)
    got = exact_auc(df).first()
    for name, mine in (("areaUnderROC", "area_under_roc"), ("areaUnderPR", "area_under_pr")):
        ev = BinaryClassificationEvaluator(labelCol="is_fraud", rawPredictionCol="fraud_probability", metricName=name, numBins=0)
        assert got[mine] == pytest.approx(ev.evaluate(df), abs=1e-9)
    assert got["thresholds"] == len({s for _, s in rows})
    assert exact_auc(df, partitions=1).first()["area_under_roc"] == got["area_under_roc"]


def test_areas_of_edge_cases(spark):
    area = lambda rows: tuple(exact_auc(scored(spark, rows)).first())
    assert area([]) == (0, 0, 0, None, None)
    assert area([(0, 0.1), (0, 0.2)]) == (0, 2, 2, None, None)
    assert area([(1, 0.1), (1, 0.2)])[3:] == (None, 1.0)
    assert area([(1, 0.9), (0, 0.1), (None, 0.5), (1, None)]) == (1, 1, 2, 1.0, 1.0)
    assert area([(1, 0.1), (0, 0.9)])[3] == 0.0
    assert area([(1, 0.5)] * 30 + [(0, 0.5)] * 10)[3:] == (0.5, 0.75)  # one score for all


def test_curve_ends_with_all_rows(spark):
    rows = [(i % 3 == 0, i % 7 / 7) for i in range(200)]
    last = score_curve(scored(spark, [(int(a), b) for a, b in rows])).orderBy("threshold").first()
    assert (last["tp"], last["fp"]) == (last["positives"], last["negatives"]) == (67, 133)


def test_medians(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 5.0, None), (3.0, nan, None), (10.0, 7.0, None), (None, None, None), (2.0, 9.0, None)],
                               "a double, b double, c double").repartition(3)
    assert exact_medians(df, ["a", "b", "c"]) == {"a": 2.5, "b": 7.0}
    with pytest.raises(ValueError, match="c"):
        MedianImputer(inputCols=["a", "c"], outputCols=["a", "c"]).fit(df)
    model = MedianImputer(inputCols=["a", "b"], outputCols=["a", "filled"]).fit(df)
    got = model.transform(df)
    assert sorted(r["a"] for r in got.collect()) == [1.0, 2.0, 2.5, 3.0, 10.0]
    assert sorted(r["filled"] for r in got.collect()) == [5.0, 7.0, 7.0, 7.0, 9.0]


def test_imputer_survives_a_pipeline(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "a double")
    model = Pipeline(stages=[MedianImputer(inputCols=["a"], outputCols=["a"]), VectorAssembler(inputCols=["a"], outputCol="v")]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.stages[0].medians() == {"a": 2.0}
    assert again.transform(df).collect() == model.transform(df).collect()


def test_hot_value_median(spark):
    """A value that most rows share is one counted row."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).otherwise(7.0).alias("a"))
    assert exact_medians(df, ["a"]) == {"a": 7.0}


def test_sketches_merge_in_any_order(spark):
    rows = spark.range(40_000).select(F.timestamp_add("SECOND", (F.col("id") * 7 % 86_000).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("event_time"),
                                      F.concat(F.lit("A"), (F.col("id") % 9_000).cast("string")).alias("sender_account"),
                                      (F.col("id") % 2).cast("string").alias("receiver_account"))
    rows = rows.withColumn("sender_account", F.when(F.col("sender_account") != "A11", F.col("sender_account")))
    small = sender_sketches(rows)
    counts = lambda df: dict(map(tuple, df.select("receiver_account", distinct_senders()).collect()))
    day = counts(merge_windows(small, "1 day"))
    again = counts(merge_windows(merge_windows(small, "1 hour"), "1 day")), counts(merge_windows(small.union(small), "1 day"))
    exact = dict(map(tuple, rows.groupBy("receiver_account").agg(F.count_distinct("sender_account")).collect()))
    assert exact == {"0": 4500, "1": 4499}
    for got in (day, *again, counts(sender_sketches(rows, "1 day"))):
        assert all(abs(got[k] - n) <= 5 * relative_error() * n for k, n in exact.items())
