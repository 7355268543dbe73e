"""Model pipeline: fit, score, reload, stream scoring, skipped rows, metrics."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from fraudflow.plans import model as M
from fraudflow.schema import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA
from fraudflow.sources import fixtures as fx


@pytest.fixture(scope="module")
def trained(spark):
    return M.train_model(fx.txn(spark, SF_MID).select(*TRANSACTION_COLUMNS))


def test_scores_are_probabilities(trained):
    s = M.score(trained.model, trained.test)
    r = s.agg(F.min("fraud_probability"), F.max("fraud_probability"),
              F.count_if(~F.col("prediction_custom").isin(0.0, 1.0))).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] == 0


def test_reload_gives_same_predictions(spark, trained, tmp_path):
    path = str(tmp_path / "model")
    M.save_model(trained.model, path)
    again = M.load_model(path)
    a = M.score(trained.model, trained.test).select("transaction_id", "fraud_probability")
    b = M.score(again, trained.test).select("transaction_id", "fraud_probability")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_null_features(spark, trained):
    base = fx.txn(spark, SF_MID).select(*TRANSACTION_COLUMNS).limit(4).collect()
    rows = [r.asDict() for r in base]
    rows[0]["amount"] = None                       # assembler skips the row
    rows[1]["time_since_last_transaction"] = None  # imputed
    rows[2]["merchant_category"] = "never-seen"    # extra index
    rows[3]["location"] = None                     # extra index
    df = spark.createDataFrame(rows, TRANSACTION_SCHEMA)
    scored = M.score(trained.model, df)
    assert scored.count() == 3
    assert M.unscored(df).count() == 1
    assert scored.where(F.col("time_since_last_transaction").isNull()).count() == 0


def test_plain_aggregate_metrics_equal_spark_evaluator(spark, trained):
    s = M.score(trained.model, trained.test)
    ev = M.evaluator_metrics(s)
    mine = M.metrics_at(s, 0.15).first()
    assert mine["accuracy"] == pytest.approx(ev["accuracy"], abs=1e-6)
    assert mine["weighted_precision"] == pytest.approx(ev["weightedPrecision"], abs=1e-6)
    assert mine["weighted_recall"] == pytest.approx(ev["weightedRecall"], abs=1e-6)
    assert mine["weighted_f1"] == pytest.approx(ev["weightedFMeasure"], abs=1e-6)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    for name in ("areaUnderROC", "areaUnderPR"):
        whole = BinaryClassificationEvaluator(labelCol="is_fraud", rawPredictionCol="rawPrediction", metricName=name, numBins=0)
        assert ev[name] == pytest.approx(whole.evaluate(s.withColumn("is_fraud", F.col("is_fraud").cast("double"))), abs=1e-9)


def test_string_index_table_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    from fraudflow.operators.features import string_index_table
    t = fx.txn(spark, SF_MID)
    m = StringIndexer(inputCol="location", outputCol="i").fit(t)
    tab = (string_index_table(t, ["location"]).orderBy("label_index")
           .select("label").collect())
    assert [r[0] for r in tab] == list(m.labels)


def test_model_scores_a_stream(spark, trained, tmp_path):
    from fraudflow.sources.topics import decode, encode, read_topic
    src = str(tmp_path / "raw")
    encode(fx.txn(spark, SF_MID).select(*TRANSACTION_COLUMNS).limit(300)).write.json(src)
    stream = decode(read_topic(spark, "raw", path=src, max_per_trigger=None), TRANSACTION_SCHEMA)
    q = (M.score(trained.model, stream).select("transaction_id", "fraud_probability")
         .writeStream.format("memory").queryName("scored_stream")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("scored_stream").count() == 300


def test_many_categories_train(spark):
    """More distinct locations than the forest's default 32 bins."""
    t = (fx.txn(spark, SF_MID).select(*TRANSACTION_COLUMNS)
         .withColumn("location", F.concat(F.lit("L"), (F.substring("transaction_id", 2, 9)
                                                      .cast("int") % 40).cast("string"))))
    with pytest.raises(ValueError, match="location"):
        M.train_model(t)
    tr = M.train_model(t, max_bins=64)
    assert M.score(tr.model, tr.test).count() > 0


def test_training_sets_are_reproducible(spark):
    t = fx.txn(spark, SF_MID).select(*TRANSACTION_COLUMNS)
    ids = [{r[0] for r in d.select("transaction_id").collect()} for n in (1, 7) for d in M.training_sets(t.repartition(n))]
    assert ids[0] == ids[2] and ids[1] == ids[3] and ids[0] and ids[1] and not ids[0] & ids[1]


def test_a_stream_scores_a_large_forest_by_the_pipeline(spark, trained):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import RandomForestClassifier

    from fraudflow.plans.forest import CompiledForest
    assert trained.model.stages[-1].totalNumNodes > M.QUICK_NODES
    assert M.quickest(trained.model, spark) is trained.model
    *before, _ = trained.model.stages
    small = RandomForestClassifier(labelCol="is_fraud", numTrees=2, maxDepth=2, seed=1).fit(PipelineModel(before).transform(trained.train))
    model = PipelineModel([*before, small])
    quick = M.quickest(model, spark)
    assert isinstance(quick, CompiledForest)
    cols = ["transaction_id", F.round("fraud_probability", 9), "is_fraud_prediction"]
    a, b = (M.score(m, trained.test).select(*cols) for m in (model, quick))
    assert a.count() > 0 and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
