"""Offline model plan (ML1-ML12, SNK5): sample, split, fit, score, evaluate.

The pipeline is Spark ML end to end — feature SQL stage, median imputer,
five string indexers, vector assembler, random forest — so the fitted
``PipelineModel`` scores batch and streaming frames alike.  Metrics are
plain aggregates over the scored frame (one pass for all confusion counts
and all thresholds) next to Spark's own evaluators.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import threshold_decision, vector_element
from ..operators.auc import exact_auc
from ..operators.features import feature_stage
from ..schema import (CATEGORICAL_COLS, NUMERIC_FEATURE_COLS, OFFLINE_THRESHOLD,
                      RF_PARAMS, SAMPLE_FRACTIONS, SEED, SPLIT_WEIGHTS,
                      SWEEP_THRESHOLDS, TRANSACTION_COLUMNS)
from .forest import CompiledForest, compile_forest
from .imputer import MedianImputer

RATE_DECIMALS = 6
MAX_BINS = 32
#: A stream scores by the pipeline beyond so many nodes: the expression took 3 to 4 times as long
#: at 197, 430, 988 and 15,250 nodes, and at 15,250 outgrew whole-stage code generation.
QUICK_NODES = 100


# -- sampling and splitting ---------------------------------------------------

def stratified_sample(df: DataFrame, fractions=None, seed: int = SEED,
                      label: str = "is_fraud") -> DataFrame:
    """ML1: keep each label value with its fraction; null label dropped."""
    fr = dict(SAMPLE_FRACTIONS if fractions is None else fractions)
    return df.where(F.col(label).isNotNull()).stat.sampleBy(label, fr, seed)


def _unit_hash(id_col: str, seed: int) -> Column:
    """A uniform [0, 1) value from md5(seed:id): reproducible on any engine."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def hash_sample(df: DataFrame, fractions=None, seed: int = SEED, label: str = "is_fraud",
                id_col: str = "transaction_id") -> DataFrame:
    """ML1, deterministic twin: a row of label v is kept when
    hash(seed, id) < fraction[v] — independent of partitioning."""
    fr = dict(SAMPLE_FRACTIONS if fractions is None else fractions)
    u = _unit_hash(id_col, seed)
    keep = None
    for v, f in fr.items():
        c = (F.col(label) == F.lit(v)) & (u < F.lit(float(f)))
        keep = c if keep is None else keep | c
    return df.where(keep)


def random_split(df: DataFrame, weights=None, seed: int = SEED) -> list[DataFrame]:
    """ML2: Spark's random split (80/20 by default)."""
    return df.randomSplit(list(SPLIT_WEIGHTS if weights is None else weights), seed)


def hash_split(df: DataFrame, train_fraction: float = SPLIT_WEIGHTS[0], seed: int = SEED,
               id_col: str = "transaction_id") -> DataFrame:
    """ML2, deterministic twin: adds ``split`` = 'train' / 'test'."""
    u = _unit_hash(id_col, seed + 1)
    return df.withColumn("split", F.when(u < F.lit(train_fraction), F.lit("train"))
                                   .otherwise(F.lit("test")))


# -- pipeline -----------------------------------------------------------------

def build_pipeline(label: str = "is_fraud", max_bins: int = MAX_BINS) -> Pipeline:
    """ML3-ML8: features -> median imputer -> 5 indexers -> assembler -> forest."""
    imputer = MedianImputer(inputCols=["time_since_last_transaction"], outputCols=["time_since_last_transaction"])
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep")
                for c in CATEGORICAL_COLS]
    assembler = VectorAssembler(inputCols=NUMERIC_FEATURE_COLS + [f"{c}_idx" for c in CATEGORICAL_COLS],
                                outputCol="features", handleInvalid="skip")
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", maxBins=max_bins,
                                **RF_PARAMS)
    return Pipeline(stages=[feature_stage(), imputer, *indexers, assembler, rf])


def check_bins(train: DataFrame, max_bins: int) -> None:
    """The forest treats indexed columns as categorical and needs a bin for
    each category (with ``handleInvalid='keep'`` the labels and one more).
    One aggregate over the training set; fails with the columns at fault."""
    r = train.agg(*[F.count_distinct(c).alias(c) for c in CATEGORICAL_COLS]).first()
    over = {c: r[c] + 1 for c in CATEGORICAL_COLS if (r[c] or 0) + 1 > max_bins}
    if over:
        raise ValueError(f"max_bins is {max_bins}; categories of the training set: {over}")


def prepare(df: DataFrame) -> DataFrame:
    """Training input: raw transaction columns, no fraud_type, int label."""
    cols = [c for c in TRANSACTION_COLUMNS if c in df.columns and c != "fraud_type"]
    return (df.select(*cols).withColumn("is_fraud", F.col("is_fraud").cast("int"))
              .na.drop(subset=["is_fraud"]))


@dataclass
class Trained:
    model: PipelineModel
    train: DataFrame
    test: DataFrame


def training_sets(transactions: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """ML1 + ML2 by hashes of the transaction id: (train, test).

    Which rows are drawn depends on their ids alone, so both sets are the same
    whenever, wherever and over however many partitions they are computed.
    """
    split = hash_split(hash_sample(transactions, seed=seed), seed=seed)
    return tuple(prepare(split.where(F.col("split") == part)) for part in ("train", "test"))


def train_model(transactions: DataFrame, seed: int = SEED, max_bins: int = MAX_BINS) -> Trained:
    """ML1 + ML2 + ML8: down-sample, split 80/20, fit.

    A model that needs more than ``max_bins`` categories is refused, since
    more bins would also change the splits of the continuous features.
    """
    from pyspark import StorageLevel
    train, test = training_sets(transactions, seed)
    # the imputer, five indexers and the forest each read the training set:
    # keep it for the fit (spilling to disk if needed), then release it
    kept = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        check_bins(kept, max_bins)
        model = build_pipeline(max_bins=max_bins).fit(kept)
    finally:
        kept.unpersist()
    return Trained(model, train, test)


def score(model: PipelineModel, df: DataFrame, threshold: float = OFFLINE_THRESHOLD) -> DataFrame:
    """ML9 + FN15 + FN16: fraud probability and custom-threshold decision.

    ``model`` is the fitted pipeline, or its expression (``compiled``), which
    gives the same numbers without the vector columns.
    """
    if isinstance(model, CompiledForest):
        return model.score(df, threshold)
    out = model.transform(df)
    return (out.withColumn("fraud_probability", vector_element("probability", 1))
               .withColumn("prediction_custom", threshold_decision("fraud_probability", threshold))
               .withColumn("is_fraud_prediction", F.col("prediction").cast("int")))


def compiled(model: PipelineModel, spark) -> PipelineModel | CompiledForest:
    """The pipeline as a Spark expression where it can be one, else itself."""
    return compile_forest(model, spark) or model


def quickest(model: PipelineModel, spark) -> PipelineModel | CompiledForest:
    """The form to score a stream's batches with: the expression of a forest of up to
    ``QUICK_NODES`` nodes, the pipeline itself beyond."""
    forest = model.stages[-1] if model.stages else None
    large = isinstance(forest, RandomForestClassificationModel) and forest.totalNumNodes > QUICK_NODES
    return model if large else compiled(model, spark)


def unscored(df: DataFrame) -> DataFrame:
    """Rows the assembler would skip (a null / NaN numeric feature input):
    neither fraud nor not-fraud downstream, so they are reported apart."""
    from ..operators.features import add_features
    feats = add_features(df)
    bad = None
    for c in NUMERIC_FEATURE_COLS:
        if c == "time_since_last_transaction":
            continue  # imputed before assembly
        cond = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
        bad = cond if bad is None else bad | cond
    return feats.where(bad)


def save_model(model: PipelineModel, path: str) -> None:
    """SNK5: overwrite-save the whole fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# -- metrics ------------------------------------------------------------------

def evaluator_metrics(scored: DataFrame, label: str = "is_fraud",
                      pred: str = "prediction_custom") -> dict[str, float]:
    """ML10 + ML11: exact areas over all distinct fraud probabilities, and Spark's
    evaluator for the weighted metrics."""
    lab = scored.withColumn(label, F.col(label).cast("double"))
    auc = exact_auc(lab, label).first()
    out = {"areaUnderROC": auc["area_under_roc"], "areaUnderPR": auc["area_under_pr"]}
    ev = lab.select(F.col(pred).cast("double").alias("prediction"),
                    F.col(label).alias("label"))
    for m in ("accuracy", "weightedPrecision", "weightedRecall", "weightedFMeasure"):
        out[m] = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                                   metricName=m).evaluate(ev)
    return out


def _confusion(label: Column, score: Column, t: float, tag: str) -> list[Column]:
    p = score >= F.lit(t)
    y = label == 1
    return [F.count_if(p & y).alias(f"tp{tag}"), F.count_if(p & ~y).alias(f"fp{tag}"),
            F.count_if(~p & ~y).alias(f"tn{tag}"), F.count_if(~p & y).alias(f"fn{tag}")]


def _metric_cols(tp, fp, tn, fn) -> dict[str, Column]:
    """Binary accuracy and support-weighted precision / recall / F1 (both
    classes), as Spark's multiclass evaluator defines them; 0 for 0/0."""
    n = tp + fp + tn + fn

    def div(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    prec1, rec1 = div(tp, tp + fp), div(tp, tp + fn)
    prec0, rec0 = div(tn, tn + fn), div(tn, tn + fp)
    f1 = lambda p, r: F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    w1, w0 = div(tp + fn, n), div(tn + fp, n)
    r = lambda c: F.round(c, RATE_DECIMALS)
    return {"accuracy": r(div(tp + tn, n)),
            "precision": r(prec1), "recall": r(rec1), "f1": r(f1(prec1, rec1)),
            "weighted_precision": r(w1 * prec1 + w0 * prec0),
            "weighted_recall": r(w1 * rec1 + w0 * rec0),
            "weighted_f1": r(w1 * f1(prec1, rec1) + w0 * f1(prec0, rec0))}


def threshold_sweep(scored: DataFrame, thresholds=None, label: str = "is_fraud",
                    score_col: str = "fraud_probability") -> DataFrame:
    """ML11 + ML12: confusion counts and metrics per threshold, one scan.

    All thresholds are counted in a single aggregate; the one result row is
    then exploded to one row per threshold.
    """
    ts = list(SWEEP_THRESHOLDS if thresholds is None else thresholds)
    lab, sc = F.col(label).cast("int"), F.col(score_col)
    aggs = [c for i, t in enumerate(ts) for c in _confusion(lab, sc, t, f"_{i}")]
    one = scored.where(lab.isNotNull() & sc.isNotNull()).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"),
                              *[F.col(f"{m}_{i}").alias(m) for m in ("tp", "fp", "tn", "fn")])
                     for i, t in enumerate(ts)])
    long = one.select(F.explode(rows).alias("r")).select("r.*")
    mc = _metric_cols(*[F.col(m) for m in ("tp", "fp", "tn", "fn")])
    return long.select("threshold", "tp", "fp", "tn", "fn",
                       *[v.alias(k) for k, v in mc.items()])


def metrics_at(scored: DataFrame, threshold: float = OFFLINE_THRESHOLD, label: str = "is_fraud",
               score_col: str = "fraud_probability") -> DataFrame:
    return threshold_sweep(scored, [threshold], label, score_col)


def rule_score(df: DataFrame) -> DataFrame:
    """A deterministic score from the derived flags, for SQL-checkable metric
    tests (the forest's scores depend on the sample and the split)."""
    from ..operators.features import add_features
    f = add_features(df)
    s = (0.4 * F.col("is_large_amount") + 0.3 * F.col("high_risk_merchant")
         + 0.2 * F.col("is_night") + 0.1 * F.col("is_online_channel"))
    return f.withColumn("fraud_probability", F.round(s, 2))

