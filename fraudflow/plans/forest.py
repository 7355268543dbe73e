"""The fitted pipeline as one Spark expression (ML7, ML9).

Trees become nested conditionals over plain columns, and a row's probability
their sum over the number of trees.  So scoring needs no feature vectors and no
model object: it is a projection that Spark generates code for, in batch and in
a micro-batch alike.  Its size is that of the forest, which is checked: beyond
``MAX_NODES`` the pipeline itself scores better.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import threshold_decision
from ..schema import OFFLINE_THRESHOLD
from ..session import scratch, work_path
from .imputer import MedianImputerModel

MAX_NODES = 20_000


def _number(v: float) -> str:
    return f"{v!r}D"


def _condition(feature: str, split) -> str:
    """Whether a row goes left."""
    values = split["leftCategoriesOrThreshold"]
    if split["numCategories"] < 0:
        return f"{feature} <= {_number(values[0])}"
    return f"{feature} IN ({', '.join(map(_number, values))})" if values else "false"


def tree_sql(nodes: dict[int, object], names: list[str], at: int = 0) -> str:
    """The share of class 1 in the leaf that a row comes to."""
    node = nodes[at]
    if node["leftChild"] < 0:
        total = sum(node["impurityStats"])
        return _number(node["impurityStats"][1] / total if total else 0.0)
    split = node["split"]
    left, right = (tree_sql(nodes, names, node[c]) for c in ("leftChild", "rightChild"))
    return f"CASE WHEN {_condition(names[split['featureIndex']], split)} THEN {left} ELSE {right} END"


def forest_nodes(model: RandomForestClassificationModel, spark) -> list[dict[int, object]]:
    """The nodes of each tree by number, from the model's saved form."""
    with scratch(spark, "forest"):
        path = work_path(spark, "model")
        model.write().save(path)
        rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    return [trees[t] for t in sorted(trees)]


def _index(model: StringIndexerModel) -> Column:
    """A label's place; null and unknown labels come after the last."""
    labels = model.labels
    found = F.element_at(F.create_map(*[F.lit(x) for i, v in enumerate(labels) for x in (v, float(i))]), F.col(model.getInputCol())) if labels else F.lit(None)
    return F.coalesce(F.when(F.col(model.getInputCol()).isNotNull(), found), F.lit(float(len(labels))))


@dataclass
class CompiledForest:
    """Scores like the pipeline it was made from, to some 1e-12."""

    before: list  # stages that make the assembler's numeric inputs
    indexed: dict[str, Column]
    names: list[str]  # the assembler's inputs, by feature number
    trees: list[str]

    def score(self, df: DataFrame, threshold: float = OFFLINE_THRESHOLD) -> DataFrame:
        """The rows of ``df`` with features, fraud_probability, prediction, prediction_custom and is_fraud_prediction.

        Rows with a null or NaN numeric input are left out, as the assembler does.
        """
        for stage in self.before:
            df = stage.transform(df)
        numeric = [c for c in self.names if c not in self.indexed]
        known = None
        for c in numeric:
            v = F.col(c).cast("double")
            ok = v.isNotNull() & ~F.isnan(v)
            known = ok if known is None else known & ok
        df = df.where(known) if known is not None else df
        inputs = {f"_f{i}": self.indexed[c] if c in self.indexed else F.col(c).cast("double") for i, c in enumerate(self.names)}
        shares = F.expr(" + ".join(f"({t})" for t in self.trees)) / F.lit(float(len(self.trees)))
        out = df.withColumns(inputs).withColumn("fraud_probability", shares).drop(*inputs)
        return out.withColumns({"prediction": (F.col("fraud_probability") > 0.5).cast("double"),
                                "prediction_custom": threshold_decision("fraud_probability", threshold),
                                "is_fraud_prediction": (F.col("fraud_probability") > 0.5).cast("int")})


def compile_forest(model: PipelineModel, spark) -> CompiledForest | None:
    """The fitted pipeline as an expression; None if it has other stages than ours, or more than MAX_NODES nodes."""
    *before, assembler, forest = model.stages if len(model.stages) > 1 else [None, None]
    if not (isinstance(assembler, VectorAssembler) and isinstance(forest, RandomForestClassificationModel)):
        return None
    if forest.numClasses != 2 or forest.totalNumNodes > MAX_NODES:
        return None
    if not all(isinstance(s, (SQLTransformer, MedianImputerModel, StringIndexerModel)) for s in before):
        return None
    indexed = {s.getOutputCol(): _index(s) for s in before if isinstance(s, StringIndexerModel)}
    names = assembler.getInputCols()
    columns = [f"_f{i}" for i in range(len(names))]
    trees = [tree_sql(nodes, columns) for nodes in forest_nodes(forest, spark)]
    return CompiledForest([s for s in before if not isinstance(s, StringIndexerModel)], indexed, names, trees)
