"""Feature engineering (ML3, ML14; FN1-FN9, FN14, FLT3).

The flags are stated once (``functions.expressions.FLAGS``).  ``feature_sql``
puts them into the statement of the ``SQLTransformer`` stage that is saved
inside the model pipeline, so streaming scoring recomputes exactly the
training features.  The time stamp is parsed once in an inner SELECT,
zone-free, bad text -> null (the rule of ``parse_event_time``).
"""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import FLAGS, HOUR, TIMESTAMP_TEXT, bool_to_int, flag_sql, parse_event_time

FEATURE_COLUMNS = ["event_time", HOUR[0], *FLAGS]


def feature_sql() -> str:
    """The statement that adds FEATURE_COLUMNS to ``__THIS__``."""
    time = f"if(timestamp RLIKE '{TIMESTAMP_TEXT}', try_cast(timestamp AS timestamp_ntz), null) AS event_time"
    columns = [f"{HOUR[1]} AS {HOUR[0]}", *map(flag_sql, FLAGS)]
    return f"SELECT *, {', '.join(columns)} FROM (SELECT *, {time} FROM __THIS__)"


def feature_stage() -> SQLTransformer:
    return SQLTransformer(statement=feature_sql())


def add_features(df: DataFrame) -> DataFrame:
    """ML3: the 8 derived columns (an existing ``event_time`` is recomputed)."""
    if "event_time" in df.columns:
        df = df.drop("event_time")
    return feature_stage().transform(df)


def add_features_cast_variant(df: DataFrame) -> DataFrame:
    """ML14 (older variant): fill time gap with 0.0, boolean casts where a null
    input stays null (FN9), then drop rows whose time features are null and
    rows without a label."""
    out = (df.drop("event_time", "fraud_type").na.fill({"time_since_last_transaction": 0.0})
             .withColumns({"is_fraud": F.col("is_fraud").cast("int"), "event_time": parse_event_time("timestamp")}))
    out = out.withColumns({HOUR[0]: F.expr(HOUR[1]), **{name: bool_to_int(F.expr(asked)) for name, asked in FLAGS.items()}})
    return (out.where(F.col("hour_of_day").isNotNull() & F.col("is_night").isNotNull()
                      & F.col("is_weekend").isNotNull())
               .na.drop(subset=["is_fraud"]))


def string_index_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """ML5 as a table: label -> index by frequency desc, ties by label asc
    (StringIndexer's ``frequencyDesc``); nulls are not labels."""
    from .profile import _long
    from .ranking import global_row_number
    counts = _long(df, cols).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("count"))
    ranked = global_row_number(counts, ["column_name", F.desc("count"), "value"], out="label_index", group="column_name")
    return (ranked.withColumn("label_index", F.col("label_index").cast("double"))
                  .withColumnRenamed("value", "label"))
