"""Q5 alert stream and Q8 not-fraud list (PRJ1, ST6, FLT5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ALERT_COLUMNS, NOT_FRAUD_COLUMNS, ONLINE_THRESHOLD


def fraud_alerts(fraud: DataFrame) -> DataFrame:
    """Q5 / ST6: stateless projection of the fraud stream to the alert columns."""
    return fraud.select(*ALERT_COLUMNS)


def is_model_fraud(p="fraud_probability", pred="is_fraud_prediction",
                   threshold: float = ONLINE_THRESHOLD):
    """FLT5: p >= threshold OR prediction = 1."""
    return (F.col(p) >= threshold) | (F.col(pred) == 1)


def is_model_not_fraud(p="fraud_probability", pred="is_fraud_prediction",
                       threshold: float = ONLINE_THRESHOLD):
    """FLT5 complement: prediction = 0 AND p < threshold."""
    return (F.col(pred) == 0) & (F.col(p) < threshold)


def ml_not_fraud(scored: DataFrame, threshold: float = ONLINE_THRESHOLD) -> DataFrame:
    """Q8: scored rows the model clears, with the 9 not-fraud columns."""
    return scored.where(is_model_not_fraud(threshold=threshold)).select(*NOT_FRAUD_COLUMNS)
