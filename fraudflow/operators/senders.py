"""Sender-level operators (AG2, AG9, AG11, JN1, JN2).

"Bad senders" are the distinct non-null senders with at least one fraud
row.  The per-sender pivot and the clean-sender list are each one
aggregate over the sender key (map-side combined, so a sender holding a
third of all rows costs one partial row per task); the joins are left to
the optimizer, with AQE choosing broadcast from measured sizes and
splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def bad_senders(df: DataFrame, label: str = "is_fraud", key: str = "sender_account") -> DataFrame:
    """AG2 + FLT1 + FLT2: distinct non-null senders with a fraud row."""
    return df.where(F.col(label) & F.col(key).isNotNull()).select(key).distinct()


def fraud_per_sender(df: DataFrame, label: str = "is_fraud", key: str = "sender_account") -> DataFrame:
    """AG9: number of fraud transactions per (non-null) sender."""
    return (df.where(F.col(label) & F.col(key).isNotNull())
              .groupBy(key).agg(F.count(F.lit(1)).alias("fraud_tx_count")))


def transactions_of(df: DataFrame, senders: DataFrame, key: str = "sender_account") -> DataFrame:
    """JN2: all transactions (fraud or not) of the given senders (left semi)."""
    return df.join(senders.select(key), key, "left_semi")


def without(df: DataFrame, senders: DataFrame, key: str = "sender_account") -> DataFrame:
    """JN1: rows whose key is not among ``senders`` (left anti)."""
    return df.join(senders.select(key), key, "left_anti")


def per_sender_counts(df: DataFrame, label: str = "is_fraud", key: str = "sender_account") -> DataFrame:
    """AG11: bad senders × {non-fraud, fraud} counts, total and fraud rate.

    One aggregate with conditional counts replaces pivot + semi join: a
    sender is bad exactly when its fraud count is positive.  Both count
    columns always exist (zero-filled).
    """
    agg = (df.where(F.col(key).isNotNull())
             .groupBy(key)
             .agg(F.count_if(F.col(label) == F.lit(False)).alias("nonfraud_tx_count"),
                  F.count_if(F.col(label)).alias("fraud_tx_count"))
             .where(F.col("fraud_tx_count") > 0))
    total = F.col("fraud_tx_count") + F.col("nonfraud_tx_count")
    return (agg.withColumn("total_tx", total)
               .withColumn("fraud_rate", F.col("fraud_tx_count") / total))


def clean_senders(df: DataFrame, label: str = "is_fraud", key: str = "sender_account") -> DataFrame:
    """JN1 result: senders with a non-fraud row and no fraud row at all.

    Same set as ``without(distinct non-fraud senders, bad_senders)``, in a
    single aggregate instead of two aggregates and a join.
    """
    return (df.where(F.col(key).isNotNull())
              .groupBy(key)
              .agg(F.count_if(F.col(label) == F.lit(False)).alias("_ok"),
                   F.count_if(F.col(label)).alias("_bad"))
              .where((F.col("_ok") > 0) & (F.col("_bad") == 0))
              .select(key))
