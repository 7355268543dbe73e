"""Views that map the provided test tables onto the transaction schema.

* ``txn``        — 18 transaction fields + ``event_time`` from ``events``
* ``txn_big``    — a larger, duplicate-id stream from ``lineitem ⋈ orders``
* ``txn_routed`` — ``txn`` + ``fraud_source`` (deterministic stand-in for
  the Bloom filter and the model: senders with fraud before a cut-off, then
  large amounts)
* ``fraud_txn``  — the rows of ``txn_routed`` with a fraud source

Each is a lazy DataFrame over the parquet scan, so column pruning and
filters reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import format_event_time
from ..schema import SOURCE_BLOOM, SOURCE_MODEL

# Fixed values of the test views.
ROUTE_CUTOFF = "2024-01-16 00:00:00"
ROUTE_MODEL_AMOUNT = 2000.0
# Arrival order of txn_big: a total order (full rows are unique).
BIG_ARRIVAL_ORDER = ["event_time", "transaction_id", "receiver_account", "amount"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case_mod(c, n: int, labels: list[str]):
    m = F.pmod(c, F.lit(n))
    expr = F.when(m == 0, F.lit(labels[0]))
    for i, lab in enumerate(labels[1:], start=1):
        if i == len(labels) - 1:
            return expr.otherwise(F.lit(lab))
        expr = expr.when(m == i, F.lit(lab))
    return expr


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load_table(spark, sf_dir, "events")
    eid, uid, val = F.col("event_id"), F.col("user_id"), F.col("value")
    fraud = (F.col("event_type") == "error") & (val > 200)
    return e.select(
        F.concat(F.lit("T"), eid.cast("string")).alias("transaction_id"),
        format_event_time("ts").alias("timestamp"),
        F.concat(F.lit("A"), uid.cast("string")).alias("sender_account"),
        F.concat(F.lit("A"), ((eid * 7) % 151).cast("string")).alias("receiver_account"),
        F.round(val * 10, 2).alias("amount"),
        F.col("event_type").alias("transaction_type"),
        _case_mod(eid, 6, ["online", "travel", "entertainment", "grocery",
                           "retail", "utilities"]).alias("merchant_category"),
        _case_mod(eid, 5, ["Tokyo", "London", "Berlin", "Sydney",
                           "Toronto"]).alias("location"),
        _case_mod(eid, 4, ["mobile", "web", "atm", "pos"]).alias("device_used"),
        fraud.alias("is_fraud"),
        F.when(fraud, F.lit("card_not_present")).alias("fraud_type"),
        F.when(eid % 7 == 0, F.lit(None).cast("double"))
         .otherwise(((eid * 37) % 10000).cast("double") / 100)
         .alias("time_since_last_transaction"),
        (((eid * 13) % 200).cast("double") / 100 - 1).alias("spending_deviation_score"),
        (uid % 20).cast("int").alias("velocity_score"),
        (((eid * 17) % 100).cast("double") / 100).alias("geo_anomaly_score"),
        _case_mod(uid, 3, ["online", "card", "ACH"]).alias("payment_channel"),
        F.concat(F.lit("10.0."), (uid % 256).cast("string"), F.lit("."),
                 (eid % 256).cast("string")).alias("ip_address"),
        F.concat(F.lit("D"), (uid % 97).cast("string")).alias("device_hash"),
        F.col("ts").alias("event_time"),
    )


def txn_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
        "l_returnflag", "l_discount")
    o = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    offset = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 613) % 86400
    et = F.timestamp_add("SECOND", offset, F.col("o_orderdate"))
    return j.select(
        F.concat(F.lit("T"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        format_event_time(et).alias("timestamp"),
        et.alias("event_time"),
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("sender_account"),
        F.concat(F.lit("A"), F.col("l_suppkey").cast("string")).alias("receiver_account"),
        F.col("l_extendedprice").alias("amount"),
        F.col("o_orderpriority").alias("transaction_type"),
        ((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09)).alias("is_fraud"),
    )


def txn_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = txn(spark, sf_dir)
    # Senders with labelled fraud before the cut-off: one partial aggregate.
    early_bad = (t.where(F.col("is_fraud") &
                         (F.col("event_time") < F.lit(ROUTE_CUTOFF).cast("timestamp_ntz")) &
                         F.col("sender_account").isNotNull())
                 .groupBy("sender_account").agg(F.lit(True).alias("_early_bad")))
    return (t.join(early_bad, "sender_account", "left")
            .withColumn("fraud_source",
                        F.when(F.col("_early_bad"), F.lit(SOURCE_BLOOM))
                         .when(F.col("amount") > ROUTE_MODEL_AMOUNT, F.lit(SOURCE_MODEL)))
            .drop("_early_bad"))


def fraud_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_routed(spark, sf_dir).where(F.col("fraud_source").isNotNull())


def fraud_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fraud stream of txn_big: its labelled fraud rows."""
    return txn_big(spark, sf_dir).where(F.col("is_fraud"))
