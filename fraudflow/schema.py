"""Transaction schema and the fixed values the pipeline must agree on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for equal results).
# ---------------------------------------------------------------------------
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
WINDOW_2M = "2 minutes"
WATERMARK_2M = "2 minutes"
BLOOM_FPP = 0.01
HIGH_RISK_MERCHANTS = ["online", "travel", "entertainment"]
ONLINE_CHANNEL = "online"
LARGE_AMOUNT = 1000.0            # is_large_amount: amount > 1000.0 (strict)
HIGH_AMOUNT_THRESHOLD = 1000.0   # alert flag: amount >= threshold (non-strict)
NIGHT_HOURS = (0, 5)             # hour BETWEEN 0 AND 5
WEEKEND_DAYS = [1, 7]            # dayofweek: 1 = Sunday, 7 = Saturday
OFFLINE_THRESHOLD = 0.15
ONLINE_THRESHOLD = 0.5
SWEEP_THRESHOLDS = [0.05, 0.10, 0.15, 0.20]
SAMPLE_FRACTIONS = {False: 0.2, True: 1.0}
SPLIT_WEIGHTS = [0.8, 0.2]
SEED = 42
ALERTS_LIMIT = 500
SOURCE_BLOOM = "bloom_filter"
SOURCE_MODEL = "ml_model"
MAX_OFFSETS_PER_TRIGGER = 50
RETENTION = {"alerts": 5000, "windows": 5000, "summary": 20000, "not_fraud": 3000}
RF_PARAMS = dict(numTrees=100, maxDepth=10, subsamplingRate=0.7,
                 featureSubsetStrategy="sqrt", seed=42)
CATEGORICAL_COLS = ["transaction_type", "merchant_category", "location",
                    "device_used", "payment_channel"]
NUMERIC_FEATURE_COLS = ["amount", "time_since_last_transaction",
                        "spending_deviation_score", "velocity_score",
                        "geo_anomaly_score", "hour_of_day", "is_night",
                        "is_weekend", "is_online_channel", "high_risk_merchant",
                        "is_large_amount", "sender_equals_receiver"]
PROFILE_CATEGORICAL = ["transaction_type", "merchant_category", "location",
                       "device_used", "fraud_type", "payment_channel"]
HIGH_CARDINALITY = ["sender_account", "receiver_account", "ip_address",
                    "device_hash"]
ALERT_COLUMNS = ["transaction_id", "timestamp", "sender_account",
                 "receiver_account", "amount", "transaction_type",
                 "merchant_category", "payment_channel", "fraud_source"]
NOT_FRAUD_COLUMNS = ["transaction_id", "sender_account", "receiver_account",
                     "amount", "transaction_type", "merchant_category",
                     "payment_channel", "fraud_probability",
                     "is_fraud_prediction"]
SUMMARY_KEYS = ["window_start", "window_end", "transaction_type"]
WINDOW_KEYS = ["window_start", "window_end"]
# ---------------------------------------------------------------------------

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("sender_account", T.StringType()),
    T.StructField("receiver_account", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("device_used", T.StringType()),
    T.StructField("is_fraud", T.BooleanType()),
    T.StructField("fraud_type", T.StringType()),
    T.StructField("time_since_last_transaction", T.DoubleType()),
    T.StructField("spending_deviation_score", T.DoubleType()),
    T.StructField("velocity_score", T.IntegerType()),
    T.StructField("geo_anomaly_score", T.DoubleType()),
    T.StructField("payment_channel", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("device_hash", T.StringType()),
])

STREAM_SCHEMA = T.StructType(
    TRANSACTION_SCHEMA.fields + [T.StructField("fraud_source", T.StringType())])

TRANSACTION_COLUMNS = [f.name for f in TRANSACTION_SCHEMA.fields]
STREAM_COLUMNS = [f.name for f in STREAM_SCHEMA.fields]
