"""Topic streams: record encode / decode and stream sources (SRC3, SRC4,
SNK1, FN19, FN13, SRC6).

A topic is a message-bus topic when a broker is configured (the
``kafka`` source and sink, whose connector jar must be on the class path),
otherwise a folder of JSON-lines files on shared storage holding the same
envelope (``key``, ``value`` as text).  Both give the same decoded frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import empty_to_null, text_bool
from ..schema import STREAM_SCHEMA, TRANSACTION_SCHEMA
from ..session import path_exists, publish
from .topic_source import read_records

FILE_TOPIC_SCHEMA = "key string, value string"


def encode(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """SNK1 / FN19: key = ``key`` as text, value = JSON of all columns
    (null fields are omitted from the JSON)."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def decode(envelopes: DataFrame, schema=STREAM_SCHEMA) -> DataFrame:
    """SRC4: value bytes -> text -> ``from_json(schema)`` -> columns.

    Never fails a batch: malformed JSON gives an all-null row (kept, not
    dropped), a field of the wrong type gives a null field.
    """
    return (envelopes.select(F.from_json(F.col("value").cast("string"), schema).alias("data"))
                     .select("data.*"))


def read_topic(spark: SparkSession, topic: str, *, path: str | None = None,
               bootstrap: str | None = None, max_per_trigger: int | None = None,
               starting: str = "latest", progress: str | None = None, max_files: int | None = None,
               options: dict | None = None) -> DataFrame:
    """SRC3: a stream of envelopes, of at most ``max_per_trigger`` records a batch.

    With ``bootstrap`` it subscribes to the bus topic (``starting`` only
    matters on the first run, the checkpoint wins afterwards).  Without it the
    topic is the file folder ``path``:

    * with ``progress`` (a folder that lives as long as the query's
      checkpoint) it is read by record offsets, with the same meaning of
      ``starting`` and ``max_per_trigger`` as on the bus (``topic_source``);
    * without, all of it is read in whole files, ``max_files`` a batch.

    No cap by default: the original's 50 records per batch
    (``schema.MAX_OFFSETS_PER_TRIGGER``) falls ever further behind a
    100 records/s producer; pass it to reproduce that setting.
    """
    if bootstrap:
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", topic)
             .option("startingOffsets", starting))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
    elif progress:
        return read_records(spark, path, progress, starting, max_per_trigger)
    elif max_per_trigger:
        raise ValueError("a cap on the records of a file topic needs a progress folder; max_files caps files")
    else:
        r = spark.readStream.schema(FILE_TOPIC_SCHEMA).format("json")
        if max_files:
            r = r.option("maxFilesPerTrigger", str(max_files))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load() if bootstrap else r.load(path)


def bus_options(topic: str, bootstrap: str) -> dict[str, str]:
    """Options of a bus sink."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def write_topic(df: DataFrame, topic: str, *, path: str | None = None, bootstrap: str | None = None,
                batch_id: int | None = None) -> None:
    """SNK1: write a batch of envelopes to a topic, the bus or a file folder.

    A file topic gets a folder for each ``batch_id``, written aside and then
    renamed, so a batch that is run again changes nothing.  A bus may get such
    a batch twice; readers tell by the record's id.
    """
    rows = df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    if bootstrap:
        rows.write.format("kafka").options(**bus_options(topic, bootstrap)).save()
    elif batch_id is None:
        rows.write.mode("append").json(path)
    else:
        done = f"{path}/batch-{batch_id:012d}"
        if not path_exists(df.sparkSession, done):
            staged = f"{path}.staged/batch-{batch_id:012d}"
            rows.write.mode("overwrite").json(staged)
            publish(df.sparkSession, staged, done)


def keyed_handoff(df: DataFrame, key: str = "sender_account", order: str = "timestamp",
                  partitions: int | None = None) -> DataFrame:
    """SRC6: envelopes keyed by ``key``; one key's rows land in one
    partition, in ``order`` (what a keyed topic partition guarantees).
    ``seq`` is a row's place in its key's sequence, from 0.

    One shuffle: the rows are dealt by the key, and the window that numbers
    them finds them so and sorts them within their partition.  A hot key stays
    in one partition because per-key order is the contract; Spark's external
    sort spills it rather than failing.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seq = F.row_number().over(Window.partitionBy(key).orderBy(order, "transaction_id")) - 1
    return (df.repartition(n, F.col(key)).withColumn("_seq", seq)
              .select(F.col(key).cast("string").alias("key"),
                      F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"),
                      F.spark_partition_id().alias("partition"), F.col("_seq").alias("seq")))


def coerce_text_record(df: DataFrame) -> DataFrame:
    """FN13: typed record from an all-text row (as read from CSV text).

    Numbers are cast (a malformed required number is an error under ANSI,
    as in the producer), booleans are 'True'/'true'/'1', empty optional
    text / numbers become null.
    """
    c = F.col
    return df.select(
        c("transaction_id"), c("timestamp"), c("sender_account"), c("receiver_account"),
        c("amount").cast("double").alias("amount"),
        c("transaction_type"), c("merchant_category"), c("location"), c("device_used"),
        text_bool("is_fraud").alias("is_fraud"),
        empty_to_null("fraud_type").alias("fraud_type"),
        empty_to_null("time_since_last_transaction").cast("double")
            .alias("time_since_last_transaction"),
        c("spending_deviation_score").cast("double").alias("spending_deviation_score"),
        c("velocity_score").cast("int").alias("velocity_score"),
        c("geo_anomaly_score").cast("double").alias("geo_anomaly_score"),
        c("payment_channel"), c("ip_address"), c("device_hash"))


def as_text(df: DataFrame) -> DataFrame:
    """Every transaction field as text, null -> '' (the CSV-cell view)."""
    return df.select(*[F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name)
                       for f in TRANSACTION_SCHEMA.fields])
