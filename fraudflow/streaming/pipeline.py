"""The online topology (ST1-ST11, FLT4, FLT5, SET2, UDF1, ML9, Q1-Q8).

Stage 1+2 run as **one** ``foreachBatch`` over the raw transaction stream:
each micro-batch is tagged once with the Bloom filter, the non-hits are
scored by the fitted pipeline, and the results fan out — hits and model
hits to the fraud topic (SET2), the remainder to the other topic, the
model-cleared rows to ``ml_not_fraud`` (Q8), rows the assembler would skip
to ``unscored`` — plus a *routed* topic with every row and its
``fraud_source``.  No broker hop between stages, no re-parse, one scan.

Stage 3 (insights) reads the routed topic: each window aggregate is its own
append-mode stateful query with its own checkpoint and idempotent table
sink.  The watermark follows the rows each aggregate reads: Catalyst pushes
the fraud filter below the watermark, so fraud-only aggregates close on
the fraud rows' event time (as with a separate fraud topic), while the
rate and the per-type summary close on all traffic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows as W
from ..operators.alerts import fraud_alerts, is_model_fraud, is_model_not_fraud
from ..schema import (NOT_FRAUD_COLUMNS, ONLINE_THRESHOLD, SOURCE_BLOOM, SOURCE_MODEL,
                      STREAM_COLUMNS, SUMMARY_KEYS, TRANSACTION_COLUMNS, WATERMARK_2M, WINDOW_2M, WINDOW_KEYS)
from ..sources.topics import decode, encode, read_topic, write_topic
from .lateness import lateness_sink
from .sinks import start_table_query, table_sink
from .upsert import KeyedTable, upsert_sink


def tag_bloom(df: DataFrame, bf, out: str = "sender_blacklisted") -> DataFrame:
    """UDF1 / JN3: Bloom hit flag per row (null sender -> false)."""
    return bf.might_contain(df, "sender_account", out=out)


def split_bloom(tagged: DataFrame, flag: str = "sender_blacklisted"):
    """FLT4: (hits tagged 'bloom_filter', non-hits) — disjoint, covering."""
    hits = tagged.where(F.col(flag)).withColumn("fraud_source", F.lit(SOURCE_BLOOM))
    rest = tagged.where(~F.col(flag))
    return hits.drop(flag), rest.drop(flag)


def score_other(other: DataFrame, model, threshold: float = ONLINE_THRESHOLD) -> DataFrame:
    """ML9: score the non-hits with the fitted pipeline."""
    from ..plans.model import score
    cols = [c for c in TRANSACTION_COLUMNS if c in other.columns]
    return score(model, other.select(*cols), threshold)


def split_model(scored: DataFrame, threshold: float = ONLINE_THRESHOLD):
    """FLT5: (model hits tagged 'ml_model', model-cleared rows)."""
    fraud = scored.where(is_model_fraud(threshold=threshold)).withColumn(
        "fraud_source", F.lit(SOURCE_MODEL))
    clear = scored.where(is_model_not_fraud(threshold=threshold))
    return fraud, clear


def as_stream_record(df: DataFrame) -> DataFrame:
    """The 19-field record of the fraud / routed topics."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in STREAM_COLUMNS])


@dataclass
class TopologyPaths:
    base: str

    def topic(self, name: str) -> str:
        return f"{self.base}/topics/{name}"

    def table(self, name: str) -> str:
        return f"{self.base}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    def progress(self, name: str) -> str:
        return f"{self.base}/progress/{name}"


ROUTED_TOPICS = ("other_transactions", "fraud_transactions", "routed_transactions")


def route_batch(bf, model, paths: TopologyPaths, threshold: float = ONLINE_THRESHOLD, bootstrap: str | None = None):
    """Stage 1+2 as one ``foreachBatch`` function (ST9, SET2, FLT4, FLT5).

    A batch that is run again after a failure leaves file topics and tables
    as they are.  ``bootstrap`` sends the topics to that bus instead.
    """
    from ..plans.model import unscored
    not_fraud_sink = table_sink(paths.table("ml_not_fraud"))
    unscored_sink = table_sink(paths.table("unscored"))

    def run(batch: DataFrame, batch_id: int) -> None:
        held = [batch.persist(StorageLevel.MEMORY_AND_DISK)]
        try:
            if batch.isEmpty():
                return
            hits, other = split_bloom(tag_bloom(batch, bf))
            scored = score_other(other, model, threshold)
            # held without the model's features and vectors
            scored = scored.select(*[c for c in TRANSACTION_COLUMNS if c in scored.columns], "fraud_probability", "is_fraud_prediction")
            held.append(scored := scored.persist(StorageLevel.MEMORY_AND_DISK))
            ml_fraud, clear = split_model(scored, threshold)
            # rows the assembler skips (a null / NaN numeric input): same rule
            # as the model's VectorAssembler, as a predicate (ids may repeat)
            skipped = as_stream_record(unscored(other.select(*[c for c in TRANSACTION_COLUMNS if c in other.columns])))
            held.append(skipped := skipped.persist(StorageLevel.MEMORY_AND_DISK))
            fraud = as_stream_record(hits).unionByName(as_stream_record(ml_fraud))
            by_model = F.when(is_model_fraud(threshold=threshold), F.lit(SOURCE_MODEL))
            routed = (as_stream_record(hits).unionByName(as_stream_record(scored.withColumn("fraud_source", by_model)))
                      .unionByName(skipped))
            for name, df in zip(ROUTED_TOPICS, (as_stream_record(other), fraud, routed)):
                write_topic(encode(df), name, path=paths.topic(name), bootstrap=bootstrap, batch_id=batch_id)
            not_fraud_sink(clear.select(*NOT_FRAUD_COLUMNS), batch_id)
            unscored_sink(skipped, batch_id)
        finally:
            for df in held:
                df.unpersist()
    return run


def insights(routed: DataFrame, duration: str = WINDOW_2M, watermark: str = WATERMARK_2M,
             receiver_threshold: int = 10, dedupe_alerts: bool = False, again: DataFrame | None = None) -> dict[str, DataFrame]:
    """Stage 3 (Q1-Q6) over a decoded routed stream (see the module note on
    which rows drive each watermark).  ``again`` is the same topic read a
    second time, for the join of two streams."""
    s = W.with_event_time(routed, watermark)
    is_fraud = F.col("fraud_source").isNotNull()
    fraud = s.where(is_fraud)
    other = fraud if again is None else W.with_event_time(again, watermark).where(is_fraud)
    return {
        "fraud_rate_2m": W.fraud_rate(s, is_fraud, duration),
        # Q1 as the original states it (JN5): two window counts with a watermark
        # each, joined as streams; one more stateful operator than fraud_rate_2m
        "fraud_rate_join_2m": W.fraud_rate_join(W.window_counts(s, "total_tx_2m", duration, flatten=False),
                                                W.window_counts(other, "fraud_tx_2m", duration, flatten=False)),
        "fraud_loss_2m": W.fraud_loss(fraud, duration),
        "fraud_minmax_2m": W.fraud_minmax(fraud, duration),
        "suspicious_receivers_2m": W.suspicious_receivers(fraud, duration, receiver_threshold),
        # ST11: optional exactly-once alerts by id (state kept for the watermark delay)
        "fraud_alerts_realtime": (fraud_alerts(fraud.dropDuplicatesWithinWatermark(["transaction_id"]))
                                  if dedupe_alerts else fraud_alerts(fraud)),
        "summary_by_type_2m": W.summary_by_type(s, is_fraud, duration),
        # the two-table form of Q6 (totals from all traffic, fraud counts from
        # the fraud rows), merged by the serving layer (serving.merge_summary)
        "summary_total_by_type_2m": W.summary_total_by_type(s, duration),
        "summary_fraud_by_type_2m": W.summary_fraud_by_type(fraud, duration),
    }


# Output mode per insight: windows are emitted once when closed (append);
# the suspicious-receiver list is re-emitted as it grows (update, ST4) and
# readers keep the last version per key (serving.latest_per_key).  In mode
# "upsert" an insight is updated in a KeyedTable, one row a key.
OUTPUT_MODES = {"suspicious_receivers_2m": "update"}
KEYS = {"suspicious_receivers_2m": ["receiver_account", *WINDOW_KEYS], "summary_by_type_2m": SUMMARY_KEYS,
        "fraud_rate_2m": WINDOW_KEYS, "fraud_loss_2m": WINDOW_KEYS, "fraud_minmax_2m": WINDOW_KEYS}
#: insights that run only if named, and read the topic twice
ON_REQUEST = {"fraud_rate_join_2m"}


#: when an insight runs: the activity summaries every two minutes, all others
#: whenever the last batch has ended (ST7)
EVERY_2M = {"processingTime": "2 minutes"}
TRIGGERS = {"summary_by_type_2m": EVERY_2M, "summary_total_by_type_2m": EVERY_2M, "summary_fraud_by_type_2m": EVERY_2M}


def start_insights(spark: SparkSession, paths: TopologyPaths, names=None, trigger=None,
                   max_files: int | None = None, modes: dict | None = None, bootstrap: str | None = None,
                   max_records: int | None = None, **kw) -> dict:
    """Start the stage-3 queries reading the routed topic; returns the running
    queries by name.  ``trigger`` is one for all, or a dict by name with
    ``None`` for the rest (see TRIGGERS).  ``max_records`` reads file topics by
    record offsets, that many a batch."""
    qs = {}
    modes = {**OUTPUT_MODES, **(modes or {})}
    for name in names or insight_names():
        read = lambda part: decode(_read_routed(spark, paths, part, max_files, bootstrap, max_records))
        again = read(f"{name}-again") if name in ON_REQUEST else None
        df = insights(read(name), again=again, **kw)[name]
        own = trigger.get(name, trigger[None]) if trigger and None in trigger else trigger
        mode, sink = modes.get(name, "append"), None
        if mode == "upsert":
            # a record is in one group of each of these, so no more groups change than records come
            mode, sink = "update", upsert_sink(KeyedTable(spark, paths.table(name), KEYS[name]), most=max_records if not bootstrap else None)
        qs[name] = start_table_query(df, paths.table(name), paths.checkpoint(name), mode=mode, trigger=own, sink=sink)
    return qs


def insight_names() -> list[str]:
    return ["fraud_rate_2m", "fraud_loss_2m", "fraud_minmax_2m", "suspicious_receivers_2m", "fraud_alerts_realtime",
            "summary_by_type_2m", "summary_total_by_type_2m", "summary_fraud_by_type_2m"]


def start_lateness(spark: SparkSession, paths: TopologyPaths, trigger=None, max_records: int | None = None,
                   bootstrap: str | None = None):
    """ST5: count the late rows of the routed topic, batch by batch (``lateness.lateness_sink``)."""
    name = "late_rows"
    env = _read_routed(spark, paths, name, None, bootstrap, max_records)
    rows = W.with_event_time(decode(env), watermark=None).select("event_time")
    return start_table_query(rows, paths.table(name), paths.checkpoint(name), trigger=trigger, sink=lateness_sink(paths.table(name)))


def _read_routed(spark, paths: TopologyPaths, name: str, max_files=None, bootstrap=None, max_records=None):
    # read from the topic's start on the first run: insights miss nothing routed before
    topic = paths.topic("routed_transactions")
    return read_topic(spark, "routed_transactions", path=topic if max_records else f"{topic}/*",
                      bootstrap=bootstrap, starting="earliest", max_per_trigger=max_records, max_files=max_files,
                      progress=paths.progress(name) if max_records and not bootstrap else None)


def start_routing(spark: SparkSession, raw_path: str | None, bf, model, paths: TopologyPaths,
                  trigger=None, max_files: int | None = None,
                  threshold: float = ONLINE_THRESHOLD, bootstrap: str | None = None,
                  raw_topic: str = "transactions_raw", max_records: int | None = None, starting: str | None = None):
    """Start stage 1+2 over the raw stream: a file topic folder, or the bus
    topic ``raw_topic`` when ``bootstrap`` names the brokers (then the routed
    topics go to the bus too).  ``max_records`` and ``starting`` (latest,
    earliest) read a file topic by record offsets; without them all of it is
    read, in whole files."""
    by_record = (max_records or starting) and not bootstrap
    env = read_topic(spark, raw_topic, path=raw_path, bootstrap=bootstrap, starting=starting or "latest",
                     max_per_trigger=max_records, max_files=max_files,
                     progress=paths.progress("routing") if by_record else None)
    raw = decode(env)
    w = (raw.writeStream.option("checkpointLocation", paths.checkpoint("routing"))
            .foreachBatch(route_batch(bf, model, paths, threshold, bootstrap)))
    trigger = {"availableNow": True} if trigger is None else trigger
    return (w.trigger(**trigger) if trigger else w).start()


def await_all(queries, timeout: float | None = None) -> None:
    for q in (queries.values() if isinstance(queries, dict) else queries):
        q.awaitTermination(timeout)
        if q.exception() is not None:
            raise RuntimeError(f"query {q.name} failed: {q.exception()}")
