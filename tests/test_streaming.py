"""Stream = batch on closed windows, late data, restart, the full topology."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fraudflow.operators import bloom
from fraudflow.operators import windows as W
from fraudflow.operators.senders import bad_senders
from fraudflow.schema import TRANSACTION_COLUMNS
from fraudflow.sources import fixtures as fx
from fraudflow.sources.topics import encode
from fraudflow.streaming.pipeline import (TopologyPaths, await_all, start_insights,
                                          start_routing)
from fraudflow.streaming.sinks import read_table, table_sink


def write_slices(df, path, n):
    """Time-ordered replay: n appends, one per event-time slice, in order."""
    bounds = df.approxQuantile("ts_num", [i / n for i in range(1, n)], 0.0) if n > 1 else []
    edges = [float("-inf")] + bounds + [float("inf")]
    for i in range(n):
        part = df.where((F.col("ts_num") > edges[i]) & (F.col("ts_num") <= edges[i + 1]))
        encode(part.drop("ts_num").orderBy("event_time")).coalesce(1) \
            .write.mode("append").json(f"{path}/slice-{i:03d}")


@pytest.fixture()
def routed(spark):
    return fx.txn_routed(spark, SF_SMALL).withColumn("ts_num", F.col("event_time").cast("timestamp").cast("double"))


def batch_closed(spark, routed, max_delay="2 minutes"):
    mx = routed.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=2)
    r = W.fraud_rate(routed, F.col("fraud_source").isNotNull())
    return r.where(F.col("window_end") <= F.lit(mx)), mx


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


COLS = ["window_start", "window_end", "total_tx_2m", "fraud_tx_2m", "fraud_rate_2m"]


def test_multi_batch_replay_equals_batch(spark, routed, tmp_path):
    paths = TopologyPaths(str(tmp_path))
    write_slices(routed, paths.topic("routed_transactions"), 4)
    qs = start_insights(spark, paths, names=["fraud_rate_2m"], max_files=1)
    await_all(qs)
    got = read_table(spark, paths.table("fraud_rate_2m"))
    assert got.select("_batch").distinct().count() >= 2        # several micro-batches
    exp, _ = batch_closed(spark, routed)
    assert rows(got, COLS) == rows(exp, COLS)


def test_late_event_is_dropped_and_restart_resumes(spark, routed, tmp_path):
    paths = TopologyPaths(str(tmp_path))
    topic = paths.topic("routed_transactions")
    write_slices(routed, topic, 2)
    await_all(start_insights(spark, paths, names=["fraud_rate_2m"], max_files=1))
    before = rows(read_table(spark, paths.table("fraud_rate_2m")), COLS)
    # a row 5 minutes behind the maximum arrives after the watermark moved on
    last = routed.orderBy(F.col("event_time").desc()).limit(1).drop("ts_num")
    late_ts = last.first()["event_time"] - dt.timedelta(minutes=5)
    late = (last.withColumn("transaction_id", F.lit("LATE"))
                .withColumn("timestamp", F.lit(late_ts.strftime("%Y-%m-%dT%H:%M:%S.%f"))))
    encode(late).coalesce(1).write.mode("append").json(f"{topic}/slice-late")
    await_all(start_insights(spark, paths, names=["fraud_rate_2m"], max_files=1))  # restart
    after = rows(read_table(spark, paths.table("fraud_rate_2m")), COLS)
    assert after == before          # nothing re-emitted, late row changed nothing


def test_sink_is_idempotent_per_batch(spark, tmp_path):
    sink = table_sink(str(tmp_path / "t"))
    df = spark.range(5).withColumnRenamed("id", "x")
    sink(df, 0)
    sink(df, 0)             # replay of batch 0 after a failure
    sink(df.limit(0), 1)    # empty batch writes nothing
    t = read_table(spark, str(tmp_path / "t"))
    assert t.count() == 5 and t.select("_batch").distinct().count() == 1


def test_sink_takes_one_job_a_batch(spark, tmp_path):
    """And an empty batch leaves nothing behind."""
    log, sc = [], spark.sparkContext
    sink, logged = table_sink(str(tmp_path / "t")), table_sink(str(tmp_path / "t"), log)
    df = spark.range(5).withColumnRenamed("id", "x")
    sc.setJobGroup("one-batch", "a batch of the table sink")
    try:
        sink(df, 0)
        assert len(sc.statusTracker().getJobIdsForGroup("one-batch")) == 1
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    logged(df, 0)
    logged(df.where("x < 0"), 1)
    logged(spark.createDataFrame([], df.schema), 2)
    logged(df.where("x < 2"), 0)  # a replay replaces
    assert log == [(0, 5), (1, 0), (2, 0), (0, 2)]
    assert [f.name for f in (tmp_path / "t").iterdir()] == ["_batch=0"] and not list((tmp_path / "t.staged").iterdir())
    assert sorted(r["x"] for r in read_table(spark, str(tmp_path / "t")).collect()) == [0, 1]


def test_batches_share_their_code(spark, tmp_path):
    """A batch's number isn't part of its plan: what was compiled for one batch serves the next."""
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME
    sink = table_sink(str(tmp_path / "t"))
    df = spark.range(5, numPartitions=1).withColumnRenamed("id", "x")
    sink(df, 1000)
    before = compiled().getCount()
    sink(df, 1001)
    assert compiled().getCount() == before
    sink(df.withColumn("_batch", F.lit(7)), 1002)  # a column of that name gives way
    got = read_table(spark, str(tmp_path / "t"))
    assert got.columns == ["x", "_row", "_batch"]
    assert sorted((r["_batch"], r["x"]) for r in got.collect()) == [(b, x) for b in (1000, 1001, 1002) for x in range(5)]


def test_state_partitions_follow_the_records_of_a_batch(spark, routed, tmp_path):
    from fraudflow.session import STATE_RECORDS, stream_session
    width = lambda *a: int(stream_session(spark, *a).conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    assert width() == cores and width(500) == 1 and width(STATE_RECORDS + 1) == min(2, cores) and width(STATE_RECORDS * 1000) == cores
    paths = TopologyPaths(str(tmp_path))
    encode(routed.limit(40)).coalesce(1).write.json(f"{paths.topic('routed_transactions')}/part")
    qs = start_insights(stream_session(spark, 20), paths, names=["fraud_rate_2m"], trigger={}, max_records=20)
    qs["fraud_rate_2m"].processAllAvailable()
    qs["fraud_rate_2m"].stop()
    state = tmp_path / "checkpoints/fraud_rate_2m/state/0"
    assert sorted(p.name for p in state.iterdir() if p.name.isdigit()) == ["0"]


def test_full_topology(spark, tmp_path):
    from fraudflow.plans.model import train_model
    t = fx.txn(spark, "/root/testdata/sf0.01").select(*TRANSACTION_COLUMNS)
    bf = bloom.build(bad_senders(t), "sender_account")
    model = train_model(t).model
    raw = fx.txn(spark, SF_SMALL).select(*TRANSACTION_COLUMNS)
    paths = TopologyPaths(str(tmp_path))
    encode(raw.orderBy("timestamp")).coalesce(2).write.json(f"{paths.base}/raw/0")
    q = start_routing(spark, f"{paths.base}/raw/*", bf, model, paths, max_files=None)
    q.awaitTermination()
    assert q.exception() is None
    from fraudflow.sources.topics import decode
    routed = decode(spark.read.schema("key string, value string")
                    .json(f"{paths.topic('routed_transactions')}/*"))
    fraud = decode(spark.read.schema("key string, value string")
                   .json(f"{paths.topic('fraud_transactions')}/*"))
    assert routed.count() == raw.count()                       # no row lost
    assert fraud.count() == routed.where("fraud_source IS NOT NULL").count()
    hits = fraud.where(F.col("fraud_source") == "bloom_filter")
    # every known bad sender's row is routed by the filter
    assert raw.join(bad_senders(t), "sender_account", "left_semi").count() <= hits.count()
    nf = read_table(spark, paths.table("ml_not_fraud"))
    assert nf.count() + fraud.where(F.col("fraud_source") == "ml_model").count() \
        == routed.where("fraud_source IS NULL OR fraud_source = 'ml_model'").count()
    await_all(start_insights(spark, paths, names=["fraud_alerts_realtime", "fraud_loss_2m"]))
    alerts = read_table(spark, paths.table("fraud_alerts_realtime"))
    assert alerts.count() == fraud.count()
    assert os.path.exists(paths.table("fraud_loss_2m"))


def test_update_mode_receivers_latest_version_equals_batch(spark, tmp_path):
    from fraudflow.operators.serving import latest_per_key
    big = fx.txn_big(spark, SF_SMALL).where("is_fraud")
    routed = (big.withColumn("fraud_source", F.lit("ml_model"))
                 .withColumn("ts_num", F.col("event_time").cast("timestamp").cast("double")))
    paths = TopologyPaths(str(tmp_path))
    write_slices(routed, paths.topic("routed_transactions"), 3)
    qs = start_insights(spark, paths, names=["suspicious_receivers_2m"], max_files=1,
                        duration="1 day", receiver_threshold=2)
    await_all(qs)
    t = read_table(spark, paths.table("suspicious_receivers_2m"))
    got = latest_per_key(t, ["window_start", "window_end", "receiver_account"])
    exp = W.suspicious_receivers(routed, "1 day", 2)
    cols = ["receiver_account", "window_start", "window_end", "approx_distinct_senders_2m"]
    assert rows(got, cols) == rows(exp, cols)


def test_alert_dedupe_within_watermark(spark, routed, tmp_path):
    paths = TopologyPaths(str(tmp_path))
    topic = paths.topic("routed_transactions")
    fraud = routed.where("fraud_source IS NOT NULL")
    write_slices(fraud.unionByName(fraud), topic, 1)           # every alert twice
    await_all(start_insights(spark, paths, names=["fraud_alerts_realtime"], dedupe_alerts=True))
    t = read_table(spark, paths.table("fraud_alerts_realtime"))
    assert t.count() == fraud.count() == t.select("transaction_id").distinct().count()


def test_keyed_handoff_keeps_each_key_in_one_ordered_partition(spark):
    from fraudflow.sources.topics import keyed_handoff
    t = fx.txn(spark, SF_SMALL).select(*TRANSACTION_COLUMNS)
    h = keyed_handoff(t, partitions=4).select("key", "partition",
                                              F.get_json_object("value", "$.timestamp").alias("ts"),
                                              F.monotonically_increasing_id().alias("pos"))
    pdf = h.toPandas()
    assert (pdf.groupby("key")["partition"].nunique() == 1).all()
    for _, g in pdf.groupby("key"):
        assert list(g.sort_values("pos")["ts"]) == sorted(g["ts"])


def test_inferred_csv_types(spark, tmp_path):
    from fraudflow.sources.tables import read_inferred, write_sorted
    write_sorted(fx.txn(spark, SF_SMALL).select(*TRANSACTION_COLUMNS), str(tmp_path / "c"))
    types = dict(read_inferred(spark, str(tmp_path / "c")).dtypes)
    assert types["amount"] == "double" and types["velocity_score"] == "int"
    assert types["is_fraud"] == "boolean" and types["fraud_type"] == "string"


def test_normalise_table_parses_text_times(spark):
    from fraudflow.operators.serving import normalise_table
    df = spark.createDataFrame([(1, "2024-01-01T00:02:00.000000", "junk")],
                               "_id int, window_end string, timestamp string")
    r = normalise_table(df).first()
    assert r["_id"] == "1" and r["window_end"] == dt.datetime(2024, 1, 1, 0, 2) and r["timestamp"] is None


def test_stream_stream_left_join_of_window_aggregates(spark, routed, tmp_path):
    """JN5: totals LEFT JOIN fraud counts, both streaming aggregates, append
    mode.  The join emits a window once the global watermark (the minimum
    of both inputs') has passed it; every emitted row equals the batch row."""
    from fraudflow.sources.topics import decode, read_topic
    paths = TopologyPaths(str(tmp_path))
    write_slices(routed, paths.topic("routed_transactions"), 3)
    s = W.with_event_time(decode(read_topic(spark, "r", path=f"{paths.topic('routed_transactions')}/*",
                                            max_files=1)))
    total = W.window_counts(s, "total_tx_2m", flatten=False)
    fraud = W.window_counts(s.where("fraud_source IS NOT NULL"), "fraud_tx_2m", flatten=False)
    joined = W.fraud_rate_join(total, fraud)
    q = (joined.writeStream.outputMode("append").format("memory").queryName("jn5")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("jn5")
    exp, _ = batch_closed(spark, routed)
    assert got.count() > 0
    assert got.select(*COLS).exceptAll(exp.select(*COLS)).count() == 0


def test_processing_time_trigger(spark, routed, tmp_path):
    """ST7: a processing-time trigger (the online job's mode) drains the
    topic and keeps running until stopped."""
    paths = TopologyPaths(str(tmp_path))
    write_slices(routed, paths.topic("routed_transactions"), 2)
    qs = start_insights(spark, paths, names=["fraud_rate_2m"], max_files=1,
                        trigger={"processingTime": "1 second"})
    q = qs["fraud_rate_2m"]
    try:
        q.processAllAvailable()
        assert q.isActive
        got = read_table(spark, paths.table("fraud_rate_2m"))
        exp, _ = batch_closed(spark, routed)
        assert rows(got, COLS) == rows(exp, COLS)
    finally:
        q.stop()


def test_serving_refresh_over_sink_table(spark, routed, tmp_path):
    """SRC5 + bounded store on a real sink table: two refreshes around a new
    micro-batch see every alert once; the store keeps the last per id."""
    from fraudflow.operators.serving import refresh_store
    paths = TopologyPaths(str(tmp_path))
    topic = paths.topic("routed_transactions")
    fraud = routed.where("fraud_source IS NOT NULL")
    write_slices(fraud, topic, 1)
    await_all(start_insights(spark, paths, names=["fraud_alerts_realtime"]))
    table = read_table(spark, paths.table("fraud_alerts_realtime"))
    store, cursor = refresh_store(None, table, None, ["transaction_id"], 5000)
    first = store.count()
    assert first == fraud.count()
    # a second batch: the same alerts again (at-least-once) plus nothing new
    write_slices(fraud, topic, 1)                           # appends new files
    await_all(start_insights(spark, paths, names=["fraud_alerts_realtime"]))
    table = read_table(spark, paths.table("fraud_alerts_realtime"))
    assert table.count() == 2 * first
    store2, cursor2 = refresh_store(store, table, cursor, ["transaction_id"], 5000)
    assert cursor2 > cursor
    assert store2.count() == first                      # duplicates collapse
    assert store2.select("transaction_id").distinct().count() == first
    store3, cursor3 = refresh_store(store2, table, cursor2, ["transaction_id"], 5000)
    assert cursor3 == cursor2 and store3.count() == first   # nothing new
    small, _ = refresh_store(None, table, None, ["transaction_id"], 100)
    assert small.count() == min(100, first)


def test_two_table_summary_merged_by_serving(spark, routed, tmp_path):
    """Q6 as two stream outputs merged in serving (JN4) equals the single
    aggregate on the windows both sides have closed."""
    from fraudflow.operators.serving import latest_per_key, merge_summary
    paths = TopologyPaths(str(tmp_path))
    write_slices(routed, paths.topic("routed_transactions"), 2)
    names = ["summary_total_by_type_2m", "summary_fraud_by_type_2m", "summary_by_type_2m"]
    await_all(start_insights(spark, paths, names=names, max_files=1))
    keys = ["window_start", "window_end", "transaction_type"]
    tot, fr, one = (latest_per_key(read_table(spark, paths.table(n)), keys).drop("_batch", "_row")
                    for n in names)
    merged = merge_summary(tot, fr)
    fraud_closed = fr.agg(F.max("window_end")).first()[0]
    cols = keys + ["total_tx_2m", "total_amount_2m", "avg_amount_2m", "fraud_tx_2m", "fraud_rate_2m"]
    a = rows(merged.where(F.col("window_end") <= F.lit(fraud_closed)), cols)
    b = rows(one.where(F.col("window_end") <= F.lit(fraud_closed)), cols)
    assert a == b and len(a) > 0


def test_router_batch_twice_changes_nothing(spark, tmp_path):
    """Batch 0, insights, batch 0 again, insights: every alert once, the same window counts."""
    from fraudflow.plans.model import train_model
    from fraudflow.streaming.pipeline import route_batch
    t = fx.txn(spark, "/root/testdata/sf0.01").select(*TRANSACTION_COLUMNS)
    bf = bloom.build(bad_senders(t), "sender_account")
    paths = TopologyPaths(str(tmp_path))
    route = route_batch(bf, train_model(t).model, paths)
    raw = fx.txn(spark, SF_SMALL).select(*TRANSACTION_COLUMNS, F.lit(None).cast("string").alias("fraud_source"))
    names = ["fraud_alerts_realtime", "fraud_rate_2m"]

    def seen():
        await_all(start_insights(spark, paths, names=names))
        return [rows(read_table(spark, paths.table(n)), cols) for n, cols in ((names[0], ["transaction_id"]), (names[1], COLS))]

    route(raw, 0)
    first = seen()
    route(raw, 0)
    assert seen() == first and len(first[0]) == len(set(first[0])) > 0


def test_router_holds_a_row_once_and_once_more_scored(spark, tmp_path, monkeypatch):
    """What a batch holds: its rows, the scored ones without features, those not scored."""
    from fraudflow.plans.catalog import rule_model
    from fraudflow.sources.topics import decode
    from fraudflow.streaming.pipeline import route_batch
    bf = bloom.build(spark.createDataFrame([("bad",)], "sender_account string"), "sender_account")
    one = fx.txn(spark, SF_SMALL).select(*TRANSACTION_COLUMNS, F.lit(None).cast("string").alias("fraud_source")).limit(1)
    given = spark.createDataFrame([("a", "bad", 5.0), ("b", "bad", None), ("c", "x1", 5.0), ("d", "x2", 5000.0), ("e", None, 7.0)],
                                  "transaction_id string, sender_account string, amount double")
    raw = given.crossJoin(one.drop(*given.columns)).select(*one.columns)
    nan = raw.where("transaction_id = 'c'").withColumns({"transaction_id": F.lit("f"), "geo_anomaly_score": F.lit(float("nan"))})
    held, persist = [], type(raw).persist
    monkeypatch.setattr(type(raw), "persist", lambda df, *a: held.append(df) or persist(df, *a))
    paths = TopologyPaths(str(tmp_path))
    route_batch(bf, Skipping(rule_model()), paths)(raw.unionByName(nan), 0)
    monkeypatch.undo()
    ids = [{r["transaction_id"] for r in df.select("transaction_id").collect()} for df in held]
    assert ids == [set("abcdef"), set("cde"), set("f")]
    assert set(held[1].columns) == {*TRANSACTION_COLUMNS, "fraud_probability", "is_fraud_prediction"}

    def topic(name):
        rows = decode(spark.read.schema("key string, value string").json(f"{paths.topic(name)}/*"))
        return sorted((r["transaction_id"], r["fraud_source"]) for r in rows.collect())
    hits = [("a", "bloom_filter"), ("b", "bloom_filter")]
    assert topic("routed_transactions") == [*hits, ("c", None), ("d", "ml_model"), ("e", None), ("f", None)]
    assert topic("fraud_transactions") == [*hits, ("d", "ml_model")]
    assert [x for x, _ in topic("other_transactions")] == list("cdef")
    assert sorted(r[0] for r in read_table(spark, paths.table("ml_not_fraud")).select("transaction_id").collect()) == ["c", "e"]
    assert [r[0] for r in read_table(spark, paths.table("unscored")).select("transaction_id").collect()] == ["f"]


class Skipping:
    """A model that skips what can't be scored, as the fitted pipeline does."""

    def __init__(self, model):
        self.model = model

    def transform(self, df):
        return self.model.transform(df.where(~F.isnan("geo_anomaly_score")))


def test_online_plan():
    from fraudflow.streaming.job import plan_online
    files = plan_online("/shared/raw")
    assert files["source"] == {"raw_path": "/shared/raw"} and not files["dedupe_alerts"]
    assert files["routing"] == {} and files["insights"]["summary_total_by_type_2m"] == {"processingTime": "2 minutes"}
    assert files["insights"][None] == {} and "fraud_alerts_realtime" not in files["insights"]
    bus = plan_online("raw_topic", bootstrap="host:1")
    assert bus["source"]["raw_topic"] == "raw_topic" and bus["source"]["bootstrap"] == "host:1" and bus["dedupe_alerts"]
    assert plan_online("x", available_now=True)["routing"] == {"availableNow": True}


def test_missing_table(spark, tmp_path):
    assert read_table(spark, f"file://{tmp_path}/none", schema="a int").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, f"file://{tmp_path}/none")


def test_full_reload_keeps_the_newest(spark, tmp_path):
    from fraudflow.operators.serving import refresh_store
    path = str(tmp_path / "t")
    spark.range(210_000).selectExpr("id AS k", "id AS _row").write.parquet(f"{path}/_batch=0")
    table = read_table(spark, path)
    for step in (None, 80_000):
        store, cursor = refresh_store(None, table, None, ["k"], 5000, fetch_rows=step)
        assert store.count() == 5000 and store.agg(F.min("k")).first()[0] == 205_000 and cursor == (0, 209_999)
        again, same = refresh_store(store, table, cursor, ["k"], 5000, fetch_rows=step)
        assert again.count() == 5000 and same == cursor
