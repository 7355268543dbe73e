"""Offline job -> artefacts -> online job over a replayed raw topic."""

from pyspark.sql import functions as F

from fraudflow.plans.offline import run_offline
from fraudflow.schema import TRANSACTION_COLUMNS
from fraudflow.sources import fixtures as fx
from fraudflow.sources.tables import read_transactions, write_sorted
from fraudflow.sources.topics import encode
from fraudflow.streaming.job import run_online
from fraudflow.streaming.sinks import read_table


def test_offline_then_online(spark, tmp_path):
    t = fx.txn(spark, "/root/testdata/sf0.01").select(*TRANSACTION_COLUMNS)
    csv = str(tmp_path / "csv")
    write_sorted(t, csv)                                          # SNK3
    out = str(tmp_path / "artefacts")
    res = run_offline(spark, read_transactions(spark, csv), out)  # SRC1 -> SNK4/SNK5
    assert res["total_tx"] == 10000 and res["distinct_bad_senders"] == 38
    raw = str(tmp_path / "raw")
    encode(fx.txn(spark, "/root/testdata/sf0.001").select(*TRANSACTION_COLUMNS)
           .orderBy("timestamp")).coalesce(1).write.json(f"{raw}/0")
    online = str(tmp_path / "online")
    qs = run_online(spark, f"{raw}/*", out, online, available_now=True)
    assert all(q.exception() is None for q in qs)
    alerts = read_table(spark, f"{online}/tables/fraud_alerts_realtime")
    assert alerts.count() >= 2                                     # the labelled fraud senders
    s = read_table(spark, f"{online}/tables/summary_by_type_2m")
    assert s.where(F.col("fraud_rate_2m") > 1).count() == 0


def test_online_job_by_record_offsets(spark, tmp_path):
    """``starting`` and ``max_records`` reach the raw stream; a backfill takes all in one go instead."""
    import pytest

    from fraudflow.operators import bloom
    from fraudflow.plans.catalog import rule_model
    from fraudflow.streaming.pipeline import TopologyPaths, start_routing
    t = fx.txn(spark, "/root/testdata/sf0.001")
    encode(t.select(*TRANSACTION_COLUMNS).orderBy("timestamp")).coalesce(1).write.json(str(tmp_path / "raw" / "0"))
    paths = TopologyPaths(str(tmp_path / "online"))
    bf = bloom.build(t.where("is_fraud"), "sender_account")
    q = start_routing(spark, str(tmp_path / "raw"), bf, rule_model(), paths, trigger={}, max_records=300, starting="earliest")
    q.processAllAvailable()
    q.stop()
    batches = [len(list((tmp_path / "online/topics/routed_transactions" / f"batch-{i:012d}").glob("*.json"))) for i in range(4)]
    assert all(batches)
    routed = spark.read.schema("key string, value string").json(f"{paths.topic('routed_transactions')}/*")
    assert routed.select("key").distinct().count() == routed.count() == t.count()
    with pytest.raises(ValueError, match="max_records"):
        run_online(spark, "raw", str(tmp_path), str(tmp_path), available_now=True, max_records=5)
