"""Literal edge-case fixtures (bad timestamps, null keys, bad JSON, zero
denominators, arrivals, blank facets, empty inputs, ties)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fraudflow.functions.expressions import parse_event_time, safe_div, to_number
from fraudflow.operators import serving as S
from fraudflow.operators import windows as W
from fraudflow.operators.features import add_features, add_features_cast_variant
from fraudflow.schema import STREAM_SCHEMA, TRANSACTION_SCHEMA
from fraudflow.sources.topics import decode

ROW = dict(transaction_id="T1", timestamp="2024-01-06T03:04:05.123456", sender_account="A1",
           receiver_account="A2", amount=1500.0, transaction_type="transfer",
           merchant_category="travel", location="Tokyo", device_used="web", is_fraud=True,
           fraud_type=None, time_since_last_transaction=1.5, spending_deviation_score=0.1,
           velocity_score=3, geo_anomaly_score=0.2, payment_channel="online",
           ip_address="1.2.3.4", device_hash="D1")


def rows(spark, *updates):
    return spark.createDataFrame([{**ROW, **u} for u in updates], TRANSACTION_SCHEMA)


def test_bad_timestamps(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00.123456",), ("2024-01-01T10:00:00.1",),
                                ("2024-01-01T10:00:00",), ("2024-01-01",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_event_time("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert got[1] == dt.datetime(2024, 1, 1, 10, 0, 0, 100000)
    assert got[2:] == [None, None, None]


def test_features_and_null_keys(spark):
    df = rows(spark, {}, {"sender_account": None}, {"receiver_account": None},
              {"sender_account": None, "receiver_account": None},
              {"transaction_id": "T5", "receiver_account": "A1", "amount": 1000.0,
               "timestamp": "bad"})
    f = add_features(df).orderBy("transaction_id", "sender_account").collect()
    first = [r for r in f if r["sender_account"] == "A1" and r["receiver_account"] == "A2"][0]
    assert (first["hour_of_day"], first["is_night"], first["is_weekend"]) == (3, 1, 1)  # Saturday
    assert (first["is_online_channel"], first["high_risk_merchant"], first["is_large_amount"]) == (1, 1, 1)
    assert all(r["sender_equals_receiver"] == 0 for r in f if r["transaction_id"] == "T1")
    t5 = [r for r in f if r["transaction_id"] == "T5"][0]
    assert t5["sender_equals_receiver"] == 1 and t5["is_large_amount"] == 0  # strict >
    assert t5["event_time"] is None and t5["is_night"] == 0 and t5["is_weekend"] == 0


def test_cast_variant_keeps_nulls_then_drops_rows(spark):
    df = rows(spark, {}, {"transaction_id": "T2", "timestamp": "bad"},
              {"transaction_id": "T3", "payment_channel": None, "time_since_last_transaction": None})
    got = {r["transaction_id"]: r for r in add_features_cast_variant(df).collect()}
    assert set(got) == {"T1", "T3"}                       # null time features dropped
    assert got["T3"]["is_online_channel"] is None          # FN9: null stays null
    assert got["T3"]["time_since_last_transaction"] == 0.0  # FN14


def test_bad_json_never_fails(spark):
    env = spark.createDataFrame(
        [("k", '{"transaction_id": "T1", "amount": 5.0}'), ("k", "not json"),
         ("k", '{"transaction_id": "T2", "amount": "x"}'), ("k", '{"transaction_id": "T3"}'),
         ("k", '{"transaction_id": "T4", "extra": 1}')], "key string, value string")
    out = decode(env, STREAM_SCHEMA).collect()
    assert len(out) == 5
    assert out[0]["amount"] == 5.0 and out[1]["transaction_id"] is None
    assert out[3]["amount"] is None and out[4]["transaction_id"] == "T4"


def test_rate_zero_and_number_coercion(spark):
    df = spark.createDataFrame([(0, None, "x"), (4, 1, "2.5"), (None, 3, None)],
                               "d int, n int, s string")
    got = df.select(safe_div("n", "d").alias("r"), to_number("s").alias("v")).collect()
    assert [r["r"] for r in got] == [0.0, 0.25, 0.0]
    assert [r["v"] for r in got] == [0.0, 2.5, 0.0]


def test_arrivals_keep_last(spark):
    df = spark.createDataFrame([("T1", 1, "a"), ("T1", 2, "b"), ("T1", 3, "c"), ("T2", 1, "d")],
                               "transaction_id string, seq int, v string")
    got = {r["transaction_id"]: r["v"] for r in S.dedupe_keep_last(df, ["transaction_id"], ["seq"]).collect()}
    assert got == {"T1": "c", "T2": "d"}


def test_blank_facets(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",), ("x",)], "c string")
    assert [r[0] for r in S.facet_values(df, "c").collect()] == ["x"]


def test_empty_inputs_give_defaults(spark):
    alerts = spark.createDataFrame([], "transaction_id string, amount double")
    loss = spark.createDataFrame([], "fraud_count_2m bigint, fraud_loss_2m double, "
                                     "window_start timestamp_ntz, window_end timestamp_ntz")
    summary = spark.createDataFrame([], "window_start timestamp_ntz, window_end timestamp_ntz, "
                                        "transaction_type string, fraud_rate_2m double")
    k = S.kpis(alerts, loss, summary).collect()
    assert [tuple(r) for r in k] == [(0, 0, 0.0, "N/A", 0.0)]
    empty = spark.createDataFrame([], STREAM_SCHEMA).withColumn("event_time", F.lit(None).cast("timestamp_ntz"))
    assert W.fraud_loss(empty).count() == 0
    assert S.merge_summary(W.summary_total_by_type(empty), None).count() == 0


def test_merge_without_fraud_table_adds_zero(spark):
    tot = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 2), "a", 4, 10.0, 2.5)],
                                "window_start timestamp_ntz, window_end timestamp_ntz, "
                                "transaction_type string, total_tx_2m bigint, total_amount_2m double, "
                                "avg_amount_2m double")
    r = S.merge_summary(tot, None).first()
    assert (r["fraud_tx_2m"], r["fraud_rate_2m"]) == (0, 0.0)


def test_ties_are_deterministic(spark):
    summary = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 2), "b", 0.5), (dt.datetime(2024, 1, 1, 0, 2), "a", 0.5),
         (dt.datetime(2024, 1, 1, 0, 0), "c", 0.9)],
        "window_end timestamp_ntz, transaction_type string, fraud_rate_2m double")
    r = S.worst_type_latest(summary).first()
    assert (r["transaction_type"], r["fraud_rate_2m"]) == ("a", 0.5)


def test_alert_filters_empty_list_means_no_filter(spark):
    from fraudflow.schema import ALERT_COLUMNS
    df = spark.createDataFrame([("T1", "t", "A", "B", 50.0, "x", "m", "c", "bloom_filter"),
                                ("T2", "t", "A", "B", None, "y", "m", "c", "ml_model"),
                                ("T3", "t", "A", "B", 5000.0, "y", "n", "d", "ml_model")],
                               ", ".join(f"{c} {'double' if c == 'amount' else 'string'}"
                                         for c in ALERT_COLUMNS))
    f = S.filter_alerts(df, types=[], categories=[], channels=[], amount_range=(0, 10000))
    assert f.count() == 2                                  # null amount out of range
    v = S.alerts_view(f, limit=1).collect()
    assert v[0]["HIGH_AMOUNT"] is True and v[0]["transaction_id"] == "T3"
    assert S.alerts_view(f).columns[0] == "HIGH_AMOUNT"


def test_event_time_is_zone_free(spark):
    """A wall-clock time inside a daylight-saving gap survives parse and
    format in any session time zone."""
    from fraudflow.functions.expressions import format_event_time
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("1999-04-04T02:15:08.000001",)], "t string")
        r = df.select(parse_event_time("t").alias("e")).select(
            "e", format_event_time("e").alias("back")).first()
        assert r["e"] == dt.datetime(1999, 4, 4, 2, 15, 8, 1)
        assert r["back"] == "1999-04-04T02:15:08.000001"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def money_rows(spark, amounts):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, i % 60), "t", a) for i, a in enumerate(amounts)],
                                 "event_time timestamp_ntz, transaction_type string, amount double")


def test_money_is_exact_and_partition_independent(spark):
    amounts = [48146.51] * 31 + [0.1, 0.2, 0.3] * 7
    cents = sum(round(a * 100) for a in amounts)
    df = money_rows(spark, amounts)
    outs = {tuple(W.summary_total_by_type(df.repartition(n), "1 day").select("total_amount_2m", "avg_amount_2m").first())
            for n in (1, 3, 7)}
    assert outs == {(cents / 100, cents / 100 / len(amounts))}


def test_money_survives_bad_and_large_amounts(spark):
    """NaN, infinities and nulls count as rows but add nothing; large and tiny amounts are kept."""
    bad = [float("nan"), float("inf"), float("-inf"), None]
    for amounts, total in (([5e12] * 2, 1e13), ([1e20] * 3, 3e20), ([4e-7] * 1000, 4e-4), ([1e-7], 1e-7), ([], 0.0)):
        df = money_rows(spark, amounts + bad)
        loss = W.fraud_loss(df, "1 day").first()
        assert (loss["fraud_count_2m"], loss["fraud_loss_2m"]) == (len(amounts) + 4, total)
        s = W.summary_by_type(df, F.lit(True), "1 day").first()
        assert s["total_amount_2m"] == total
        assert s["avg_amount_2m"] == (pytest.approx(total / len(amounts)) if amounts else None)


def test_kpi_alert_count_is_that_of_the_store(spark):
    alerts = spark.range(7).selectExpr("CAST(id AS STRING) AS transaction_id")
    loss = spark.createDataFrame([], "fraud_count_2m bigint, fraud_loss_2m double, "
                                     "window_start timestamp_ntz, window_end timestamp_ntz")
    summary = spark.createDataFrame([], "window_start timestamp_ntz, window_end timestamp_ntz, "
                                        "transaction_type string, fraud_rate_2m double")
    assert S.kpis(alerts, loss, summary).first()["alerts_count"] == 7
    assert S.kpis(S.last_n(alerts, 5, ["transaction_id"]), loss, summary).first()["alerts_count"] == 5


def test_worst_type_reads_its_input_once(spark):
    summary = spark.createDataFrame([(1, 2, "a", 0.5), (2, 3, "b", None), (2, 3, "c", 0.1), (2, None, "d", 0.9)],
                                    "window_start int, window_end int, transaction_type string, fraud_rate_2m double")
    out = S.worst_type_latest(summary)
    assert tuple(out.first()) == (3, "c", 0.1)
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_facets_are_unfiltered_unless_chosen(spark):
    df = spark.createDataFrame([(f"T{i}", f"type{i:02d}" if i else " ", f"m{i:02d}", float(i)) for i in range(25)],
                               "transaction_id string, transaction_type string, merchant_category string, amount double")
    assert S.filter_alerts(df).count() == 25
    first = S.first_facets(df, "transaction_type", 10)
    assert first == [f"type{i:02d}" for i in range(1, 11)]
    assert S.filter_alerts(df, types=first).count() == 10
    assert S.filter_alerts(df, types=first, amount_range=(5, 7)).count() == 3
    assert S.summary_view(df).count() == 24 and S.summary_view(df, ["type03"]).count() == 1
    assert S.raw_alerts_view(df, 3, ["transaction_id"]).columns == ["transaction_id", "amount", "transaction_type", "merchant_category"]


def test_null_keys_pass_the_filter_by(spark):
    from fraudflow.operators import bloom
    keys = spark.range(2000).selectExpr("concat('K', id) AS k")
    bf = bloom.build(keys, "k")
    probe = keys.unionByName(spark.range(2000).selectExpr("CAST(null AS STRING) AS k"))
    for bound, packed in ((0, False), (bloom.DEFAULT_MAX_BROADCAST_BLOCKS, False), (0, True)):
        out = bf.might_contain(probe, "k", max_broadcast_blocks=bound, packed=packed)
        assert out.where("bf_hit").count() == 2000 and out.where("k IS NULL AND NOT bf_hit").count() == 2000
    bf.release()


def test_comparison_deals_rows_out_by_their_number(spark, monkeypatch):
    """A task of a comparison holds a bounded number of rows, however many there are."""
    from fraudflow.plans import catalog
    monkeypatch.setattr(catalog, "SAME_ROWS", 100, raising=False)
    a = spark.range(1000).selectExpr("if(id % 10 = 0, null, id) AS x", "id % 3 AS y")
    same = catalog._same_rows(a, a.orderBy("y"))
    assert "hashpartitioning(r" in (plan := same._jdf.queryExecution().executedPlan().toString()) and ", 20), REPARTITION_BY_NUM" in plan
    assert tuple(same.first()) == (1000, True)
    assert tuple(catalog._same_rows(a, a.where("x IS NULL OR x <> 7")).first()) == (1000, False)
    assert tuple(catalog._same_rows(a.union(a.where("x = 7")), a).first()) == (1001, False)
    assert tuple(catalog._same_rows(a.limit(0), a.limit(0)).first()) == (0, True)
