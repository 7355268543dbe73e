"""Query catalogue: one entry per operator / query of the plan.

``QUERIES[name]`` is a callable ``(spark, sf_dir) -> DataFrame``;
``ORACLE[name]`` (when present) is the equivalent DuckDB SQL.  Entries that
are not SQL-expressible (random sampling, the fitted model, the streaming
topology) have no oracle and are checked by property tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows as W
from ..session import stream_session
from ..sources import fixtures as fx
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


#: decimals of money and rates in the catalogue's results (the library doesn't round)
DECIMALS = {"fraud_loss": 2, "last_fraud_loss": 2, "total_amount": 2, "avg_amount": 6, "fraud_rate": 6, "worst_rate": 6}


def rounded(df: DataFrame) -> DataFrame:
    """Money and rate columns as both engines show them."""
    stems = {c: DECIMALS.get(c.removesuffix("_2m").removesuffix("_1d")) for c, t in df.dtypes if t == "double"}
    return df.withColumns({c: F.round(c, n) for c, n in stems.items() if n is not None})


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark, sf_dir):
            return rounded(fn(spark, sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# Q1-Q4, Q6: window aggregates over the routed fraud stream (2-minute
# windows on txn) and over txn_big's labelled fraud (1-day windows).
# ---------------------------------------------------------------------------

@query("fraud_loss_2m", O.with_ctes(O.ROUTED_CTE, f"""
SELECT CAST(count(*) AS BIGINT) AS fraud_count_2m, round(sum(amount), 2) AS fraud_loss_2m,
       {O.w2m()} AS window_start, {O.w2m()} + INTERVAL '2 minutes' AS window_end
FROM fraud_txn GROUP BY ALL"""))
def q_fraud_loss_2m(spark, sf):
    return W.fraud_loss(fx.fraud_txn(spark, sf))


@query("fraud_minmax_2m", O.with_ctes(O.ROUTED_CTE, f"""
SELECT min(amount) AS min_fraud_amount_2m, max(amount) AS max_fraud_amount_2m,
       {O.w2m()} AS window_start, {O.w2m()} + INTERVAL '2 minutes' AS window_end
FROM fraud_txn GROUP BY ALL"""))
def q_fraud_minmax_2m(spark, sf):
    return W.fraud_minmax(fx.fraud_txn(spark, sf))


@query("fraud_rate_2m", O.with_ctes(O.ROUTED_CTE, f"""
SELECT {O.w2m()} AS window_start, {O.w2m()} + INTERVAL '2 minutes' AS window_end,
       CAST(count(*) AS BIGINT) AS total_tx_2m,
       CAST(count(*) FILTER (WHERE fraud_source IS NOT NULL) AS BIGINT) AS fraud_tx_2m,
       round(count(*) FILTER (WHERE fraud_source IS NOT NULL) / count(*), 6) AS fraud_rate_2m
FROM txn_routed GROUP BY ALL"""))
def q_fraud_rate_2m(spark, sf):
    routed = fx.txn_routed(spark, sf)
    return W.fraud_rate(routed, F.col("fraud_source").isNotNull())


@query("fraud_rate_2m_join")
def q_fraud_rate_2m_join(spark, sf):
    """JN5 form of Q1: totals LEFT JOIN fraud counts (same result as fraud_rate_2m)."""
    total = W.window_counts(fx.txn(spark, sf), "total_tx_2m")
    fraud = W.window_counts(fx.fraud_txn(spark, sf), "fraud_tx_2m")
    return W.fraud_rate_join(total, fraud)


ORACLE["fraud_rate_2m_join"] = ORACLE["fraud_rate_2m"]


@query("summary_total_by_type_2m", O.with_ctes(O.TXN_CTE, f"""
SELECT transaction_type, CAST(count(*) AS BIGINT) AS total_tx_2m,
       round(sum(amount), 2) AS total_amount_2m, {O.avg_money()} AS avg_amount_2m,
       {O.w2m()} AS window_start, {O.w2m()} + INTERVAL '2 minutes' AS window_end
FROM txn GROUP BY ALL"""))
def q_summary_total_by_type_2m(spark, sf):
    return W.summary_total_by_type(fx.txn(spark, sf))


@query("summary_fraud_by_type_2m", O.with_ctes(O.ROUTED_CTE, f"""
SELECT transaction_type, CAST(count(*) AS BIGINT) AS fraud_tx_2m,
       {O.w2m()} AS window_start, {O.w2m()} + INTERVAL '2 minutes' AS window_end
FROM fraud_txn GROUP BY ALL"""))
def q_summary_fraud_by_type_2m(spark, sf):
    return W.summary_fraud_by_type(fx.fraud_txn(spark, sf))


# 1-day twins over txn_big (3,002 fraud rows at sf0.01).

@query("fraud_loss_1d", O.with_ctes(O.BIG_CTE, f"""
SELECT CAST(count(*) AS BIGINT) AS fraud_count_1d, round(sum(amount), 2) AS fraud_loss_1d,
       {O.w1d()} AS window_start, {O.w1d()} + INTERVAL '1 day' AS window_end
FROM fraud_big GROUP BY ALL"""))
def q_fraud_loss_1d(spark, sf):
    return W.fraud_loss(fx.fraud_big(spark, sf), "1 day", "_1d")


@query("fraud_minmax_1d", O.with_ctes(O.BIG_CTE, f"""
SELECT min(amount) AS min_fraud_amount_1d, max(amount) AS max_fraud_amount_1d,
       {O.w1d()} AS window_start, {O.w1d()} + INTERVAL '1 day' AS window_end
FROM fraud_big GROUP BY ALL"""))
def q_fraud_minmax_1d(spark, sf):
    return W.fraud_minmax(fx.fraud_big(spark, sf), "1 day", "_1d")


@query("fraud_rate_1d", O.with_ctes(O.BIG_CTE, f"""
SELECT {O.w1d()} AS window_start, {O.w1d()} + INTERVAL '1 day' AS window_end,
       CAST(count(*) AS BIGINT) AS total_tx_1d,
       CAST(count(*) FILTER (WHERE is_fraud) AS BIGINT) AS fraud_tx_1d,
       round(count(*) FILTER (WHERE is_fraud) / count(*), 6) AS fraud_rate_1d
FROM txn_big GROUP BY ALL"""))
def q_fraud_rate_1d(spark, sf):
    return W.fraud_rate(fx.txn_big(spark, sf), F.col("is_fraud"), "1 day", "_1d")


@query("suspicious_receivers", O.with_ctes(O.BIG_CTE, f"""
SELECT receiver_account, CAST(count(DISTINCT sender_account) AS BIGINT) AS distinct_senders_1d,
       {O.w1d()} AS window_start, {O.w1d()} + INTERVAL '1 day' AS window_end
FROM fraud_big GROUP BY ALL HAVING count(DISTINCT sender_account) >= 2"""))
def q_suspicious_receivers(spark, sf):
    return W.suspicious_receivers(fx.fraud_big(spark, sf), "1 day", threshold=2,
                                  exact=True, suffix="_1d")


@query("suspicious_receivers_approx")
def q_suspicious_receivers_approx(spark, sf):
    """Q4 as written: HyperLogLog distinct count (rows-only check)."""
    return W.suspicious_receivers(fx.fraud_big(spark, sf), "1 day", threshold=2,
                                  exact=False, suffix="_1d")


# ---------------------------------------------------------------------------
# Q6 merged, Q5 alerts, Q7 KPIs (serving layer)
# ---------------------------------------------------------------------------

_SUMMARY_2M_SQL = f"""
tot AS (
  SELECT transaction_type, CAST(count(*) AS BIGINT) AS total_tx_2m,
         round(sum(amount), 2) AS total_amount_2m, {O.avg_money()} AS avg_amount_2m,
         {O.w2m()} AS window_start, {O.w2m()} + INTERVAL '2 minutes' AS window_end
  FROM txn GROUP BY ALL),
fr AS (
  SELECT transaction_type, count(*) AS fraud_tx_2m,
         {O.w2m()} AS window_start, {O.w2m()} + INTERVAL '2 minutes' AS window_end
  FROM fraud_txn GROUP BY ALL),
summary AS (
  SELECT t.*, CAST(coalesce(f.fraud_tx_2m, 0) AS BIGINT) AS fraud_tx_2m,
         round(CASE WHEN t.total_tx_2m > 0 THEN coalesce(f.fraud_tx_2m, 0) / t.total_tx_2m
                    ELSE 0.0 END, 6) AS fraud_rate_2m
  FROM tot t LEFT JOIN fr f USING (window_start, window_end, transaction_type))"""


def _summary_2m(spark, sf, fraud=None):
    from ..operators.serving import merge_summary
    fraud = fx.fraud_txn(spark, sf) if fraud is None else fraud
    return merge_summary(W.summary_total_by_type(fx.txn(spark, sf)),
                         W.summary_fraud_by_type(fraud))


@query("summary_by_type_2m", O.with_ctes(O.ROUTED_CTE + "," + _SUMMARY_2M_SQL,
                                         "SELECT * FROM summary"))
def q_summary_by_type_2m(spark, sf):
    return _summary_2m(spark, sf)


@query("summary_by_type_1d", O.with_ctes(O.BIG_CTE + "," + f"""
tot AS (
  SELECT transaction_type, CAST(count(*) AS BIGINT) AS total_tx_1d,
         round(sum(amount), 2) AS total_amount_1d, {O.avg_money()} AS avg_amount_1d,
         {O.w1d()} AS window_start, {O.w1d()} + INTERVAL '1 day' AS window_end
  FROM txn_big GROUP BY ALL),
fr AS (
  SELECT transaction_type, count(*) AS fraud_tx_1d,
         {O.w1d()} AS window_start, {O.w1d()} + INTERVAL '1 day' AS window_end
  FROM fraud_big GROUP BY ALL)""", """
SELECT t.*, CAST(coalesce(f.fraud_tx_1d, 0) AS BIGINT) AS fraud_tx_1d,
       round(CASE WHEN t.total_tx_1d > 0 THEN coalesce(f.fraud_tx_1d, 0) / t.total_tx_1d
                  ELSE 0.0 END, 6) AS fraud_rate_1d
FROM tot t LEFT JOIN fr f USING (window_start, window_end, transaction_type)"""))
def q_summary_by_type_1d(spark, sf):
    from ..operators.serving import merge_summary
    return merge_summary(W.summary_total_by_type(fx.txn_big(spark, sf), "1 day", "_1d"),
                         W.summary_fraud_by_type(fx.fraud_big(spark, sf), "1 day", "_1d"),
                         suffix="_1d")


@query("fraud_alerts", O.with_ctes(O.ROUTED_CTE, """
SELECT transaction_id, timestamp, sender_account, receiver_account, amount,
       transaction_type, merchant_category, payment_channel, fraud_source
FROM fraud_txn"""))
def q_fraud_alerts(spark, sf):
    from ..operators.alerts import fraud_alerts
    return fraud_alerts(fx.fraud_txn(spark, sf))


_ALERTS_FILTERED_CTE = O.ROUTED_CTE + """,
alerts AS (
  SELECT transaction_id, timestamp, sender_account, receiver_account, amount,
         transaction_type, merchant_category, payment_channel, fraud_source
  FROM fraud_txn),
filtered AS (SELECT (coalesce(amount, 0) >= 1000.0) AS HIGH_AMOUNT, * FROM alerts)"""


@query("alerts_filtered_topn", O.with_ctes(_ALERTS_FILTERED_CTE, """
SELECT * FROM filtered
ORDER BY HIGH_AMOUNT DESC, amount DESC NULLS LAST, transaction_id LIMIT 500"""))
def q_alerts_filtered_topn(spark, sf):
    from ..operators.alerts import fraud_alerts
    from ..operators.serving import alerts_view, filter_alerts
    return alerts_view(filter_alerts(fraud_alerts(fx.fraud_txn(spark, sf))))


@query("alerts_filtered_counts", O.with_ctes(_ALERTS_FILTERED_CTE, """
SELECT CAST(count(*) AS BIGINT) AS filtered_alerts,
       CAST(count(*) FILTER (WHERE HIGH_AMOUNT) AS BIGINT) AS high_amount_alerts
FROM filtered"""))
def q_alerts_filtered_counts(spark, sf):
    from ..operators.alerts import fraud_alerts
    from ..operators.serving import alert_counts, filter_alerts
    return alert_counts(filter_alerts(fraud_alerts(fx.fraud_txn(spark, sf))))


@query("alerts_many_facets", O.with_ctes(O.ROUTED_CTE, """
SELECT CAST(count(*) AS BIGINT) AS filtered_alerts,
       CAST(count(*) FILTER (WHERE amount >= 1000.0) AS BIGINT) AS high_amount_alerts
FROM fraud_txn"""))
def q_alerts_many_facets(spark, sf):
    """FLT6: with no list chosen, alerts of any number of categories are kept."""
    from ..operators.alerts import fraud_alerts
    from ..operators.serving import alert_counts, filter_alerts
    alerts = fraud_alerts(fx.fraud_txn(spark, sf)).withColumn("merchant_category", F.col("receiver_account"))
    return alert_counts(filter_alerts(alerts))


@query("alerts_first_facets", O.with_ctes(O.ROUTED_CTE, """
SELECT (coalesce(amount, 0) >= 1000.0) AS HIGH_AMOUNT, transaction_id, timestamp, sender_account,
       receiver_account, amount, transaction_type, merchant_category, payment_channel, fraud_source
FROM fraud_txn
WHERE transaction_type IN (SELECT DISTINCT transaction_type FROM fraud_txn ORDER BY 1 LIMIT 3)
  AND merchant_category IN (SELECT DISTINCT merchant_category FROM fraud_txn ORDER BY 1 LIMIT 2)"""))
def q_alerts_first_facets(spark, sf):
    """LIM1 + FLT6: a dashboard's preselection, the first sorted values, as explicit lists."""
    from ..operators.alerts import fraud_alerts
    from ..operators.serving import filter_alerts, first_facets, select_present
    from ..schema import ALERT_COLUMNS
    alerts = fraud_alerts(fx.fraud_txn(spark, sf))
    out = filter_alerts(alerts, types=first_facets(alerts, "transaction_type", 3),
                        categories=first_facets(alerts, "merchant_category", 2))
    return select_present(out, ["HIGH_AMOUNT", *ALERT_COLUMNS])


@query("raw_alerts_last300", O.with_ctes(O.ROUTED_CTE, """
SELECT transaction_id, timestamp, sender_account, receiver_account, amount, transaction_type, merchant_category,
       payment_channel, fraud_source
FROM fraud_txn ORDER BY timestamp DESC, transaction_id DESC LIMIT 300"""))
def q_raw_alerts_last300(spark, sf):
    """LIM2 + PRJ7: the last alerts by arrival, unfiltered."""
    from ..operators.serving import raw_alerts_view
    return raw_alerts_view(fx.fraud_txn(spark, sf), 300, ["timestamp", "transaction_id"])


@query("summary_view_types", O.with_ctes(O.ROUTED_CTE + "," + _SUMMARY_2M_SQL, """
SELECT window_start, window_end, transaction_type, total_tx_2m, total_amount_2m, avg_amount_2m,
       fraud_tx_2m, fraud_rate_2m
FROM summary WHERE transaction_type IN ('purchase', 'error') AND trim(transaction_type) <> ''"""))
def q_summary_view_types(spark, sf):
    """FLT6 on Q6: the activity summary of chosen transaction types."""
    from ..operators.serving import select_present, summary_view
    return select_present(summary_view(_summary_2m(spark, sf), ["purchase", "error"]), [
        "window_start", "window_end", "transaction_type", "total_tx_2m", "total_amount_2m", "avg_amount_2m",
        "fraud_tx_2m", "fraud_rate_2m"])


@query("alerts_explicit_filter", O.with_ctes(O.ROUTED_CTE, """
SELECT (coalesce(amount, 0) >= 500.0) AS HIGH_AMOUNT, transaction_id, timestamp,
       sender_account, receiver_account, amount, transaction_type, merchant_category,
       payment_channel, fraud_source
FROM fraud_txn
WHERE transaction_type IN ('purchase', 'error') AND payment_channel IN ('online', 'card')
  AND amount BETWEEN 100.0 AND 3000.0
ORDER BY HIGH_AMOUNT DESC, amount DESC, transaction_id LIMIT 200"""))
def q_alerts_explicit_filter(spark, sf):
    """FLT6 with explicit lists (empty list = no filter), FLT7 with a range."""
    from ..operators.alerts import fraud_alerts
    from ..operators.serving import alerts_view, filter_alerts
    f = filter_alerts(fraud_alerts(fx.fraud_txn(spark, sf)), types=["purchase", "error"],
                      categories=[], channels=["online", "card"],
                      amount_range=(100.0, 3000.0), threshold=500.0)
    return alerts_view(f, limit=200)


@query("facet_values", O.with_ctes(O.ROUTED_CTE, """
SELECT 'transaction_type' AS facet, transaction_type AS value FROM fraud_txn
  WHERE trim(transaction_type) <> '' GROUP BY ALL
UNION ALL
SELECT 'merchant_category', merchant_category FROM fraud_txn
  WHERE trim(merchant_category) <> '' GROUP BY ALL
UNION ALL
SELECT 'payment_channel', payment_channel FROM fraud_txn
  WHERE trim(payment_channel) <> '' GROUP BY ALL"""))
def q_facet_values(spark, sf):
    from ..operators.serving import facet_values
    a = fx.fraud_txn(spark, sf)
    parts = [facet_values(a, c).select(F.lit(c).alias("facet"), F.col(c).alias("value"))
             for c in ("transaction_type", "merchant_category", "payment_channel")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("amount_bounds", O.with_ctes(O.ROUTED_CTE, """
SELECT coalesce(min(amount), 0.0) AS min_amount, coalesce(max(amount), 0.0) AS max_amount
FROM fraud_txn"""))
def q_amount_bounds(spark, sf):
    from ..operators.serving import amount_bounds
    return amount_bounds(fx.fraud_txn(spark, sf))


@query("worst_type_latest", O.with_ctes(O.ROUTED_CTE + "," + _SUMMARY_2M_SQL, """
SELECT window_end, transaction_type, fraud_rate_2m FROM summary
WHERE window_end = (SELECT max(window_end) FROM summary)
ORDER BY fraud_rate_2m DESC, transaction_type LIMIT 1"""))
def q_worst_type_latest(spark, sf):
    from ..operators.serving import worst_type_latest
    return worst_type_latest(_summary_2m(spark, sf))


@query("kpi_latest", O.with_ctes(O.ROUTED_CTE + "," + _SUMMARY_2M_SQL + f""",
loss AS (
  SELECT CAST(count(*) AS BIGINT) AS fraud_count_2m, round(sum(amount), 2) AS fraud_loss_2m,
         {O.w2m()} AS window_start
  FROM fraud_txn GROUP BY ALL),
last AS (SELECT * FROM loss ORDER BY window_start DESC LIMIT 1),
worst AS (SELECT transaction_type, fraud_rate_2m FROM summary
          WHERE window_end = (SELECT max(window_end) FROM summary)
          ORDER BY fraud_rate_2m DESC, transaction_type LIMIT 1)""", """
SELECT (SELECT CAST(count(DISTINCT transaction_id) AS BIGINT) FROM fraud_txn) AS alerts_count,
       coalesce((SELECT fraud_count_2m FROM last), 0) AS last_fraud_count,
       coalesce((SELECT fraud_loss_2m FROM last), 0.0) AS last_fraud_loss,
       coalesce((SELECT transaction_type FROM worst), 'N/A') AS worst_type,
       coalesce((SELECT fraud_rate_2m FROM worst), 0.0) AS worst_rate"""))
def q_kpi_latest(spark, sf):
    from ..operators.alerts import fraud_alerts
    from ..operators.serving import dedupe_keep_last, kpis
    fraud = fx.fraud_txn(spark, sf)
    alerts = dedupe_keep_last(fraud_alerts(fraud), ["transaction_id"], ["timestamp"])
    return kpis(alerts, W.fraud_loss(fraud), _summary_2m(spark, sf, fraud))


# ---------------------------------------------------------------------------
# Profiling (AG1-AG8) on txn; sender operators (AG9-AG11, JN1-JN2) on txn_big
# ---------------------------------------------------------------------------

from ..schema import (HIGH_CARDINALITY, PROFILE_CATEGORICAL,  # noqa: E402
                      TRANSACTION_COLUMNS, TRANSACTION_SCHEMA)

_NUMERIC = ["amount", "time_since_last_transaction", "spending_deviation_score",
            "velocity_score", "geo_anomaly_score"]


def _unpivot_sql(src: str, cols: list[str], cast: str, name: str = "value") -> str:
    sel = ", ".join(f"CAST({c} AS {cast}) AS {c}" for c in cols)
    return (f"(UNPIVOT (SELECT {sel} FROM {src}) ON {', '.join(cols)} "
            f"INTO NAME column_name VALUE {name})")


def _txn(spark, sf):
    return fx.txn(spark, sf).select(*TRANSACTION_COLUMNS)


@query("value_counts_top10", O.with_ctes(O.TXN_CTE, f"""
SELECT column_name, value, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT column_name, value, count(*) AS count,
         row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) AS rank
  FROM {_unpivot_sql('txn', PROFILE_CATEGORICAL, 'VARCHAR')}
  GROUP BY column_name, value) WHERE rank <= 10"""))
def q_value_counts_top10(spark, sf):
    from ..operators.profile import value_counts_top
    return value_counts_top(_txn(spark, sf), PROFILE_CATEGORICAL, 10)


@query("distinct_counts", O.with_ctes(O.TXN_CTE, f"""
SELECT column_name, count(DISTINCT value) AS n_distinct
FROM {_unpivot_sql('txn', HIGH_CARDINALITY, 'VARCHAR')} GROUP BY column_name"""))
def q_distinct_counts(spark, sf):
    from ..operators.profile import distinct_counts
    return distinct_counts(_txn(spark, sf), HIGH_CARDINALITY)


@query("null_counts", O.with_ctes(O.TXN_CTE, """
UNPIVOT (SELECT {} FROM txn) ON COLUMNS(*) INTO NAME column_name VALUE null_count""".format(
    ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in TRANSACTION_COLUMNS))))
def q_null_counts(spark, sf):
    from ..operators.profile import null_counts
    return null_counts(_txn(spark, sf))


_SPARK_TYPE = {"StringType": "string", "DoubleType": "double", "IntegerType": "int",
               "BooleanType": "boolean"}


@query("table_profile", O.with_ctes(O.TXN_CTE, """
SELECT c.column_name, c.non_null_count, t.dtype
FROM (UNPIVOT (SELECT {} FROM txn) ON COLUMNS(*) INTO NAME column_name VALUE non_null_count) c
JOIN (VALUES {}) t(column_name, dtype) USING (column_name)""".format(
    ", ".join(f"count({c}) AS {c}" for c in TRANSACTION_COLUMNS),
    ", ".join(f"('{f.name}', '{_SPARK_TYPE[type(f.dataType).__name__]}')"
              for f in TRANSACTION_SCHEMA.fields))))
def q_table_profile(spark, sf):
    from ..operators.profile import table_profile
    return table_profile(_txn(spark, sf))


def _summary_sql(src: str, cols: list[str]) -> str:
    return f"""
SELECT column_name, CAST(count(value) AS BIGINT) AS count, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
FROM {_unpivot_sql(src, cols, 'DOUBLE')} GROUP BY column_name"""


@query("numeric_summary", O.with_ctes(O.TXN_CTE, _summary_sql("txn", _NUMERIC)))
def q_numeric_summary(spark, sf):
    from ..operators.profile import numeric_summary
    return numeric_summary(_txn(spark, sf), _NUMERIC)


@query("class_balance", O.with_ctes(O.TXN_CTE, """
SELECT is_fraud, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM txn WHERE is_fraud IS NOT NULL GROUP BY is_fraud"""))
def q_class_balance(spark, sf):
    from ..operators.profile import class_balance
    return class_balance(_txn(spark, sf))


@query("overall_counts", O.with_ctes(O.BIG_CTE, """
SELECT count(*) AS total_tx, CAST(count_if(is_fraud) AS BIGINT) AS fraud_tx,
       count(DISTINCT CASE WHEN is_fraud THEN sender_account END) AS distinct_bad_senders
FROM txn_big"""))
def q_overall_counts(spark, sf):
    from ..operators.profile import overall_counts
    return overall_counts(fx.txn_big(spark, sf))


@query("fraud_per_sender", O.with_ctes(O.BIG_CTE, """
SELECT sender_account, count(*) AS fraud_tx_count
FROM fraud_big WHERE sender_account IS NOT NULL GROUP BY sender_account"""))
def q_fraud_per_sender(spark, sf):
    from ..operators.senders import fraud_per_sender
    return fraud_per_sender(fx.txn_big(spark, sf))


@query("fraud_per_sender_summary", O.with_ctes(O.BIG_CTE + """,
fps AS (SELECT sender_account, count(*) AS fraud_tx_count
        FROM fraud_big WHERE sender_account IS NOT NULL GROUP BY sender_account)""",
    _summary_sql("fps", ["fraud_tx_count"])))
def q_fraud_per_sender_summary(spark, sf):
    from ..operators.profile import numeric_summary
    from ..operators.senders import fraud_per_sender
    return numeric_summary(fraud_per_sender(fx.txn_big(spark, sf)), ["fraud_tx_count"])


@query("bad_sender_all_tx", O.with_ctes(O.BIG_CTE, """
SELECT * FROM txn_big
WHERE sender_account IN (SELECT sender_account FROM fraud_big WHERE sender_account IS NOT NULL)"""))
def q_bad_sender_all_tx(spark, sf):
    from ..operators.senders import bad_senders, transactions_of
    t = fx.txn_big(spark, sf)
    return transactions_of(t, bad_senders(t))


@query("per_sender_pivot", O.with_ctes(O.BIG_CTE, """
SELECT sender_account, CAST(count_if(NOT is_fraud) AS BIGINT) AS nonfraud_tx_count,
       CAST(count_if(is_fraud) AS BIGINT) AS fraud_tx_count,
       CAST(count_if(NOT is_fraud) + count_if(is_fraud) AS BIGINT) AS total_tx,
       round(count_if(is_fraud) / (count_if(NOT is_fraud) + count_if(is_fraud)), 6) AS fraud_rate
FROM txn_big
WHERE sender_account IN (SELECT sender_account FROM fraud_big WHERE sender_account IS NOT NULL)
GROUP BY sender_account"""))
def q_per_sender_pivot(spark, sf):
    from ..operators.senders import per_sender_counts
    return per_sender_counts(fx.txn_big(spark, sf))


@query("clean_senders", O.with_ctes(O.BIG_CTE, """
SELECT DISTINCT sender_account FROM txn_big WHERE is_fraud = false AND sender_account IS NOT NULL
EXCEPT
SELECT sender_account FROM fraud_big"""))
def q_clean_senders(spark, sf):
    from ..operators.senders import clean_senders
    return clean_senders(fx.txn_big(spark, sf))


@query("clean_senders_anti", ORACLE["clean_senders"])
def q_clean_senders_anti(spark, sf):
    """JN1 as the original wrote it: distinct non-fraud senders LEFT ANTI bad senders."""
    from ..operators.senders import bad_senders, without
    t = fx.txn_big(spark, sf)
    nonfraud = t.where(~F.col("is_fraud") & F.col("sender_account").isNotNull()) \
                .select("sender_account").distinct()
    return without(nonfraud, bad_senders(t))


# ---------------------------------------------------------------------------
# Bloom filter (AG17, JN3, ML13) on txn_big
# ---------------------------------------------------------------------------

def _bloom_big(spark, sf):
    from ..operators import bloom
    from ..operators.senders import bad_senders
    t = fx.txn_big(spark, sf)
    bad = bad_senders(t)
    # built from the fraud rows directly: repeats collapse in the build aggregate
    return t, bad, bloom.build(t.where(F.col("is_fraud")), "sender_account")


@query("bloom_false_negatives", O.with_ctes(O.BIG_CTE, """
SELECT count(DISTINCT sender_account) AS bad_senders, CAST(0 AS BIGINT) AS false_negatives
FROM fraud_big WHERE sender_account IS NOT NULL"""))
def q_bloom_false_negatives(spark, sf):
    """Every inserted key must hit: false_negatives is 0 by construction."""
    _, bad, bf = _bloom_big(spark, sf)
    return bf.might_contain(bad, "sender_account").agg(
        F.count(F.lit(1)).alias("bad_senders"),
        F.count_if(~F.col("bf_hit")).alias("false_negatives"))


@query("bloom_report", O.with_ctes(O.BIG_CTE, """
SELECT CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS bad_senders, CAST(0 AS BIGINT) AS false_negatives,
       CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) AS clean_senders, true AS fp_rate_within_bound,
       true AS some_pass
FROM (SELECT sender_account, bool_or(is_fraud) AS bad FROM txn_big
      WHERE sender_account IS NOT NULL GROUP BY sender_account)"""))
def q_bloom_report(spark, sf):
    """AG17, JN3, UDF1, ML13: no bad sender is missed and at most 2 % of the clean ones
    are hit; a filter that passes everything or nothing fails this row."""
    from ..operators.bloom import quality_report
    t, _, bf = _bloom_big(spark, sf)
    return quality_report(bf, t).select(
        "bad_senders", "false_negatives", "clean_senders", (F.col("fp_rate") <= 0.02).alias("fp_rate_within_bound"),
        (F.col("tx_flagged") < F.col("total_tx")).alias("some_pass"))


@query("bloom_rest", O.with_ctes(O.BIG_CTE, """
SELECT CAST(count(*) AS BIGINT) AS clean_rows, CAST(0 AS BIGINT) AS bad_rows_passed, true AS most_pass
FROM txn_big WHERE sender_account NOT IN (SELECT sender_account FROM fraud_big)"""))
def q_bloom_rest(spark, sf):
    """FLT4: what passes the filter are rows of clean senders, nearly all of them."""
    from ..operators.bloom import build
    t = fx.txn_big(spark, sf)
    bf = build(t.where(F.col("is_fraud")), "sender_account")
    bad = t.where("is_fraud").groupBy("sender_account").agg(F.lit(True).alias("bad"))
    tagged = bf.might_contain(t.select("sender_account"), "sender_account").join(bad, "sender_account", "left")
    clean, passed = F.col("bad").isNull(), ~F.col("bf_hit")
    return tagged.agg(F.count_if(clean).alias("clean_rows"), F.count_if(passed & ~clean).alias("bad_rows_passed"),
                      (F.count_if(passed) >= 0.9 * F.count_if(clean)).alias("most_pass"))


@query("bloom_quality")
def q_bloom_quality(spark, sf):
    """ML13 report; false positives are random (rows-only check, FP rate
    bounded in tests)."""
    from ..operators.bloom import quality_report
    t, _, bf = _bloom_big(spark, sf)
    return quality_report(bf, t)


@query("bloom_routed", O.with_ctes(O.BIG_CTE, """
SELECT t.* FROM txn_big t
WHERE t.sender_account IN (SELECT sender_account FROM fraud_big)"""))
def q_bloom_routed(spark, sf):
    """FLT4 + JN3: Bloom hits of txn_big minus the filter's false positives.

    Hits are a superset of the bad senders' rows; removing the false
    positives with an exact semi join must give exactly JN2's rows (checked
    against SQL).  Streams use the hit flag alone.
    """
    from ..operators.senders import transactions_of
    t, bad, bf = _bloom_big(spark, sf)
    hits = bf.might_contain(t, "sender_account").where(F.col("bf_hit")).drop("bf_hit")
    return transactions_of(hits, bad)


# ---------------------------------------------------------------------------
# Features, string index, sampling, metrics (ML1-ML14)
# ---------------------------------------------------------------------------

_FEAT_SQL = """
SELECT transaction_id, event_time,
       CAST(hour(event_time) AS INTEGER) AS hour_of_day,
       CASE WHEN hour(event_time) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night,
       CASE WHEN dayofweek(event_time) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN payment_channel = 'online' THEN 1 ELSE 0 END AS is_online_channel,
       CASE WHEN merchant_category IN ('online', 'travel', 'entertainment') THEN 1 ELSE 0 END AS high_risk_merchant,
       CASE WHEN amount > 1000.0 THEN 1 ELSE 0 END AS is_large_amount,
       CASE WHEN sender_account = receiver_account THEN 1 ELSE 0 END AS sender_equals_receiver
FROM txn"""


@query("features", O.with_ctes(O.TXN_CTE, _FEAT_SQL))
def q_features(spark, sf):
    from ..operators.features import FEATURE_COLUMNS, add_features
    return add_features(_txn(spark, sf)).select("transaction_id", *FEATURE_COLUMNS)


@query("features_cast_variant", O.with_ctes(O.TXN_CTE, """
SELECT transaction_id, coalesce(time_since_last_transaction, 0.0) AS time_since_last_transaction,
       CAST(is_fraud AS INTEGER) AS is_fraud, event_time,
       CAST(hour(event_time) AS INTEGER) AS hour_of_day,
       CAST(hour(event_time) BETWEEN 0 AND 5 AS INTEGER) AS is_night,
       CAST(dayofweek(event_time) IN (0, 6) AS INTEGER) AS is_weekend,
       CAST(payment_channel = 'online' AS INTEGER) AS is_online_channel,
       CAST(merchant_category IN ('online', 'travel', 'entertainment') AS INTEGER) AS high_risk_merchant,
       CAST(amount > 1000.0 AS INTEGER) AS is_large_amount,
       CAST(sender_account = receiver_account AS INTEGER) AS sender_equals_receiver
FROM txn WHERE event_time IS NOT NULL AND is_fraud IS NOT NULL"""))
def q_features_cast_variant(spark, sf):
    from ..operators.features import FEATURE_COLUMNS, add_features_cast_variant
    return add_features_cast_variant(_txn(spark, sf)).select(
        "transaction_id", "time_since_last_transaction", "is_fraud", *FEATURE_COLUMNS)


@query("string_index", O.with_ctes(O.TXN_CTE, f"""
SELECT column_name, value AS label, count(*) AS count,
       CAST(row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) - 1 AS DOUBLE)
         AS label_index
FROM {_unpivot_sql('txn', ['transaction_type', 'merchant_category', 'location', 'device_used', 'payment_channel'], 'VARCHAR')}
GROUP BY column_name, value"""))
def q_string_index(spark, sf):
    from ..operators.features import string_index_table
    from ..schema import CATEGORICAL_COLS
    return string_index_table(_txn(spark, sf), CATEGORICAL_COLS)


def _unit_hash_sql(seed: int, id_col: str = "transaction_id") -> str:
    return (f"CAST(('0x' || substr(md5('{seed}:' || {id_col}), 1, 8)) AS BIGINT)"
            f" / 4294967296.0")


@query("sample_hash", O.with_ctes(O.BIG_CTE, f"""
SELECT * FROM txn_big
WHERE (is_fraud AND {_unit_hash_sql(42)} < 1.0) OR (NOT is_fraud AND {_unit_hash_sql(42)} < 0.2)"""))
def q_sample_hash(spark, sf):
    from .model import hash_sample
    return hash_sample(fx.txn_big(spark, sf))


@query("split_hash", O.with_ctes(O.BIG_CTE, f"""
SELECT *, CASE WHEN {_unit_hash_sql(43)} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM txn_big"""))
def q_split_hash(spark, sf):
    from .model import hash_split
    return hash_split(fx.txn_big(spark, sf))


@query("sample_by")
def q_sample_by(spark, sf):
    """ML1 with Spark's stratified sampler (rows-only check)."""
    from .model import stratified_sample
    return stratified_sample(fx.txn_big(spark, sf))


@query("random_split")
def q_random_split(spark, sf):
    """ML2 with Spark's random split, tagged (rows-only check: all rows)."""
    from .model import random_split
    tr, te = random_split(fx.txn_big(spark, sf))
    return (tr.withColumn("split", F.lit("train"))
              .unionByName(te.withColumn("split", F.lit("test"))))


_RULE_SCORE_SQL = """
scored AS (
  SELECT CAST(is_fraud AS INTEGER) AS is_fraud,
         round(0.4 * (CASE WHEN amount > 1000.0 THEN 1 ELSE 0 END)
             + 0.3 * (CASE WHEN merchant_category IN ('online', 'travel', 'entertainment') THEN 1 ELSE 0 END)
             + 0.2 * (CASE WHEN hour(event_time) BETWEEN 0 AND 5 THEN 1 ELSE 0 END)
             + 0.1 * (CASE WHEN payment_channel = 'online' THEN 1 ELSE 0 END), 2) AS fraud_probability
  FROM txn),
th AS (SELECT unnest([{}]) AS threshold),
cm AS (
  SELECT threshold,
         CAST(count_if(fraud_probability >= threshold AND is_fraud = 1) AS BIGINT) AS tp,
         CAST(count_if(fraud_probability >= threshold AND is_fraud <> 1) AS BIGINT) AS fp,
         CAST(count_if(fraud_probability < threshold AND is_fraud <> 1) AS BIGINT) AS tn,
         CAST(count_if(fraud_probability < threshold AND is_fraud = 1) AS BIGINT) AS fn
  FROM th, scored WHERE is_fraud IS NOT NULL AND fraud_probability IS NOT NULL
  GROUP BY threshold),
m AS (
  SELECT *, tp + fp + tn + fn AS n,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
         CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
         CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0
  FROM cm),
m2 AS (
  SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1_1,
            CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f1_0,
            CASE WHEN n > 0 THEN (tp + fn) / n ELSE 0.0 END AS w1,
            CASE WHEN n > 0 THEN (tn + fp) / n ELSE 0.0 END AS w0
  FROM m)"""

_SWEEP_SELECT = """
SELECT threshold, tp, fp, tn, fn,
       round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END, 6) AS accuracy,
       round(p1, 6) AS precision, round(r1, 6) AS recall, round(f1_1, 6) AS f1,
       round(w1 * p1 + w0 * p0, 6) AS weighted_precision,
       round(w1 * r1 + w0 * r0, 6) AS weighted_recall,
       round(w1 * f1_1 + w0 * f1_0, 6) AS weighted_f1
FROM m2"""


@query("threshold_sweep", O.with_ctes(
    O.TXN_CTE + "," + _RULE_SCORE_SQL.format("0.05, 0.10, 0.15, 0.20"), _SWEEP_SELECT))
def q_threshold_sweep(spark, sf):
    from .model import rule_score, threshold_sweep
    return threshold_sweep(rule_score(_txn(spark, sf)))


@query("metrics_at_threshold", O.with_ctes(
    O.TXN_CTE + "," + _RULE_SCORE_SQL.format("0.15"), _SWEEP_SELECT))
def q_metrics_at_threshold(spark, sf):
    from .model import metrics_at, rule_score
    return metrics_at(rule_score(_txn(spark, sf)), 0.15)


_TRAINING_SQL = f"""
drawn AS (SELECT *, CASE WHEN {_unit_hash_sql(43)} < 0.8 THEN 'train' ELSE 'test' END AS split FROM txn
          WHERE (is_fraud AND {_unit_hash_sql(42)} < 1.0) OR (NOT is_fraud AND {_unit_hash_sql(42)} < 0.2))"""


@query("training_ids", O.with_ctes(O.TXN_CTE + "," + _TRAINING_SQL, """
SELECT split, transaction_id, CAST(is_fraud AS INTEGER) AS is_fraud FROM drawn"""))
def q_training_ids(spark, sf):
    """ML1 + ML2: the very rows that the model is fitted and tested on."""
    from .model import training_sets
    train, test = (d.select("transaction_id", "is_fraud") for d in training_sets(_txn(spark, sf)))
    return train.select(F.lit("train").alias("split"), "*").unionByName(test.select(F.lit("test").alias("split"), "*"))


# -- the fitted forest (properties in tests) --------------------------------------

_TRAINED: dict = {}


def trained(spark, sf):
    from .model import train_model
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[key] = train_model(_txn(spark, sf))
    return _TRAINED[key]


@query("model_scored")
def q_model_scored(spark, sf):
    from .model import score
    t = trained(spark, sf)
    return score(t.model, t.test).select("transaction_id", "is_fraud", "fraud_probability",
                                         "prediction", "prediction_custom")


@query("model_scored_ids", O.with_ctes(O.TXN_CTE + "," + _TRAINING_SQL, """
SELECT transaction_id, amount IS NOT NULL AS scored, true AS valid FROM drawn WHERE split = 'test'"""))
def q_model_scored_ids(spark, sf):
    """ML9: every test row is scored or reported as unscored; scores are probabilities
    and the decision follows them."""
    from .model import score, unscored
    t = trained(spark, sf)
    p = F.col("fraud_probability")
    valid = p.between(0, 1) & (F.col("prediction_custom") == (p >= 0.15).cast("double"))
    done = score(t.model, t.test).select("transaction_id", F.lit(True).alias("scored"), valid.alias("valid"))
    return done.unionByName(unscored(t.test).select("transaction_id", F.lit(False).alias("scored"), F.lit(True).alias("valid")))


@query("model_metrics")
def q_model_metrics(spark, sf):
    """ML10-ML11: evaluator metrics of the held-out split, one row."""
    from pyspark import StorageLevel
    from .model import evaluator_metrics, score
    t = trained(spark, sf)
    scored = score(t.model, t.test).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = evaluator_metrics(scored)
        return spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} double" for k in found))
    finally:
        scored.unpersist()


@query("ml_not_fraud")
def q_ml_not_fraud(spark, sf):
    """Q8: the whole txn stream scored with the online threshold, model-cleared rows."""
    from ..operators.alerts import ml_not_fraud
    from .model import score
    from ..schema import ONLINE_THRESHOLD
    t = trained(spark, sf)
    return ml_not_fraud(score(t.model, _txn(spark, sf), ONLINE_THRESHOLD))


# ---------------------------------------------------------------------------
# Sources and sinks (SRC1-SRC7, SNK1, SNK3, FN11-FN13, FN19) on txn
# ---------------------------------------------------------------------------

_TXN18 = "SELECT " + ", ".join(TRANSACTION_COLUMNS) + " FROM txn"


@query("json_roundtrip", O.with_ctes(O.TXN_CTE, _TXN18))
def q_json_roundtrip(spark, sf):
    """SNK1 encode -> SRC4 decode gives the records back."""
    from ..sources.topics import decode, encode
    return decode(encode(_txn(spark, sf)), TRANSACTION_SCHEMA)


@query("csv_roundtrip", O.with_ctes(O.TXN_CTE, _TXN18))
def q_csv_roundtrip(spark, sf):
    """SNK3 sorted CSV write -> SRC1 declared-schema read."""
    from ..session import work_path
    from ..sources.tables import read_transactions, write_sorted
    path = work_path(spark, "csv-roundtrip")
    write_sorted(_txn(spark, sf), path)
    return read_transactions(spark, path)


@query("coerce_fields", O.with_ctes(O.TXN_CTE, _TXN18))
def q_coerce_fields(spark, sf):
    """FN13: all-text rows (null -> '') coerced back to typed records."""
    from ..sources.topics import as_text, coerce_text_record
    return coerce_text_record(as_text(_txn(spark, sf)))


@query("sharded_rows", O.with_ctes(O.TXN_CTE, """
SELECT transaction_id, timestamp,
       CAST((row_number() OVER (ORDER BY timestamp, transaction_id) - 1) % 4 AS INTEGER) AS shard
FROM txn"""))
def q_sharded_rows(spark, sf):
    """SRC7: every row tagged with its producer shard (row i -> i % 4)."""
    from ..operators.ranking import global_row_number
    t = _txn(spark, sf).select("transaction_id", "timestamp")
    ranked = global_row_number(t, ["timestamp", "transaction_id"], out="nth")
    return ranked.select("transaction_id", "timestamp", F.pmod("nth", F.lit(4)).cast("int").alias("shard"))


@query("keyed_order", O.with_ctes(O.TXN_CTE, """
SELECT sender_account AS key, transaction_id,
       row_number() OVER (PARTITION BY sender_account ORDER BY timestamp, transaction_id) - 1 AS key_seq
FROM txn"""))
def q_keyed_order(spark, sf):
    """SRC6: position of each record in its sender's ordered sequence."""
    from ..sources.topics import keyed_handoff
    sent = keyed_handoff(_txn(spark, sf).select("sender_account", "timestamp", "transaction_id"))
    return sent.select("key", F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
                       F.col("seq").cast("bigint").alias("key_seq"))


# ---------------------------------------------------------------------------
# Serving store: WN1, LIM2, SRC5, SET1 on txn_big (ids repeat on purpose)
# ---------------------------------------------------------------------------

_BIG_DESC = "event_time DESC, transaction_id DESC, receiver_account DESC, amount DESC"
_CUTOFF = "1998-01-01 00:00:00"


@query("dedupe_keep_last", O.with_ctes(O.BIG_CTE, f"""
SELECT * FROM txn_big
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {_BIG_DESC}) = 1"""))
def q_dedupe_keep_last(spark, sf):
    from ..operators.serving import dedupe_keep_last
    return dedupe_keep_last(fx.txn_big(spark, sf), ["transaction_id"], fx.BIG_ARRIVAL_ORDER)


@query("bounded_store", O.with_ctes(O.BIG_CTE, f"""
SELECT * FROM (
  SELECT * FROM txn_big
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {_BIG_DESC}) = 1)
ORDER BY {_BIG_DESC} LIMIT 5000"""))
def q_bounded_store(spark, sf):
    """SET1 + WN1 + LIM2: stored ∪ new, keep last per id, retain the last 5,000."""
    from ..operators.serving import bounded_store
    t = fx.txn_big(spark, sf)
    cut = F.col("event_time") < F.lit(_CUTOFF).cast("timestamp_ntz")
    return bounded_store(t.where(cut), t.where(~cut), ["transaction_id"],
                         fx.BIG_ARRIVAL_ORDER, 5000)


@query("incremental_read", O.with_ctes(O.BIG_CTE, f"""
SELECT * FROM txn_big WHERE event_time >= TIMESTAMP '{_CUTOFF}'"""))
def q_incremental_read(spark, sf):
    """SRC5: rows loaded before the cut-off set the cursor; the next refresh
    returns exactly the rows after it."""
    from ..sources.incremental import fetch_new, next_cursor
    t = fx.txn_big(spark, sf)
    keys = fx.BIG_ARRIVAL_ORDER
    seen = t.where(F.col("event_time") < F.lit(_CUTOFF).cast("timestamp_ntz"))
    cursor = next_cursor(seen, keys)
    return fetch_new(t, keys, cursor)


@query("union_append", O.with_ctes(O.BIG_CTE, f"""
SELECT transaction_id, amount, sender_account FROM txn_big WHERE event_time < TIMESTAMP '{_CUTOFF}'
UNION ALL BY NAME
SELECT transaction_id, amount, receiver_account, timestamp FROM txn_big
WHERE event_time >= TIMESTAMP '{_CUTOFF}'"""))
def q_union_append(spark, sf):
    from ..operators.serving import union_append
    t = fx.txn_big(spark, sf)
    cut = F.col("event_time") < F.lit(_CUTOFF).cast("timestamp_ntz")
    return union_append(t.where(cut).select("transaction_id", "amount", "sender_account"),
                        t.where(~cut).select("transaction_id", "amount", "receiver_account",
                                             "timestamp"))


# ---------------------------------------------------------------------------
# Streams (ST1-ST11): replay txn_routed as a file topic, run the insight
# queries to completion, read their sink tables back.  Append mode emits
# closed windows only: window_end <= max(event_time) - 2 minutes.
# ---------------------------------------------------------------------------

def replay(df: DataFrame, path: str, key: str = "transaction_id", order: list | None = None) -> None:
    """Write a table as a file topic (one append), in event-time order if no other is given."""
    from ..sources.topics import encode
    encode(df.orderBy(*(order or ["event_time", key])), key).write.mode("append").json(path)


def _stream_insight(spark, sf, names: list[str]) -> dict:
    from ..session import work_path
    from ..streaming.pipeline import TopologyPaths, await_all, start_insights
    from ..streaming.sinks import read_table
    paths = TopologyPaths(work_path(spark, "stream-insights"))
    replay(fx.txn_routed(spark, sf), f"{paths.topic('routed_transactions')}/replay")
    qs = start_insights(stream_session(spark), paths, names=names)
    await_all(qs)
    return {n: read_table(spark, paths.table(n)).drop("_batch", "_row") for n in names}


_CLOSED = "(SELECT max(event_time) - INTERVAL '2 minutes' FROM txn_routed)"
# The fraud filter is pushed below the watermark, so fraud-only aggregates
# close on the fraud rows' own event time (as a separate fraud topic would).
_CLOSED_FRAUD = "(SELECT max(event_time) - INTERVAL '2 minutes' FROM fraud_txn)"


@query("stream_fraud_loss_2m", O.with_ctes(O.ROUTED_CTE, f"""
SELECT * FROM ({ORACLE['fraud_loss_2m'].split('fraud_txn AS (SELECT * FROM txn_routed WHERE fraud_source IS NOT NULL)', 1)[1]})
WHERE window_end <= {_CLOSED_FRAUD}"""))
def q_stream_fraud_loss_2m(spark, sf):
    return _stream_insight(spark, sf, ["fraud_loss_2m"])["fraud_loss_2m"]


@query("stream_fraud_rate_2m", O.with_ctes(O.ROUTED_CTE, f"""
SELECT * FROM ({ORACLE['fraud_rate_2m'].split('fraud_txn AS (SELECT * FROM txn_routed WHERE fraud_source IS NOT NULL)', 1)[1]})
WHERE window_end <= {_CLOSED}"""))
def q_stream_fraud_rate_2m(spark, sf):
    return _stream_insight(spark, sf, ["fraud_rate_2m"])["fraud_rate_2m"]


@query("stream_summary_by_type_2m", O.with_ctes(O.ROUTED_CTE, f"""
SELECT * FROM (
  SELECT transaction_type, CAST(count(*) AS BIGINT) AS total_tx_2m,
         round(sum(amount), 2) AS total_amount_2m, {O.avg_money()} AS avg_amount_2m,
         CAST(count(*) FILTER (WHERE fraud_source IS NOT NULL) AS BIGINT) AS fraud_tx_2m,
         round(count(*) FILTER (WHERE fraud_source IS NOT NULL) / count(*), 6) AS fraud_rate_2m,
         {O.w2m()} AS window_start, {O.w2m()} + INTERVAL '2 minutes' AS window_end
  FROM txn_routed GROUP BY ALL)
WHERE window_end <= {_CLOSED}"""))
def q_stream_summary_by_type_2m(spark, sf):
    return _stream_insight(spark, sf, ["summary_by_type_2m"])["summary_by_type_2m"]


@query("stream_alerts", ORACLE["fraud_alerts"])
def q_stream_alerts(spark, sf):
    return _stream_insight(spark, sf, ["fraud_alerts_realtime"])["fraud_alerts_realtime"]


@query("stream_pipeline_routes")
def q_stream_pipeline_routes(spark, sf):
    """ST9: raw stream -> Bloom route -> model -> routed topic; rows per route.

    The filter holds txn's labelled bad senders, the model is the offline
    forest; rows-only check (the property tests pin the routing laws).
    """
    from ..operators import bloom
    from ..operators.senders import bad_senders
    from ..session import work_path
    from ..streaming.pipeline import TopologyPaths, start_routing
    from ..sources.topics import decode
    from .model import quickest
    t = _txn(spark, sf)
    bf = bloom.build(bad_senders(t), "sender_account")
    model = quickest(trained(spark, sf).model, spark)
    paths = TopologyPaths(work_path(spark, "stream-pipeline"))
    replay(t, f"{paths.base}/raw/replay")
    q = start_routing(spark, f"{paths.base}/raw/*", bf, model, paths, max_files=None)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    routed = decode(spark.read.schema("key string, value string")
                     .json(f"{paths.topic('routed_transactions')}/*"))
    return routed.groupBy("fraud_source").agg(F.count(F.lit(1)).alias("rows"))


@query("head_rows", O.with_ctes(O.TXN_CTE, f"""
{_TXN18} ORDER BY timestamp, transaction_id LIMIT 20"""))
def q_head_rows(spark, sf):
    """LIM1: first 20 rows by (timestamp, id) — a keyed head is deterministic."""
    from ..operators.serving import head_n
    return head_n(_txn(spark, sf), 20, ["timestamp", "transaction_id"])


@query("latest_fraud_loss", O.with_ctes(O.ROUTED_CTE, f"""
SELECT * FROM ({ORACLE['fraud_loss_2m'].split('fraud_txn AS (SELECT * FROM txn_routed WHERE fraud_source IS NOT NULL)', 1)[1]})
ORDER BY window_start DESC LIMIT 1"""))
def q_latest_fraud_loss(spark, sf):
    """WN2: the most recent fraud-loss window."""
    from ..operators.serving import latest_row
    return latest_row(W.fraud_loss(fx.fraud_txn(spark, sf)), "window_start")


@query("per_sender_head10", O.with_ctes(O.BIG_CTE, """
SELECT * FROM (
  SELECT sender_account, CAST(count_if(NOT is_fraud) AS BIGINT) AS nonfraud_tx_count,
         CAST(count_if(is_fraud) AS BIGINT) AS fraud_tx_count,
         CAST(count(*) FILTER (WHERE is_fraud IS NOT NULL) AS BIGINT) AS total_tx,
         round(count_if(is_fraud) / count(*) FILTER (WHERE is_fraud IS NOT NULL), 6) AS fraud_rate
  FROM txn_big WHERE sender_account IS NOT NULL GROUP BY sender_account
  HAVING count_if(is_fraud) > 0)
ORDER BY sender_account LIMIT 10"""))
def q_per_sender_head10(spark, sf):
    """LIM1 over AG11: the first 10 bad senders by account (grouped output is key-sorted)."""
    from ..operators.senders import per_sender_counts
    from ..operators.serving import head_n
    return head_n(per_sender_counts(fx.txn_big(spark, sf)), 10, ["sender_account"])


@query("minmax_view_last200", O.with_ctes(O.ROUTED_CTE, f"""
SELECT window_start, window_end, min_fraud_amount_2m, max_fraud_amount_2m FROM (
  {ORACLE['fraud_minmax_2m'].split('fraud_txn AS (SELECT * FROM txn_routed WHERE fraud_source IS NOT NULL)', 1)[1]})
ORDER BY window_start DESC LIMIT 200"""))
def q_minmax_view_last200(spark, sf):
    """SRT2 + LIM2 + PRJ7: the min/max table sorted by window start, last 200 rows."""
    from ..operators.serving import last_n, select_present
    mm = W.fraud_minmax(fx.fraud_txn(spark, sf))
    view = select_present(mm, ["window_start", "window_end", "min_fraud_amount_2m",
                               "max_fraud_amount_2m"])
    return last_n(view, 200, ["window_start"])


@query("summary_view_last2000", O.with_ctes(O.ROUTED_CTE + "," + _SUMMARY_2M_SQL, """
SELECT window_start, window_end, transaction_type, total_tx_2m, total_amount_2m, avg_amount_2m,
       fraud_tx_2m, fraud_rate_2m
FROM summary ORDER BY window_end DESC, transaction_type DESC LIMIT 2000"""))
def q_summary_view_last2000(spark, sf):
    """SRT2 + LIM2: the merged summary sorted by (window_end, type), last 2,000 rows."""
    from ..operators.serving import last_n, select_present
    view = select_present(_summary_2m(spark, sf), [
        "window_start", "window_end", "transaction_type", "total_tx_2m", "total_amount_2m",
        "avg_amount_2m", "fraud_tx_2m", "fraud_rate_2m"])
    return last_n(view, 2000, ["window_end", "transaction_type"])


@query("stream_fraud_minmax_2m", O.with_ctes(O.ROUTED_CTE, f"""
SELECT * FROM ({ORACLE['fraud_minmax_2m'].split('fraud_txn AS (SELECT * FROM txn_routed WHERE fraud_source IS NOT NULL)', 1)[1]})
WHERE window_end <= {_CLOSED_FRAUD}"""))
def q_stream_fraud_minmax_2m(spark, sf):
    """Q3 through the stream: closed windows of the fraud rows."""
    return _stream_insight(spark, sf, ["fraud_minmax_2m"])["fraud_minmax_2m"]


# ---------------------------------------------------------------------------
# Operators whose results SQL can only check, as rows of checks that can fail
# ---------------------------------------------------------------------------

#: rows that a task of a comparison of tables holds
SAME_ROWS = 250_000


def _same_rows(a: DataFrame, b: DataFrame, name: str = "same") -> DataFrame:
    """One row: how many rows ``a`` has, and whether ``b`` has the same ones.

    Nearly every row is a group of its own, so the rows are dealt out before
    they are grouped, to as many tasks as their number asks for.
    """
    sides = a.select(F.struct("*").alias("r"), F.lit(1).alias("d")).unionByName(b.select(F.struct("*").alias("r"), F.lit(-1).alias("d")))
    parts = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * a.count() // SAME_ROWS))
    dealt = sides.select(F.to_json("r").alias("r"), "d").repartition(parts, "r")
    per = dealt.groupBy("r").agg(F.sum("d").alias("d"), F.count_if(F.col("d") > 0).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.bool_and(F.col("d") == 0), F.lit(True)).alias(name))


@query("bloom_reload", O.with_ctes(O.BIG_CTE, """
SELECT CAST(count(*) AS BIGINT) AS rows, true AS same FROM txn_big"""))
def q_bloom_reload(spark, sf):
    """SNK4: a saved filter answers as the one that was built."""
    from ..operators.bloom import BloomFilter
    from ..session import work_path
    t, _, bf = _bloom_big(spark, sf)
    bf.save(path := work_path(spark, "bloom"))
    rows = t.select("transaction_id", "sender_account")
    return _same_rows(bf.might_contain(rows, "sender_account"), BloomFilter.load(spark, path).might_contain(rows, "sender_account"))


@query("model_reload", O.with_ctes(O.TXN_CTE + "," + _TRAINING_SQL, """
SELECT CAST(count(*) AS BIGINT) AS rows, true AS same FROM drawn WHERE split = 'test'"""))
def q_model_reload(spark, sf):
    """SNK5: a saved pipeline scores as the fitted one."""
    from ..session import work_path
    from .model import load_model, save_model, score
    t = trained(spark, sf)
    save_model(t.model, path := work_path(spark, "model"))
    cols = ["transaction_id", "fraud_probability", "prediction_custom"]
    return _same_rows(score(t.model, t.test).select(cols), score(load_model(path), t.test).select(cols))


@query("forest_expression", O.with_ctes(O.TXN_CTE, """
SELECT CAST(count(amount) AS BIGINT) AS scored_rows, true AS same_probability, true AS same_decisions FROM txn"""))
def q_forest_expression(spark, sf):
    """ML7 + ML9: the forest as a Spark expression scores every transaction as the fitted pipeline does."""
    from .forest import CompiledForest
    from .model import compiled, score
    t = _txn(spark, sf)
    model = trained(spark, sf).model
    forest = compiled(model, spark)
    if not isinstance(forest, CompiledForest):
        raise ValueError("the forest is larger than an expression may be")
    cols = ["fraud_probability", "prediction", "prediction_custom", "is_fraud_prediction"]
    a = score(model, t).select("transaction_id", F.struct(*cols).alias("a"))
    b = score(forest, t).select("transaction_id", F.struct(*cols).alias("b"))
    both = a.join(b, "transaction_id", "full")
    near = F.abs(F.col("a.fraud_probability") - F.col("b.fraud_probability")) < 1e-9
    same = (F.col("a.prediction") == F.col("b.prediction")) & (F.col("a.is_fraud_prediction") == F.col("b.is_fraud_prediction")) & (
        (F.col("a.prediction_custom") == F.col("b.prediction_custom")) | (F.abs(F.col("a.fraud_probability") - 0.15) < 1e-9))
    miss = F.lit(False)
    return both.agg(F.count("*").alias("scored_rows"), F.bool_and(F.coalesce(near, miss)).alias("same_probability"),
                    F.bool_and(F.coalesce(same, miss)).alias("same_decisions"))


@query("inferred_csv", O.with_ctes(O.TXN_CTE, """
SELECT transaction_id, amount, velocity_score, is_fraud, merchant_category, time_since_last_transaction FROM txn"""))
def q_inferred_csv(spark, sf):
    """SRC2: types inferred from a CSV with header."""
    from ..session import work_path
    from ..sources.tables import read_inferred, write_sorted
    write_sorted(_txn(spark, sf), path := work_path(spark, "csv-inferred"))
    return read_inferred(spark, path).select("transaction_id", "amount", "velocity_score", "is_fraud", "merchant_category",
                                             "time_since_last_transaction")


@query("imputed_median", O.with_ctes(O.TXN_CTE + "," + _TRAINING_SQL, """
SELECT CAST(count(*) FILTER (WHERE time_since_last_transaction IS NULL) AS BIGINT) AS imputed_rows,
       round(quantile_cont(time_since_last_transaction, 0.5), 6) AS median FROM drawn WHERE split = 'train'"""))
def q_imputed_median(spark, sf):
    """ML4: the fitted pipeline's own stage fills gaps with the exact training median."""
    from .imputer import MedianImputerModel
    t = trained(spark, sf)
    stage = next(s for s in t.model.stages if isinstance(s, MedianImputerModel))
    rows = t.train.select("time_since_last_transaction")
    gaps = stage.transform(rows.where(F.col("time_since_last_transaction").isNull()))
    filled = gaps.agg(F.count("time_since_last_transaction").alias("imputed_rows"), F.max("time_since_last_transaction").alias("filled"))
    return filled.select("imputed_rows", F.round(F.coalesce("filled", F.lit(stage.medians()["time_since_last_transaction"])), 6).alias("median"))


def _within_error(approx: DataFrame, exact: DataFrame, by: str, sd: float) -> DataFrame:
    """One row: how many windows ``exact`` has, and whether ``approx`` has the same ones, each within five
    standard deviations or one sender."""
    keys = ["receiver_account", "window_start", "window_end"]
    both = approx.join(exact, keys, "full")
    a, n = F.col(f"approx_distinct_senders{by}"), F.col(f"distinct_senders{by}")
    ok = F.coalesce(F.abs(a - n) <= F.greatest(F.lit(1.0), 5 * sd * n), F.lit(False))
    return both.agg(F.count(n).alias("windows"), F.bool_and(ok).alias("within_error"))


@query("approx_within_error", O.with_ctes(O.BIG_CTE, f"""
SELECT CAST(count(*) AS BIGINT) AS windows, true AS within_error FROM (
  SELECT DISTINCT {O.w1d()} AS w, receiver_account FROM fraud_big)"""))
def q_approx_within_error(spark, sf):
    """AG16: the approximate list of suspicious receivers against the exact one (deviation 0.05)."""
    big = fx.fraud_big(spark, sf)
    approx, exact = (W.suspicious_receivers(big, "1 day", 1, exact=e, suffix="_1d") for e in (False, True))
    return _within_error(approx, exact, "_1d", 0.05)


@query("sketch_rollup", ORACLE["approx_within_error"])
def q_sketch_rollup(spark, sf):
    """AG16 / Q4: stored two-minute sketches merged to days, against the exact daily counts."""
    from ..operators.sketches import merge_windows, relative_error, sender_sketches, suspicious_from_sketches
    from ..session import work_path
    big = fx.fraud_big(spark, sf)
    path = work_path(spark, "sender-sketches")
    # two loads, as a table that grows: windows of either may share a day
    early = F.col("event_time") < F.lit(_CUTOFF).cast("timestamp_ntz")
    for part in (big.where(early), big.where(~early)):
        sender_sketches(part).write.mode("append").parquet(path)
    days = merge_windows(spark.read.parquet(path), "1 day")
    return _within_error(suspicious_from_sketches(days, 1, "_1d"), W.suspicious_receivers(big, "1 day", 1, exact=True, suffix="_1d"),
                         "_1d", relative_error())


_AUC_SQL = """
counted AS (SELECT s AS threshold, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg
            FROM labelled WHERE s IS NOT NULL AND y IS NOT NULL GROUP BY s),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
          FROM counted WINDOW w AS (ORDER BY threshold DESC)),
points AS (SELECT *, tp / (tp + fp) AS precision, lag(tp / (tp + fp)) OVER (ORDER BY threshold DESC) AS before FROM curve)
SELECT CAST(max(p) AS BIGINT) AS positives, CAST(max(n) AS BIGINT) AS negatives, CAST(count(*) AS BIGINT) AS thresholds,
       round(sum(CAST(neg AS DOUBLE) * (2 * (tp - pos) + pos)) / (2.0 * max(p) * max(n)), 9) AS area_under_roc,
       round(sum(pos * (precision + coalesce(before, precision)) / 2) / max(p), 9) AS area_under_pr
FROM points"""


def _areas(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ("area_under_roc", "area_under_pr")})


@query("auc_rule_score", O.with_ctes(O.TXN_CTE + "," + _RULE_SCORE_SQL.format("0.15") + """,
labelled AS (SELECT fraud_probability AS s, is_fraud = 1 AS y FROM scored),""" + _AUC_SQL.split("SELECT CAST(max", 1)[0].rstrip(), "SELECT CAST(max" + _AUC_SQL.split("SELECT CAST(max", 1)[1]))
def q_auc_rule_score(spark, sf):
    """ML10: exact areas of the rule score, a few values that many rows share."""
    from ..operators.auc import exact_auc
    from .model import rule_score
    return _areas(exact_auc(rule_score(_txn(spark, sf))))


@query("auc_amount", O.with_ctes(O.BIG_CTE + """,
labelled AS (SELECT amount AS s, is_fraud AS y FROM txn_big),""" + _AUC_SQL.split("SELECT CAST(max", 1)[0].rstrip(), "SELECT CAST(max" + _AUC_SQL.split("SELECT CAST(max", 1)[1]))
def q_auc_amount(spark, sf):
    """ML10: exact areas of a score of which nearly every row has its own, far beyond an evaluator's bins."""
    from ..operators.auc import exact_auc
    return _areas(exact_auc(fx.txn_big(spark, sf), score="amount"))


def rule_model():
    """A pipeline model that SQL can check: fraud above a fixed amount, with probabilities 0.9 and 0.1."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer, VectorAssembler
    over = f"amount > {fx.ROUTE_MODEL_AMOUNT}"
    return PipelineModel([
        SQLTransformer(statement=f"SELECT *, if({over}, 0.9D, 0.1D) AS p1, if({over}, 0.1D, 0.9D) AS p0 FROM __THIS__"),
        VectorAssembler(inputCols=["p0", "p1"], outputCol="probability"),
        SQLTransformer(statement="SELECT *, double(p1 >= 0.5) AS prediction FROM __THIS__")])


@query("not_fraud_list", O.with_ctes(O.ROUTED_CTE, """
SELECT transaction_id, sender_account, receiver_account, amount, transaction_type, merchant_category, payment_channel,
       0.1 AS fraud_probability, 0 AS is_fraud_prediction FROM txn_routed WHERE fraud_source IS NULL"""))
def q_not_fraud_list(spark, sf):
    """Q8: what the filter lets pass and the model clears, with the rule in the model's place."""
    from ..operators.alerts import ml_not_fraud
    from .model import score
    from ..schema import ONLINE_THRESHOLD
    passed = fx.txn_routed(spark, sf).where(~F.col("fraud_source").eqNullSafe(F.lit("bloom_filter"))).drop("fraud_source")
    return ml_not_fraud(score(rule_model(), passed, ONLINE_THRESHOLD))


@query("normalised_table", O.with_ctes(O.TXN_CTE, """
SELECT substr(transaction_id, 2) AS _id, event_time AS timestamp, amount FROM txn"""))
def q_normalised_table(spark, sf):
    """FN12 + FN23: ids as text, time columns parsed."""
    from ..operators.serving import normalise_table
    t = _txn(spark, sf)
    return normalise_table(t.select(F.substring("transaction_id", 2, 20).cast("bigint").alias("_id"), "timestamp", "amount"))


@query("stream_routes", O.with_ctes(O.ROUTED_CTE, """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE fraud_source = 'bloom_filter') AS BIGINT) AS member_rows,
       CAST(0 AS BIGINT) AS members_missed, true AS false_hits_within_bound, CAST(0 AS BIGINT) AS wrong_model_routes
FROM txn_routed"""))
def q_stream_routes(spark, sf):
    """ST9, SET2, FLT4, FLT5: the whole router, with a rule in the model's place: every row
    of a member is a hit, few others are, and the rest goes where the rule sends it."""
    from ..operators import bloom
    from ..session import work_path
    from ..sources.topics import decode
    from ..streaming.pipeline import TopologyPaths, start_routing
    member = F.col("fraud_source") == "bloom_filter"
    t = fx.txn_routed(spark, sf)
    paths = TopologyPaths(work_path(spark, "stream-routes"))
    replay(t.select(*TRANSACTION_COLUMNS, "event_time"), f"{paths.base}/raw/replay")
    bf = bloom.build(t.where(member).select("sender_account"), "sender_account")
    q = start_routing(spark, f"{paths.base}/raw/*", bf, rule_model(), paths)
    q.awaitTermination()
    bf.release()
    routed = decode(spark.read.schema("key string, value string").json(f"{paths.topic('routed_transactions')}/*"))
    truth = t.select(F.col("transaction_id").alias("id"), F.col("fraud_source").alias("truth"))
    j = routed.join(truth, F.col("transaction_id") == F.col("id"), "full")
    is_member, hit = F.col("truth").eqNullSafe(F.lit("bloom_filter")), F.col("fraud_source").eqNullSafe(F.lit("bloom_filter"))
    return j.agg(F.count("transaction_id").alias("rows"), F.count_if(is_member).alias("member_rows"),
                 F.count_if(is_member & ~hit).alias("members_missed"),
                 (F.count_if(hit & ~is_member) <= 0.02 * F.count_if(~is_member) + 50).alias("false_hits_within_bound"),
                 F.count_if(~is_member & ~hit & ~F.col("fraud_source").eqNullSafe(F.col("truth"))).alias("wrong_model_routes"))


# more of the catalogue, registered in the same tables
from . import catalog_online  # noqa: E402, F401
