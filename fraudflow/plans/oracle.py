"""Oracle SQL (DuckDB dialect) for the query catalogue.

The tables ``events``, ``orders``, ``lineitem`` ... are views registered by
the checker.  Each statement rebuilds the test views (``txn``, ``txn_big``,
``txn_routed``, ``fraud_txn``) as CTEs and then states the query in plain
SQL, independently of the Spark code.  Column names equal the Spark
results'; counts are BIGINT, money sums rounded to 2 and rates to 6
decimals on both sides.
"""

from __future__ import annotations

TXN_CTE = """
txn AS (
  SELECT 'T' || CAST(event_id AS VARCHAR) AS transaction_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
         'A' || CAST(user_id AS VARCHAR) AS sender_account,
         'A' || CAST((event_id * 7) % 151 AS VARCHAR) AS receiver_account,
         round(value * 10, 2) AS amount,
         event_type AS transaction_type,
         CASE event_id % 6 WHEN 0 THEN 'online' WHEN 1 THEN 'travel'
              WHEN 2 THEN 'entertainment' WHEN 3 THEN 'grocery'
              WHEN 4 THEN 'retail' ELSE 'utilities' END AS merchant_category,
         CASE event_id % 5 WHEN 0 THEN 'Tokyo' WHEN 1 THEN 'London'
              WHEN 2 THEN 'Berlin' WHEN 3 THEN 'Sydney' ELSE 'Toronto' END AS location,
         CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'web'
              WHEN 2 THEN 'atm' ELSE 'pos' END AS device_used,
         (event_type = 'error' AND value > 200) AS is_fraud,
         CASE WHEN event_type = 'error' AND value > 200 THEN 'card_not_present' END AS fraud_type,
         CASE WHEN event_id % 7 = 0 THEN NULL
              ELSE CAST((event_id * 37) % 10000 AS DOUBLE) / 100 END AS time_since_last_transaction,
         CAST((event_id * 13) % 200 AS DOUBLE) / 100 - 1 AS spending_deviation_score,
         CAST(user_id % 20 AS INTEGER) AS velocity_score,
         CAST((event_id * 17) % 100 AS DOUBLE) / 100 AS geo_anomaly_score,
         CASE user_id % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'card' ELSE 'ACH' END AS payment_channel,
         '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS ip_address,
         'D' || CAST(user_id % 97 AS VARCHAR) AS device_hash,
         ts AS event_time
  FROM events)"""

ROUTED_CTE = TXN_CTE + """,
early_bad AS (
  SELECT DISTINCT sender_account FROM txn
  WHERE is_fraud AND event_time < TIMESTAMP '2024-01-16 00:00:00'
    AND sender_account IS NOT NULL),
txn_routed AS (
  SELECT t.*,
         CASE WHEN b.sender_account IS NOT NULL THEN 'bloom_filter'
              WHEN t.amount > 2000 THEN 'ml_model' END AS fraud_source
  FROM txn t LEFT JOIN early_bad b ON t.sender_account = b.sender_account),
fraud_txn AS (SELECT * FROM txn_routed WHERE fraud_source IS NOT NULL)"""

BIG_CTE = """
txn_big AS (
  SELECT 'T' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         strftime(o_orderdate + ((l_orderkey * 7919 + l_linenumber * 613) % 86400) * INTERVAL 1 SECOND,
                  '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
         o_orderdate + ((l_orderkey * 7919 + l_linenumber * 613) % 86400) * INTERVAL 1 SECOND AS event_time,
         'A' || CAST(o_custkey AS VARCHAR) AS sender_account,
         'A' || CAST(l_suppkey AS VARCHAR) AS receiver_account,
         l_extendedprice AS amount,
         o_orderpriority AS transaction_type,
         (l_returnflag = 'R' AND l_discount >= 0.09) AS is_fraud
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
fraud_big AS (SELECT * FROM txn_big WHERE is_fraud)"""


def with_ctes(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body.strip()}"


def w2m(col: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '2 minutes', {col})"


def w1d(col: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '1 day', {col}, TIMESTAMP '1970-01-01')"


def avg_money(col: str = "amount") -> str:
    """Exact half-up average to 6 decimals over integer micro-units."""
    u = f"sum(CAST(round({col} * 1000000) AS BIGINT))"
    n = f"count({col})"
    return (f"CASE WHEN {n} > 0 THEN sign({u}) * ((abs({u}) * 2 + {n}) // (2 * {n}))"
            f" / 1000000.0 END")
