"""The given tables as the raw tables of a payment platform. The same SQL runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRANSACTIONS = """
SELECT concat('t_', CAST(event_id AS STRING)) AS transaction_id, concat('u_', CAST(user_id AS STRING)) AS user_id,
 concat('d_', CAST((user_id * 3 + event_id % 3) % 40 AS STRING)) AS device_id,
 concat('m_', CAST((event_id * 7) % 120 AS STRING)) AS merchant_id,
 CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE value END AS DECIMAL(18,4)) AS amount,
 CASE WHEN event_id % 4 = 0 THEN ' eur' WHEN event_id % 4 = 1 THEN 'GBP ' ELSE 'usd' END AS currency,
 CASE WHEN event_id % 3 = 0 THEN ' Card ' WHEN event_id % 3 = 1 THEN 'WALLET' ELSE 'bank_transfer' END AS payment_method,
 CASE WHEN event_id % 5 = 0 THEN ' gb' ELSE 'us' END AS country_code,
 CASE WHEN event_id % 2 = 0 THEN concat('10.0.0.', CAST(event_id % 250 AS STRING)) END AS ip_address,
 CASE WHEN event_id % 10 = 9 THEN NULL ELSE event_id % 10 = 0 END AS is_international,
 CASE WHEN event_type = 'click' AND event_id % 4 = 0 THEN ' Decline '
      WHEN event_type = 'click' AND event_id % 4 = 1 THEN 'PENDING' ELSE 'success' END AS txn_status,
 CASE WHEN event_type = 'click' AND event_id % 4 = 0 THEN 'limit_exceeded' END AS decline_reason,
 CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(hour(ts) AS INT) END AS local_hour,
 CAST(ts AS TIMESTAMP) AS event_timestamp, CAST(ts AS TIMESTAMP) + INTERVAL '5' MINUTE AS ingestion_timestamp
FROM events WHERE event_type IN ('purchase','click','view')
"""
LOGINS = """
SELECT event_id AS login_event_id, concat('u_', CAST(user_id AS STRING)) AS user_id, CAST(NULL AS STRING) AS device_id,
 CAST(NULL AS STRING) AS ip_address, 'us' AS country_code,
 CASE WHEN event_type = 'error' THEN ' FAILED' ELSE 'success' END AS login_status,
 CASE WHEN event_type = 'error' THEN 'wrong_password' END AS failure_reason,
 CAST(ts AS TIMESTAMP) AS event_timestamp, CAST(ts AS TIMESTAMP) + INTERVAL '5' MINUTE AS ingestion_timestamp
FROM events WHERE event_type IN ('error','signup')
"""
USERS = """
SELECT concat('u_', CAST(c_custkey AS STRING)) AS user_id,
 concat(' User', CAST(c_custkey AS STRING), '@Example.com') AS email, CAST(NULL AS STRING) AS phone, 'us' AS country_code,
 CAST(TIMESTAMP '2023-12-31 00:00:00' - (c_custkey % 700) * INTERVAL '1' DAY AS DATE) AS signup_date,
 CASE WHEN c_mktsegment IN ('HOUSEHOLD','MACHINERY') THEN 'Standard'
      WHEN c_mktsegment = 'BUILDING' THEN 'premium' ELSE 'business' END AS account_type,
 c_acctbal > 0 AS is_verified,
 TIMESTAMP '2023-12-31 00:00:00' - (c_custkey % 700) * INTERVAL '1' DAY AS event_timestamp,
 TIMESTAMP '2023-12-31 00:00:00' AS ingestion_timestamp FROM customer
"""
MERCHANTS = """
SELECT concat('m_', CAST(s_suppkey AS STRING)) AS merchant_id, s_name AS merchant_name,
 CASE WHEN s_nationkey % 5 = 0 THEN ' Gambling' ELSE 'grocery' END AS merchant_category, 'us' AS country_code,
 s_nationkey % 2 = 0 AS is_online,
 CASE WHEN s_acctbal < 2500 THEN 'HIGH' WHEN s_acctbal < 6000 THEN 'medium' ELSE 'low' END AS risk_tier,
 TIMESTAMP '2023-12-31 00:00:00' AS event_timestamp, TIMESTAMP '2023-12-31 00:00:00' AS ingestion_timestamp FROM supplier
"""
DEVICES = """
SELECT device_id, user_id, 'Android' AS platform, MIN(event_timestamp) AS event_timestamp,
 MIN(ingestion_timestamp) AS ingestion_timestamp, CAST(NULL AS STRING) AS device_fingerprint,
 CAST(NULL AS STRING) AS os_version, CAST(NULL AS STRING) AS ip_address, ' us ' AS country_code
FROM raw_transactions GROUP BY device_id, user_id
"""
LABELS = """
SELECT concat('t_', CAST(event_id AS STRING)) AS transaction_id, (event_id % 33 = 0 OR value > 80) AS is_fraud,
 CAST(NULL AS STRING) AS fraud_type, 'synthetic' AS label_source,
 CAST(ts AS TIMESTAMP) + (event_id % 10) * INTERVAL '1' DAY AS label_timestamp,
 CAST(ts AS TIMESTAMP) + INTERVAL '10' DAY AS ingestion_timestamp
FROM events WHERE event_type IN ('purchase','click','view') AND event_id % 50 <> 0
"""
SCORES = """
SELECT transaction_id, user_id, device_id, merchant_id,
 CAST((CAST(substr(transaction_id, 3) AS BIGINT) * 7919 + CAST(floor(amount) AS BIGINT) * 53) % 10000 AS DOUBLE) / 10000 AS fraud_score,
 CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version,
 CAST(substr(transaction_id, 3) AS BIGINT) % 97 AS latency_ms,
 event_timestamp + INTERVAL '1' SECOND AS scored_at, event_timestamp FROM raw_transactions
"""
STREAM = """
SELECT transaction_id, user_id, device_id, merchant_id,
 CASE CAST(substr(transaction_id, 3) AS BIGINT) % 6 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'amex'
   WHEN 3 THEN 'qris' WHEN 4 THEN 'debit' ELSE 'digital' END AS channel,
 CAST(amount AS DOUBLE) AS amount, currency, payment_method, country_code, coalesce(is_international, false) AS is_international,
 txn_status, coalesce(local_hour, 12) AS local_hour, event_timestamp, ip_address FROM raw_transactions
"""
#: In the order in which they read each other.
TABLES = {
    "raw_transactions": TRANSACTIONS,
    "raw_login_events": LOGINS,
    "raw_users": USERS,
    "raw_merchants": MERCHANTS,
    "raw_devices": DEVICES,
    "fraud_labels": LABELS,
    "score_log": SCORES,
    "stream_transactions": STREAM,
}
NEEDS = {"raw_users": "customer", "raw_merchants": "supplier", "raw_devices": "raw_transactions", "score_log": "raw_transactions", "stream_transactions": "raw_transactions"}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of TABLES."""
    source = NEEDS.get(name, "events")
    df = raw(spark, sf_dir, source) if source in TABLES else spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return spark.sql(TABLES[name].replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: df})


def raw_from(spark: SparkSession, name: str, events: DataFrame) -> DataFrame:
    """A table that is made from events, made from this stream or table of them."""
    source = NEEDS.get(name, "events")
    df = raw_from(spark, source, events) if source in TABLES else events
    return spark.sql(TABLES[name].replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: df})


#: DuckDB: a WITH clause of all of them.
WITH = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in TABLES.items())
