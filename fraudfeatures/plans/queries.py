"""The registered queries on the given tables, and their DuckDB SQL."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudfeatures.functions import registry
from fraudfeatures.operators import checks, evaluation, features, monitoring, serving, staging
from fraudfeatures.operators.windows import Rolling, rolling
from fraudfeatures.plans import fixtures
from fraudfeatures.sources import catalog, tables, work
from fraudfeatures.streaming import jobs, scoring
from fraudfeatures.streaming import store as store_module

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
NOW = "2024-01-25 00:00:00"
STAGING = {
    "stg_transactions": "raw_transactions", "stg_users": "raw_users", "stg_devices": "raw_devices",
    "stg_merchants": "raw_merchants", "stg_login_events": "raw_login_events", "stg_fraud_labels": "fraud_labels",
}


class Tables:
    """The fixture tables of a data set, raw and staged."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return fixtures.raw(self.spark, self.sf_dir, name)

    def stg(self, name: str) -> DataFrame:
        return getattr(staging, name)(self.raw(STAGING[name]))

    txns = property(lambda self: self.stg("stg_transactions"))
    logins = property(lambda self: self.stg("stg_login_events"))
    users = property(lambda self: self.stg("stg_users"))
    merchants = property(lambda self: self.stg("stg_merchants"))
    labels = property(lambda self: self.stg("stg_fraud_labels"))
    scores = property(lambda self: self.raw("score_log"))

    def user_features(self) -> DataFrame:
        return features.user_features(self.txns, self.logins, self.users)

    def device_features(self) -> DataFrame:
        return features.device_features(self.txns, "sweep")

    def merchant_features(self) -> DataFrame:
        return features.merchant_features(self.txns, self.merchants, self.labels, "sweep")

    def training(self) -> DataFrame:
        return features.training_dataset(self.txns, self.logins, self.users, self.merchants, self.labels)


def query(name: str, sql: str | None = None):
    """Registers a function of Tables, with its SQL behind the common WITH clause."""

    def register(make):
        QUERIES[name] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
        if sql:
            # A clause of the query's own goes on where the common one ends.
            ORACLES[name] = f"{WITH},\n{sql.removeprefix('WITH ')}" if sql.startswith("WITH ") else f"{WITH}\n{sql}"
        return make

    return register


# --- the common WITH clause of the SQL -------------------------------------------------------------------------------

STG_SQL = {
    "stg_transactions": """SELECT transaction_id, user_id, device_id, merchant_id, CAST(amount AS DECIMAL(18,4)) AS amount,
 upper(trim(currency)) AS currency, lower(trim(payment_method)) AS payment_method, upper(trim(country_code)) AS country_code, ip_address,
 coalesce(is_international, false) AS is_international, lower(trim(txn_status)) AS txn_status, decline_reason,
 coalesce(local_hour, CAST(hour(event_timestamp) AS INTEGER)) AS local_hour, event_timestamp, ingestion_timestamp
 FROM raw_transactions WHERE transaction_id IS NOT NULL AND amount > 0""",
    "stg_users": """SELECT user_id, lower(trim(email)) AS email, phone, upper(trim(country_code)) AS country_code, signup_date,
 lower(trim(account_type)) AS account_type, coalesce(is_verified, false) AS is_verified, event_timestamp, ingestion_timestamp FROM raw_users WHERE user_id IS NOT NULL""",
    "stg_devices": """SELECT device_id, user_id, device_fingerprint, platform, os_version, ip_address, upper(trim(country_code)) AS country_code, event_timestamp, ingestion_timestamp
 FROM raw_devices WHERE device_id IS NOT NULL AND user_id IS NOT NULL""",
    "stg_merchants": """SELECT merchant_id, merchant_name, lower(trim(merchant_category)) AS merchant_category, upper(trim(country_code)) AS country_code,
 coalesce(is_online, false) AS is_online, lower(trim(risk_tier)) AS risk_tier, event_timestamp, ingestion_timestamp FROM raw_merchants WHERE merchant_id IS NOT NULL""",
    "stg_login_events": """SELECT login_event_id, user_id, device_id, ip_address, upper(trim(country_code)) AS country_code, lower(trim(login_status)) AS login_status,
 failure_reason, event_timestamp, ingestion_timestamp FROM raw_login_events WHERE user_id IS NOT NULL""",
    "stg_fraud_labels": """SELECT transaction_id, coalesce(is_fraud, false) AS is_fraud, fraud_type, label_source, label_timestamp, ingestion_timestamp
 FROM fraud_labels WHERE transaction_id IS NOT NULL""",
}


def sec(ts: str = "event_timestamp") -> str:
    return f"CAST(floor(epoch({ts})) AS BIGINT)"


def frame(key: str, n: int) -> str:
    return f"(PARTITION BY {key} ORDER BY {sec()} RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def count_sql(name: str, key: str, n: int, filter: str = "") -> str:
    return f"count(*) {filter} OVER {frame(key, n)} AS {name}"


def sum_sql(name: str, key: str, n: int, value: str = "amount") -> str:
    return f"CAST(coalesce(sum({value}) OVER {frame(key, n)}, 0) AS DOUBLE) AS {name}"


def distinct_sql(name: str, key: str, n: int, value: str) -> str:
    return f"count(DISTINCT {value}) OVER {frame(key, n)} AS {name}"


def avg_sql(name: str, key: str, n: int, value: str) -> str:
    return f"coalesce(CAST(sum({value}) OVER {frame(key, n)} AS DOUBLE) / nullif(count({value}) OVER {frame(key, n)}, 0), 0.0) AS {name}"


D1, D7, D30 = 86400, 7 * 86400, 30 * 86400
SHORT = (("5m", 300), ("10m", 600), ("1h", 3600))
USER_TXN_SQL = ", ".join([
    *(count_sql(f"user_txn_count_{w}", "user_id", n) for w, n in (("1d", D1), ("7d", D7), ("30d", D30))),
    *(sum_sql(f"user_txn_amount_sum_{w}", "user_id", n) for w, n in (("1d", D1), ("7d", D7), ("30d", D30))),
    avg_sql("user_avg_ticket_30d", "user_id", D30, "amount"),
    distinct_sql("user_distinct_merchants_30d", "user_id", D30, "merchant_id"),
    distinct_sql("user_distinct_devices_30d", "user_id", D30, "device_id"),
    count_sql("user_decline_count_7d", "user_id", D7, "FILTER (WHERE txn_status = 'decline')"),
])
USER_ONLINE_SQL = ", ".join([
    *(count_sql(f"user_txn_count_{w}", "user_id", n) for w, n in SHORT),
    *(sum_sql(f"user_txn_amount_sum_{w}", "user_id", n) for w, n in SHORT),
    *(distinct_sql(f"user_distinct_merchants_{w}", "user_id", n, "merchant_id") for w, n in SHORT),
])
DEVICE_SQL = ", ".join([distinct_sql("device_distinct_users_30d", "device_id", D30, "user_id"), count_sql("device_txn_count_7d", "device_id", D7), count_sql("device_txn_count_1d", "device_id", D1)])
DEVICE_ONLINE_SQL = ", ".join(count_sql(f"device_txn_count_{w}", "device_id", n) for w, n in SHORT)
LABELLED_SQL = "SELECT t.*, CAST(coalesce(l.is_fraud, false) AS INTEGER) AS is_fraud FROM stg_transactions t LEFT JOIN stg_fraud_labels l USING (transaction_id)"
MERCHANT_SQL = ", ".join([count_sql("merchant_txn_count_30d", "merchant_id", D30), avg_sql("merchant_avg_ticket_30d", "merchant_id", D30, "amount"), avg_sql("merchant_fraud_rate_30d", "merchant_id", D30, "is_fraud")])


def login_sql(windows: tuple) -> str:
    counts = ", ".join(f"coalesce(sum(f) OVER {frame('user_id', n)}, 0)::BIGINT AS user_failed_logins_{w}" for w, n in windows)
    return f"""SELECT * EXCLUDE (f) FROM (SELECT transaction_id, user_id, event_timestamp, f, {counts} FROM (
 SELECT transaction_id, user_id, event_timestamp, 0 AS f FROM stg_transactions
 UNION ALL SELECT NULL, user_id, event_timestamp, 1 FROM stg_login_events WHERE login_status = 'failed')) WHERE f = 0"""


MODELS_SQL = {
    "int_user_txn": f"SELECT transaction_id, user_id, event_timestamp, {USER_TXN_SQL} FROM stg_transactions",
    "int_user_online": f"SELECT transaction_id, user_id, event_timestamp, {USER_ONLINE_SQL} FROM stg_transactions",
    "int_login": login_sql((("1d", D1), ("7d", D7))),
    "int_login_online": login_sql((("15m", 900), ("1h", 3600))),
    "int_device": f"SELECT transaction_id, device_id, event_timestamp, {DEVICE_SQL} FROM stg_transactions",
    "int_device_online": f"SELECT transaction_id, device_id, event_timestamp, {DEVICE_ONLINE_SQL} FROM stg_transactions",
    "labelled": LABELLED_SQL,
    "int_merchant": f"SELECT transaction_id, merchant_id, event_timestamp, {MERCHANT_SQL} FROM labelled",
    "user_features": """SELECT t.transaction_id, t.user_id, t.event_timestamp,
 coalesce(CAST(datediff('day', u.signup_date, CAST(t.event_timestamp AS DATE)) AS INTEGER), 0) AS user_account_age_days,
 coalesce(CAST(u.account_type = 'standard' AS INTEGER), 0) AS user_is_standard_account, coalesce(CAST(u.is_verified AS INTEGER), 0) AS user_is_verified,
 a.* EXCLUDE (transaction_id, user_id, event_timestamp), b.* EXCLUDE (transaction_id, user_id, event_timestamp),
 c.* EXCLUDE (transaction_id, user_id, event_timestamp), d.* EXCLUDE (transaction_id, user_id, event_timestamp)
 FROM stg_transactions t LEFT JOIN stg_users u ON u.user_id = t.user_id JOIN int_user_txn a USING (transaction_id)
 JOIN int_user_online b USING (transaction_id) JOIN int_login c USING (transaction_id) JOIN int_login_online d USING (transaction_id)""",
    "device_features": """SELECT a.*, CAST(device_distinct_users_30d > 2 AS INTEGER) AS device_is_shared_flag,
 b.* EXCLUDE (transaction_id, device_id, event_timestamp) FROM int_device a JOIN int_device_online b USING (transaction_id)""",
    "merchant_features": """SELECT a.*, m.merchant_category, m.risk_tier, coalesce(CAST(m.risk_tier = 'high' AS INTEGER), 0) AS merchant_is_high_risk,
 coalesce(CAST(m.is_online AS INTEGER), 0) AS merchant_is_online FROM int_merchant a LEFT JOIN stg_merchants m USING (merchant_id)""",
    "training": """SELECT t.transaction_id, t.user_id, t.device_id, t.merchant_id, t.event_timestamp, CAST(t.amount AS DOUBLE) AS txn_amount, t.currency,
 t.payment_method, CAST(t.is_international AS INTEGER) AS is_international, t.local_hour, CAST(t.txn_status = 'decline' AS INTEGER) AS prev_decline_flag,
 u.* EXCLUDE (transaction_id, user_id, event_timestamp), d.* EXCLUDE (transaction_id, device_id, event_timestamp),
 m.* EXCLUDE (transaction_id, merchant_id, event_timestamp, merchant_category, risk_tier), t.is_fraud
 FROM labelled t JOIN user_features u USING (transaction_id) JOIN device_features d USING (transaction_id) JOIN merchant_features m USING (transaction_id)""",
    "scored": "SELECT s.*, s.fraud_score AS score, CAST(l.is_fraud AS INTEGER) AS label FROM score_log s JOIN stg_fraud_labels l USING (transaction_id)",
    "points": """SELECT score, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS pos, sum(n) OVER () AS neg FROM (
 SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM scored GROUP BY score) WINDOW w AS (ORDER BY score DESC)""",
}
WITH = fixtures.WITH + "".join(f",\n{n} AS ({q})" for n, q in {**STG_SQL, **MODELS_SQL}.items())
BAND = "CASE WHEN {0} >= 0.8 THEN 'critical' WHEN {0} >= 0.5 THEN 'high' WHEN {0} >= 0.2 THEN 'medium' ELSE 'low' END"

# --- sources and sinks -----------------------------------------------------------------------------------------------


def _folder(t: Tables, name: str) -> str:
    return work.shared_folder(t.spark, name)


RAW_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{', '.join(c)}' AS column_names, count(*) AS n_rows, {'count(ip_address)' if 'ip_address' in c else '0'} AS n_addresses FROM {n}" for n, c in tables.RAW_COLUMNS.items()
)


@query("read_raw_tables", RAW_SQL)
def _(t):
    folder = _folder(t, "raw")
    for name in tables.RAW_COLUMNS:
        t.raw(name).withColumn("not_read", F.lit(1)).write.parquet(f"{folder}/{name}")
    parts = []
    for name, df in tables.read_raw_tables(t.spark, folder).items():
        addresses = F.count("ip_address") if "ip_address" in df.columns else F.lit(0).cast("bigint")
        counts = df.agg(F.count("*").alias("n_rows"), addresses.alias("n_addresses"))
        parts.append(counts.select(F.lit(name).alias("table_name"), F.lit(", ".join(df.columns)).alias("column_names"), "n_rows", "n_addresses"))
    return reduce(DataFrame.unionByName, parts)


@query("full_refresh_load", "SELECT transaction_id, amount, event_timestamp FROM stg_transactions")
def _(t):
    path, df = _folder(t, "refresh"), t.txns.select("transaction_id", "amount", "event_timestamp")
    tables.full_refresh(df, path)
    return tables.full_refresh(df, path)


@query("load_reconcile", """SELECT 'transactions' AS table_name, (SELECT count(*) FROM raw_transactions) AS source_rows, (SELECT count(*) FROM stg_transactions) AS target_rows, 'MISMATCH' AS status
 UNION ALL SELECT 'users', (SELECT count(*) FROM raw_users), (SELECT count(*) FROM stg_users), 'OK'""")
def _(t):
    return tables.reconcile({"transactions": (t.raw("raw_transactions"), t.txns), "users": (t.raw("raw_users"), t.users)})


@query("month_partitioned_write", "SELECT transaction_id, user_id, CAST(strftime(event_timestamp, '%Y%m') AS INTEGER) AS event_month FROM stg_transactions")
def _(t):
    path = _folder(t, "months")
    tables.write_by_month(t.txns, path, "user_id")
    return t.spark.read.parquet(path).select("transaction_id", "user_id", F.col("event_month").cast("int").alias("event_month"))


@query("export_feature_parquet", "SELECT * FROM merchant_features")
def _(t):
    path = _folder(t, "export")
    tables.export_features({"merchant": t.merchant_features()}, path)
    return t.spark.read.parquet(f"{path}/merchant")


@query("feature_time_range", f"SELECT min(event_timestamp) AS first_time, least(max(event_timestamp), CAST('{NOW}' AS TIMESTAMP)) AS last_time FROM stg_transactions")
def _(t):
    return tables.time_range([t.txns.select("event_timestamp")] * 3, F.lit(NOW).cast("timestamp"))


def _values(t: Tables) -> DataFrame:
    return tables.routed(t.raw("stream_transactions"))


@query("route_channel_topic", "SELECT concat('txn.raw.', channel) AS topic, user_id AS key, count(*) AS n FROM stream_transactions GROUP BY ALL")
def _(t):
    return _values(t).groupBy("topic", "key").agg(F.count("*").alias("n"))


@query("decode_stream_value", """SELECT transaction_id, amount, is_international, local_hour, event_timestamp, CAST(NULL AS BIGINT) AS n_bad FROM stream_transactions WHERE local_hour <> 3
 UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, count(*) FROM stream_transactions WHERE local_hour = 3""")
def _(t):
    """Values of a stream, some cut short: good and bad rows are written in one pass and counted while it runs."""
    folder = _folder(t, "decoded")
    cut = F.when(F.get_json_object("value", "$.local_hour") == "3", F.substring("value", 1, 40)).otherwise(F.col("value"))
    parsed = tables.parsed(tables.routed(_stream(t)).select(cut.alias("value")))
    counts = jobs.counted_run(jobs.observed(parsed, "decoded", F.col("row.transaction_id").isNotNull()), jobs.apart(f"{folder}/table"), f"{folder}/checkpoint")
    good = jobs.read_apart(t.spark, f"{folder}/table", True).select("row.*").select("transaction_id", "amount", "is_international", "local_hour", "event_timestamp")
    counted = t.spark.range(1).select(F.lit(counts.totals["decoded"]["bad"]).cast("bigint").alias("n_bad"))
    return good.unionByName(counted, allowMissingColumns=True)


@query("confluent_header", "SELECT event_id % 70000 AS schema_id, event_id % 9 <> 0 AS valid, count(*) AS n FROM events WHERE event_id % 9 <> 0 GROUP BY ALL UNION ALL SELECT NULL, false, count(*) FROM events WHERE event_id % 9 = 0")
def _(t):
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    magic = F.when(F.col("event_id") % 9 == 0, "01").otherwise("00")
    framed = F.unhex(F.concat(magic, F.lpad(F.hex(F.col("event_id") % 70000), 8, "0"), F.hex(F.encode("event_type", "UTF-8"))))
    valid, number, _ = tables.confluent_header(framed)
    return events.select(number.alias("schema_id"), valid.alias("valid")).groupBy("schema_id", "valid").agg(F.count("*").alias("n"))


@query("idempotent_txn_sink", "SELECT transaction_id, amount, CAST(strftime(event_timestamp, '%Y%m') AS INTEGER) AS event_month FROM stg_transactions")
def _(t):
    path, month = _folder(t, "sink"), F.date_format("event_timestamp", "yyyyMM").cast("int")
    df = t.txns.select("transaction_id", "amount", month.alias("event_month"))
    half = df.where(F.crc32("transaction_id") % 2 == 0)
    for batch in (half, df, df.unionByName(half)):
        tables.append_missing(batch, path, partition="event_month")
    return t.spark.read.parquet(path)


OUTBOX_SQL = "SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN CAST(ts AS TIMESTAMP) END AS published_at FROM events"


def _outbox(t: Tables) -> DataFrame:
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    return events.select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 3 == 0, F.col("ts").cast("timestamp")).alias("published_at"))


@query("outbox_backlog", f"SELECT id, published_at IS NOT NULL AS published FROM (SELECT id, CASE WHEN id IN (SELECT id FROM ({OUTBOX_SQL}) WHERE published_at IS NULL ORDER BY id LIMIT 100) THEN CAST('{NOW}' AS TIMESTAMP) ELSE published_at END AS published_at FROM ({OUTBOX_SQL}))")
def _(t):
    outbox = _outbox(t)
    marked = tables.mark_published(outbox, tables.outbox_backlog(outbox, 100), F.lit(NOW).cast("timestamp"))
    return marked.select("id", F.col("published_at").isNotNull().alias("published"))


@query("outbox_status", f"SELECT count(*) AS total, count(*) - count(published_at) AS unpublished, count(published_at) AS published, max(published_at) AS last_published FROM ({OUTBOX_SQL})")
def _(t):
    return tables.outbox_status(_outbox(t))


@query("outbox_retention", f"SELECT * FROM ({OUTBOX_SQL}) WHERE published_at IS NULL OR {sec(f'CAST({chr(39)}{NOW}{chr(39)} AS TIMESTAMP)')} - {sec('published_at')} <= 604800")
def _(t):
    return tables.outbox_retained(_outbox(t), F.lit(NOW).cast("timestamp"))


@query("stream_status", "SELECT 'transactions' AS table_name, count(*) AS n_rows, max(event_timestamp) AS newest FROM stream_transactions UNION ALL SELECT 'logins', count(*), max(event_timestamp) FROM raw_login_events")
def _(t):
    return tables.stream_status({"transactions": (t.raw("stream_transactions"), "event_timestamp"), "logins": (t.raw("raw_login_events"), "event_timestamp")})


@query("audit_export", "SELECT transaction_id, fraud_score, scored_at FROM score_log WHERE CAST(scored_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-15' ORDER BY scored_at, transaction_id LIMIT 1000")
def _(t):
    path = _folder(t, "audit")
    scores = t.scores.select("transaction_id", "fraud_score", "scored_at")
    tables.audit_export(scores, path, "2024-01-05", "2024-01-15", 1000, "parquet")
    return t.spark.read.parquet(path)


# --- staging and checks ----------------------------------------------------------------------------------------------

for _name in STAGING:
    query(_name, f"SELECT * FROM {_name}")(lambda t, n=_name: t.stg(n))

TXN_COLUMNS = ["transaction_id", "user_id", "merchant_id", "is_international", "ip_address", "local_hour"]
NULLS_SQL = " UNION ALL ".join(f"SELECT 'not_null' AS check_name, 'raw_transactions' AS table_name, '{c}' AS subject, count(*) - count({c}) AS bad_rows FROM raw_transactions" for c in TXN_COLUMNS)
CHECKS_SQL = {
    "dq_not_null": NULLS_SQL,
    "dq_unique": "SELECT 'unique' AS check_name, 'raw_devices' AS table_name, 'device_id' AS subject, count(*) AS bad_rows FROM (SELECT device_id FROM raw_devices GROUP BY 1 HAVING count(*) > 1)",
    "dq_accepted_values": "SELECT 'accepted_values' AS check_name, 'raw_transactions' AS table_name, 'txn_status' AS subject, count(*) AS bad_rows FROM raw_transactions WHERE txn_status NOT IN ('success', 'decline', 'pending')",
    "dq_range": "SELECT 'range' AS check_name, 'raw_transactions' AS table_name, 'amount' AS subject, count(*) AS bad_rows FROM raw_transactions WHERE amount < 0.01",
    "dq_referential": """SELECT 'reference' AS check_name, 'raw_transactions' AS table_name, 'user_id' AS subject, count(*) AS bad_rows FROM raw_transactions WHERE user_id NOT IN (SELECT user_id FROM raw_users)
 UNION ALL SELECT 'reference', 'raw_transactions', 'merchant_id', count(*) FROM raw_transactions WHERE merchant_id NOT IN (SELECT merchant_id FROM raw_merchants)
 UNION ALL SELECT 'shared', 'raw_devices', 'device_id', count(*) FROM (SELECT device_id FROM raw_devices GROUP BY 1 HAVING count(DISTINCT user_id) > 1)""",
}


def _checks(t: Tables) -> dict[str, DataFrame]:
    txns, devices = t.raw("raw_transactions"), t.raw("raw_devices")
    refer = [
        checks.references(txns, "raw_transactions", "user_id", t.raw("raw_users"), "user_id"),
        checks.references(txns, "raw_transactions", "merchant_id", t.raw("raw_merchants"), "merchant_id"),
        checks.shared(devices, "raw_devices", "device_id", "user_id"),
    ]
    return {
        "dq_not_null": checks.not_null(txns, "raw_transactions", TXN_COLUMNS),
        "dq_unique": checks.unique(devices, "raw_devices", "device_id"),
        "dq_accepted_values": checks.accepted_values(txns, "raw_transactions", "txn_status", ["success", "decline", "pending"]),
        "dq_range": checks.at_least(txns, "raw_transactions", "amount", 0.01),
        "dq_referential": refer[0].unionByName(refer[1]).unionByName(refer[2]),
    }


for _name, _sql in CHECKS_SQL.items():
    query(_name, _sql)(lambda t, n=_name: _checks(t)[n])
query("dq_report", "SELECT *, bad_rows = 0 AS passed FROM (" + " UNION ALL ".join(CHECKS_SQL.values()) + ")")(lambda t: checks.report(list(_checks(t).values())))

REQUESTS = """SELECT transaction_id, CASE WHEN n % 13 = 0 THEN '' ELSE user_id END AS user_id, device_id, merchant_id,
 CASE WHEN n % 7 = 0 THEN -1 ELSE CAST(amount AS DOUBLE) END AS amount, CASE WHEN n % 11 = 0 THEN 24 ELSE local_hour END AS local_hour
 FROM (SELECT *, CAST(substr(transaction_id, 3) AS BIGINT) AS n FROM raw_transactions)"""


@query("request_validation", f"""SELECT transaction_id, CASE WHEN trim(user_id) = '' THEN 'missing user_id' WHEN amount <= 0 THEN 'amount not positive'
 WHEN local_hour < 0 OR local_hour > 23 THEN 'local_hour out of range' END AS reason FROM ({REQUESTS})""")
def _(t):
    accepted, refused = checks.request_validation(t.spark.sql(REQUESTS.replace("raw_transactions", "{txns}"), txns=t.raw("raw_transactions")))
    return accepted.withColumn("reason", F.lit(None).cast("string")).unionByName(refused).select("transaction_id", "reason")


# --- rolling windows and features ------------------------------------------------------------------------------------

query("rolling_window", f"SELECT transaction_id, {count_sql('n_2d', 'merchant_id', 2 * D1)}, {sum_sql('amount_2d', 'merchant_id', 2 * D1)}, {distinct_sql('users_2d', 'merchant_id', 2 * D1, 'user_id')} FROM stg_transactions")(
    lambda t: rolling(t.txns, "merchant_id", [Rolling("n_2d", "count", 2 * D1), Rolling("amount_2d", "sum", 2 * D1, "amount"), Rolling("users_2d", "distinct", 2 * D1, "user_id")], engine="sweep").select("transaction_id", "n_2d", "amount_2d", "users_2d")
)
query("user_txn_stats", "SELECT * FROM int_user_txn")(lambda t: features.user_txn_stats(t.txns))
query("user_txn_online_stats", "SELECT * FROM int_user_online")(lambda t: features.user_txn_online_stats(t.txns))
query("user_login_stats", "SELECT * FROM int_login")(lambda t: features.user_login_stats(t.txns, t.logins))
query("user_login_online_stats", "SELECT * FROM int_login_online")(lambda t: features.user_login_online_stats(t.txns, t.logins))
query("device_stats", "SELECT * FROM int_device")(lambda t: features.device_stats(t.txns, "sweep"))
query("device_txn_online_stats", "SELECT * FROM int_device_online")(lambda t: features.device_txn_online_stats(t.txns))
query("merchant_stats", "SELECT * FROM int_merchant")(lambda t: features.merchant_stats(t.txns, t.labels, "sweep"))
query("window_from_registry", f"SELECT transaction_id, user_id, event_timestamp, {sum_sql('user_txn_amount_sum_2h', 'user_id', 7200)} FROM stg_transactions")(
    lambda t: features.window_from_registry(t.txns, "user_txn_amount_sum_2h", "user_id", "ZRANGEBYSCORE_SUM", "2h", "amount")
)
query("merchant_fraud_rate_asof_labels", f"""SELECT t.transaction_id, any_value(t.merchant_id) AS merchant_id, any_value(t.event_timestamp) AS event_timestamp,
 coalesce(count(*) FILTER (l.is_fraud AND {sec('l.label_timestamp')} < {sec('t.event_timestamp')}) / nullif(count(p.transaction_id), 0), 0.0) AS merchant_fraud_rate_30d
 FROM stg_transactions t LEFT JOIN stg_transactions p ON p.merchant_id = t.merchant_id AND {sec('p.event_timestamp')} BETWEEN {sec('t.event_timestamp')} - {D30} AND {sec('t.event_timestamp')} - 1
 LEFT JOIN stg_fraud_labels l ON l.transaction_id = p.transaction_id GROUP BY t.transaction_id""")(lambda t: features.merchant_fraud_rate_asof_labels(t.txns, t.labels, engine="sweep"))
query("user_features", "SELECT * FROM user_features")(Tables.user_features)
query("device_features", "SELECT * FROM device_features")(Tables.device_features)
query("merchant_features", "SELECT * FROM merchant_features")(Tables.merchant_features)
query("training_dataset", "SELECT * FROM training")(Tables.training)


def _stored_training(t: Tables) -> DataFrame:
    """The training set from feature tables that are stored in buckets of the transaction's id."""
    folder, buckets = _folder(t, "bucketed"), 8
    made = {"txns": t.txns, "labels": t.labels, "users": t.user_features(), "devices": t.device_features(), "merchants": t.merchant_features()}
    kept = {name: catalog.store_bucketed(df, f"{name}_{folder.rsplit('-', 1)[1]}", f"{folder}/{name}", buckets=buckets) for name, df in made.items()}
    return features.training_dataset_by_join(kept["txns"], kept["users"], kept["devices"], kept["merchants"], kept["labels"])


query("training_dataset_stored", "SELECT * FROM training")(_stored_training)
ASKED_SQL = "CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 3 = 2 THEN txn_amount * 2 ELSE 0 END"
VECTOR_SQL = ", ".join(f"CAST({ASKED_SQL if c == 'txn_amount' else f'coalesce({c}, 0)'} AS DOUBLE)" for c in registry.FRAUD_V1)


@query("feature_vector", f"SELECT transaction_id, array_to_string([CAST(round(x * 10000) AS BIGINT) FOR x IN [{VECTOR_SQL}]], ',') AS vector FROM training")
def _(t):
    """The request's amounts win, though a third of them is null and a third no number."""
    n = F.substring("transaction_id", 3, 20).cast("bigint") % 3
    df = t.training().withColumn("request_txn_amount", F.when(n == 1, "abc").when(n == 2, (F.col("txn_amount") * 2).cast("string")))
    whole = F.transform(registry.feature_vector(df), lambda x: F.round(x * 10000).cast("bigint").cast("string"))
    return df.select("transaction_id", F.array_join(whole, ",").alias("vector"))


@query("pit_join", f"""SELECT l.login_event_id, CASE WHEN {sec('l.event_timestamp')} - {sec('f.event_timestamp')} <= 259200 THEN f.txn END AS transaction_id,
 CASE WHEN {sec('l.event_timestamp')} - {sec('f.event_timestamp')} <= 259200 THEN f.user_txn_count_7d END AS user_txn_count_7d
 FROM stg_login_events l ASOF LEFT JOIN (SELECT user_id, event_timestamp, max(transaction_id) AS txn, max_by(user_txn_count_7d, transaction_id) AS user_txn_count_7d FROM int_user_txn GROUP BY ALL) f
 ON l.user_id = f.user_id AND l.event_timestamp >= f.event_timestamp""")
def _(t):
    rows = features.user_txn_stats(t.txns)
    joined = serving.pit_join(t.logins, rows, "user_id", ["transaction_id", "user_txn_count_7d"])
    return joined.select("login_event_id", "transaction_id", "user_txn_count_7d")


@query("override_online_from_log", "SELECT transaction_id, CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 4 = 0 THEN user_txn_count_1h + 1 ELSE user_txn_count_1h END AS user_txn_count_1h FROM int_user_online")
def _(t):
    online = features.user_txn_online_stats(t.txns).select("transaction_id", "user_txn_count_1h")
    log = online.where(F.substring("transaction_id", 3, 20).cast("bigint") % 4 == 0).withColumn("user_txn_count_1h", F.col("user_txn_count_1h") + 1)
    return serving.override_from_log(online, log, ["user_txn_count_1h"])


FAULTS = [
    "fraud_v1: nope is not known", "fraud_v1: txn_amount repeats", "device_txn_count_1d: column not_there is not in the device table",
    "local_hour: mode request needs a source", "user_txn_count_5m: operation SUM is none of ZCOUNT, ZRANGEBYSCORE_SUM, ZCARD_WINDOWED",
    "user_txn_count_10m: key user:all lacks {user_id}", "user_txn_count_1h: mode online needs window", "seller_score: entity seller is not known",
    "user_age: mode odd",
]


@query("registry_validate", "SELECT problem, n_rows FROM (VALUES " + ", ".join(f"('{f}')" for f in FAULTS) + ") AS v(problem), (SELECT count(*) AS n_rows FROM stg_transactions)")
def _(t):
    """A registry with faults, against the feature tables; the right one has none."""
    views = {"user": t.user_features(), "device": t.device_features(), "merchant": t.merchant_features()}
    if problems := registry.validate(views):
        raise ValueError(problems)
    known = registry.features()
    changes = {
        "device_txn_count_1d": {"source": "not_there"}, "local_hour": {"source": None}, "user_txn_count_5m": {"operation": "SUM"},
        "user_txn_count_10m": {"key": "user:all"}, "user_txn_count_1h": {"window": None},
    }
    known |= {name: replace(known[name], **change) for name, change in changes.items()}
    known |= {"seller_score": registry.Feature("seller_score", "seller", "batch", "x"), "user_age": registry.Feature("user_age", "user", "odd")}
    found = registry.validate(views, known, {"fraud_v1": [*registry.FRAUD_V1, "nope", "txn_amount"]})
    counted = t.txns.agg(F.count("*").alias("n_rows"))
    return counted.select(F.explode(F.array(*map(F.lit, found))).alias("problem"), "n_rows")


# --- latest state ----------------------------------------------------------------------------------------------------

query("materialize_latest", "SELECT * FROM device_features QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_timestamp DESC, transaction_id DESC) = 1")(lambda t: serving.materialize_latest(t.device_features(), "device_id"))
LOOKUP = ["user_txn_count_30d", "user_distinct_merchants_30d", "device_txn_count_7d", "merchant_txn_count_30d"]


@query("online_lookup", f"""SELECT r.transaction_id, u.user_id IS NOT NULL AS feast_ok, coalesce(u.user_txn_count_30d, 0) AS user_txn_count_30d, coalesce(u.user_distinct_merchants_30d, 0) AS user_distinct_merchants_30d,
 coalesce(d.device_txn_count_7d, 0) AS device_txn_count_7d, coalesce(m.merchant_txn_count_30d, 0) AS merchant_txn_count_30d FROM raw_transactions r
 LEFT JOIN (SELECT * FROM user_features WHERE event_timestamp <= TIMESTAMP '2024-01-10 00:00:00' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, transaction_id DESC) = 1) u ON u.user_id = r.user_id
 LEFT JOIN (SELECT * FROM device_features QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_timestamp DESC, transaction_id DESC) = 1) d ON d.device_id = r.device_id
 LEFT JOIN (SELECT * FROM merchant_features QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY event_timestamp DESC, transaction_id DESC) = 1) m ON m.merchant_id = r.merchant_id""")
def _(t):
    users = serving.materialize_latest(t.user_features(), "user_id", end=F.lit("2024-01-10 00:00:00").cast("timestamp"))
    parts = users, serving.materialize_latest(t.device_features(), "device_id"), serving.materialize_latest(t.merchant_features(), "merchant_id")
    requests = t.raw("raw_transactions").select("transaction_id", "user_id", "device_id", "merchant_id")
    return serving.online_lookup(requests, *parts).select("transaction_id", "feast_ok", *LOOKUP)


LATEST_SQL = " UNION ALL ".join(f"SELECT '{k}' AS entity_type, {k}_id AS entity_id, amount, CAST(local_hour AS DOUBLE) AS hour, event_timestamp FROM stream_transactions QUALIFY row_number() OVER (PARTITION BY {k}_id ORDER BY event_timestamp DESC, transaction_id DESC) = 1" for k in ("user", "device"))


@query("latest_features", LATEST_SQL)
def _(t):
    """Kept by a stream over several batches, each of them merged twice, as after a failure."""
    folder = _folder(t, "latest")
    rows = serving.latest_rows(_stream(t))
    store = store_module.KeyedStore(t.spark, f"{folder}/table", rows.schema, ["entity_type", "entity_id"], ["event_timestamp", "transaction_id"], buckets=8)
    jobs.run_once(rows, lambda batch, number: [store.merge(batch, number) for _ in range(2)], f"{folder}/checkpoint")
    return store.read().select("entity_type", "entity_id", F.col("features")["last_txn_amount"].alias("amount"), F.col("features")["last_txn_local_hour"].alias("hour"), "event_timestamp")


@query("cold_fallback", f"""SELECT r.transaction_id, u.user_id IS NOT NULL AS feast_ok, coalesce(u.user_txn_count_7d, 0) AS user_txn_count_7d, CASE WHEN u.user_id IS NULL THEN coalesce(l.amount, 0) ELSE 0 END AS last_txn_amount
 FROM stg_transactions r LEFT JOIN (SELECT * FROM int_user_txn WHERE CAST(substr(user_id, 3) AS BIGINT) % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, transaction_id DESC) = 1) u USING (user_id)
 LEFT JOIN (SELECT * FROM ({LATEST_SQL}) WHERE entity_type = 'user') l ON l.entity_id = r.user_id""")
def _(t):
    offline = serving.materialize_latest(features.user_txn_stats(t.txns), "user_id").where(F.substring("user_id", 3, 20).cast("bigint") % 2 == 0)
    latest = serving.latest_features(t.raw("stream_transactions"))
    out = serving.cold_fallback(t.txns.select("transaction_id", "user_id"), offline, latest, ["user_txn_count_7d"])
    return out.select("transaction_id", "feast_ok", "user_txn_count_7d", "last_txn_amount")


def _at_sql() -> str:
    age = f"{sec('r.event_timestamp')} - {sec('e.event_timestamp')}"
    user = ", ".join(
        f"count(*) FILTER ({age} <= {n}) AS user_txn_count_{w}, round(coalesce(CAST(sum(e.amount) FILTER ({age} <= {n}) AS DOUBLE), 0), 4) AS user_txn_amount_sum_{w}, count(DISTINCT e.merchant_id) FILTER ({age} <= {n}) AS user_distinct_merchants_{w}" for w, n in SHORT
    )
    device = ", ".join(f"count(*) FILTER ({age} <= {n}) AS device_txn_count_{w}" for w, n in SHORT)
    login = ", ".join(f"count(DISTINCT {sec('e.event_timestamp')}) FILTER ({age} <= {n}) AS user_failed_logins_{w}" for w, n in (("15m", 900), ("1h", 3600)))
    near = f"{sec('e.event_timestamp')} BETWEEN {sec('r.event_timestamp')} - 3600 AND {sec('r.event_timestamp')}"
    names = [f"{p}_{w}" for p in ("user_txn_count", "user_txn_amount_sum", "user_distinct_merchants", "device_txn_count") for w, _ in SHORT] + ["user_failed_logins_15m", "user_failed_logins_1h"]
    return f"""SELECT r.login_event_id AS request_id, {', '.join(f'coalesce({n}, 0) AS {n}' for n in names)} FROM stg_login_events r
 LEFT JOIN (SELECT r.login_event_id, {user} FROM stg_login_events r JOIN stg_transactions e ON e.user_id = r.user_id AND {near} GROUP BY 1) a USING (login_event_id)
 LEFT JOIN (SELECT r.login_event_id, {device} FROM stg_login_events r JOIN stg_transactions e ON e.device_id = concat('d_', CAST(r.login_event_id % 40 AS STRING)) AND {near} GROUP BY 1) b USING (login_event_id)
 LEFT JOIN (SELECT r.login_event_id, {login} FROM stg_login_events r JOIN stg_login_events e ON e.user_id = r.user_id AND e.login_status = 'failed' AND {near} GROUP BY 1) c USING (login_event_id)"""


@query("online_features_at", _at_sql())
def _(t):
    device = F.concat(F.lit("d_"), (F.col("login_event_id") % 40).cast("string"))
    requests = t.logins.select(F.col("login_event_id").alias("request_id"), "user_id", device.alias("device_id"), F.col("event_timestamp").alias("now"))
    return serving.online_features_at(requests, t.txns, t.logins).drop("user_id", "device_id", "now")


@query("service_features", _at_sql())
def _(t):
    """The online features of a service, compiled from the registry."""
    device = F.concat(F.lit("d_"), (F.col("login_event_id") % 40).cast("string"))
    requests = t.logins.select(F.col("login_event_id").alias("request_id"), "user_id", device.alias("device_id"), F.col("event_timestamp").alias("now"))
    return serving.service_features_at("fraud_full", requests, t.txns, t.logins)


# --- streams ---------------------------------------------------------------------------------------------------------


#: Rows of a file of a stream's source, about.
FILE_ROWS = 250_000


def _batches(t: Tables, parts: list[DataFrame], rows: int) -> DataFrame:
    """A stream of a batch for each part, in this order. rows: those of the largest part. All parts are written in the same number of
    files, which a batch reads at once, so that there are as many batches at any size; where a part fills fewer files, empty ones follow."""
    folder, files = _folder(t, "source"), -(-max(rows, 1) // FILE_ROWS)
    for i, part in enumerate(parts):
        part.repartition(files).write.mode("append").parquet(folder)
        for _ in range((i + 1) * files - len(t.spark.read.schema(part.schema).parquet(folder).inputFiles())):
            part.limit(0).write.mode("append").parquet(folder)
    return t.spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", files).parquet(folder)


def _stream(t: Tables, name: str = "stream_transactions", slices: int = 3) -> DataFrame:
    """A fixture table as a stream: the given events in slices of time, oldest first, each of them one batch."""
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    place = F.floor((at - F.lit(first)) / F.lit((last or 0) - (first or 0) + 1) * slices)
    rows = max((n for _, n in events.groupBy(place).count().collect()), default=0)  # a count for each slice
    return fixtures.raw_from(t.spark, name, _batches(t, [events.where(place == i) for i in range(slices)], rows))


def _landed(t: Tables, name: str, stream: DataFrame) -> DataFrame:
    folder = _folder(t, name)
    jobs.land(stream, f"{folder}/table", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{folder}/table")


query("ingest_transactions", "SELECT transaction_id, channel, amount, event_timestamp FROM stream_transactions")(
    lambda t: _landed(t, "txns", _stream(t)).select("transaction_id", "channel", "amount", "event_timestamp")
)
query("ingest_logins", "SELECT login_event_id, login_status, event_timestamp FROM raw_login_events")(
    lambda t: _landed(t, "logins", _stream(t, "raw_login_events")).select("login_event_id", "login_status", "event_timestamp")
)


def _score(df: DataFrame) -> DataFrame:
    """A stand-in for a model's score, from amount and hour."""
    raw = F.round(F.least(F.lit(0.999999), F.greatest(F.lit(0.0), F.col("amount") / 120 + F.col("local_hour") / 240)), 6)
    return evaluation.with_band(df.withColumns({"fraud_score": raw, "model_version": F.lit("v1"), "scored_at": F.col("event_timestamp")}))


SCORED_SQL = f"""SELECT transaction_id, fraud_score, {BAND.format('fraud_score')} AS risk_band, fraud_score >= 0.5 AS is_flagged FROM (SELECT transaction_id,
 round(least(0.999999, greatest(0, amount / 120 + CAST(local_hour AS DOUBLE) / 240)), 6) AS fraud_score FROM stream_transactions)"""
query("ingest_scored", SCORED_SQL)(
    lambda t: _landed(t, "scored", evaluation.scored_event(_score(_stream(t)))).select("transaction_id", "fraud_score", "risk_band", "is_flagged")
)


def _bucket_sql(key: str, interval: str, distinct: str, international: bool) -> str:
    more = ", count(*) FILTER (is_international) AS intl_count" if international else ""
    return f"""SELECT {key}, time_bucket(INTERVAL {interval}, event_timestamp) AS window_start, count(*) AS txn_count, CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS txn_amount,
 count(DISTINCT {distinct}) AS n_distinct{more} FROM stream_transactions GROUP BY 1, 2"""


def _streamed_buckets(t: Tables, make, key: str, window: str) -> DataFrame:
    """Buckets of a stream in update mode, upserted batch by batch."""
    folder = _folder(t, f"buckets-{window}")
    return jobs.upserted(make(jobs.deduplicated(_stream(t)), window), f"{folder}/table", [key, "window_start"], f"{folder}/checkpoint").read()


def _counted(buckets: DataFrame, distinct: str) -> DataFrame:
    return buckets.withColumn("n_distinct", F.size(f"{distinct}_set").cast("bigint")).drop(f"{distinct}_set")


query("user_velocity", _bucket_sql("user_id", "1 HOUR", "merchant_id", True))(lambda t: _counted(_streamed_buckets(t, jobs.user_velocity, "user_id", "1h"), "merchant_id"))
query("user_velocity_5m", _bucket_sql("user_id", "5 MINUTE", "merchant_id", True))(lambda t: _counted(jobs.user_velocity(t.raw("stream_transactions"), "5m"), "merchant_id"))
query("user_velocity_24h", _bucket_sql("user_id", "1 DAY", "merchant_id", True))(lambda t: _counted(jobs.user_velocity(t.raw("stream_transactions"), "24h"), "merchant_id"))
query("device_velocity", _bucket_sql("device_id", "1 HOUR", "user_id", False))(lambda t: _counted(_streamed_buckets(t, jobs.device_velocity, "device_id", "1h"), "user_id"))
query("device_velocity_5m", _bucket_sql("device_id", "5 MINUTE", "user_id", False))(lambda t: _counted(jobs.device_velocity(t.raw("stream_transactions"), "5m"), "user_id"))
query("velocity_merge", "SELECT user_id, count(*) AS txn_count, CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS txn_amount, count(DISTINCT merchant_id) AS n_distinct FROM stream_transactions WHERE time_bucket(INTERVAL 5 MINUTE, event_timestamp) >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY 1")(
    lambda t: jobs.velocity_merge(jobs.user_velocity(t.raw("stream_transactions"), "5m"), "user_id", "merchant_id", F.lit("2024-01-10 00:00:00").cast("timestamp"))
)


@query("velocity_merge_sketches", """SELECT device_id, count(*) AS txn_count, CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS txn_amount, count(DISTINCT merchant_id) AS n_exact, true AS close
 FROM stream_transactions WHERE time_bucket(INTERVAL 1 HOUR, event_timestamp) >= TIMESTAMP '2024-01-05 00:00:00' AND time_bucket(INTERVAL 1 HOUR, event_timestamp) < TIMESTAMP '2024-01-25 00:00:00' GROUP BY 1""")
def _(t):
    """Sketches that a stream stored with its windows, merged over a range of them, beside exact counts."""
    folder = _folder(t, "sketches")
    stream = jobs.velocity(jobs.deduplicated(_stream(t)), "device_id", "1h", "merchant_id", international=False, sketch=True)
    buckets = jobs.upserted(stream, f"{folder}/table", ["device_id", "window_start"], f"{folder}/checkpoint", buckets=8).read()
    since, until = (F.lit(f"2024-01-{day} 00:00:00").cast("timestamp") for day in ("05", "25"))
    merged = jobs.velocity_merge_sketches(buckets, "device_id", "merchant_id", since, until)
    plain = t.raw("stream_transactions").where((F.col("event_timestamp") >= since) & (F.col("event_timestamp") < until))
    exact = plain.groupBy("device_id").agg(F.count_distinct("merchant_id").alias("n_exact"))
    close = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.ceil(jobs.SKETCH_ERROR * F.col("n_exact"))
    return merged.join(exact, "device_id").select("device_id", "txn_count", "txn_amount", "n_exact", close.alias("close"))


@query("stream_dedup", "SELECT transaction_id, user_id, amount FROM stream_transactions")
def _(t):
    folder, stream = _folder(t, "dedup"), _stream(t)
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = jobs.deduplicated(twice).select("transaction_id", "user_id", "amount")
    once.writeStream.format("parquet").option("path", f"{folder}/table").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{folder}/table")


def _parity(t: Tables, lost: str = "false") -> DataFrame:
    """Hourly buckets of the stream against its sliding hour at each bucket's end, joined as streams. lost: a condition of transactions
    that do not reach the sliding state."""
    folder = _folder(t, "parity")
    far, rows = F.lit("2100-01-01").cast("timestamp"), t.txns.select("transaction_id", "user_id", "merchant_id", "amount", "is_international", "event_timestamp")
    last, n = rows.agg(F.max("event_timestamp"), F.count("*")).first()
    # A row of the far future moves the watermark past all ends; the condition on the time keeps it out behind the watermark.
    end = t.spark.range(1).select(*(F.lit({"event_timestamp": far, "user_id": "end"}.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema))
    stream = _batches(t, [rows.where("event_timestamp < TIMESTAMP '2024-01-12 00:00:00'"), rows.where("event_timestamp >= TIMESTAMP '2024-01-12 00:00:00'"), end], n // 2)
    before = F.col("event_timestamp") <= F.lit(last)
    sides = {
        "buckets": jobs.finished_velocity(stream.withWatermark("event_timestamp", "10 minutes").where(before), "user_id", "merchant_id"),
        "sliding": jobs.sliding_at_ends(stream.withWatermark("event_timestamp", "10 minutes").where(before & ~F.expr(lost)), "user_id"),
    }
    with jobs.settings(t.spark, jobs.ROCKSDB):
        for name, side in sides.items():
            jobs.landed_run(side, f"{folder}/{name}", f"{folder}/{name}-checkpoint")
        landed = [t.spark.readStream.schema(side.schema).parquet(f"{folder}/{name}") for name, side in sides.items()]
        jobs.landed_run(jobs.parity_rows(*landed), f"{folder}/both", f"{folder}/both-checkpoint")
    return jobs.velocity_parity(t.spark.read.parquet(f"{folder}/both"))


query("velocity_parity", "SELECT count(*) AS n, CAST(0 AS DOUBLE) AS off_rate FROM (SELECT DISTINCT user_id, time_bucket(INTERVAL 1 HOUR, event_timestamp) FROM stg_transactions)")(_parity)


def _sliding(t: Tables, logins: bool, key: str = "user_id") -> DataFrame:
    """The sliding state over the stream of transactions (and failed logins)."""
    folder, common = _folder(t, "sliding"), ["transaction_id", key, "merchant_id", "amount", "is_login", "event_timestamp"]
    events = _stream(t).where("amount > 0").withColumn("is_login", F.lit(False)).select(common)
    if logins:
        failed = _stream(t, "raw_login_events").where("lower(trim(login_status)) = 'failed'")
        failed = failed.select(F.lit(None).cast("string").alias("transaction_id"), key, F.lit(None).cast("string").alias("merchant_id"), F.lit(0.0).alias("amount"), F.lit(True).alias("is_login"), "event_timestamp")
        events = events.unionByName(failed)
    with jobs.settings(t.spark, jobs.ROCKSDB):
        return jobs.upserted(jobs.sliding_features(events, key), f"{folder}/table", ["key", "transaction_id"], f"{folder}/checkpoint").read()


EVENTS_SQL = f"(SELECT transaction_id, user_id, device_id, merchant_id, amount, {sec()} AS s FROM stream_transactions WHERE amount > 0)"
FAILED_SQL = f"(SELECT user_id, {sec()} AS s FROM raw_login_events WHERE lower(trim(login_status)) = 'failed')"
STATE = [f"{c}_{w}" for c in ("txn_count", "txn_amount_sum", "distinct_merchants") for w in ("5m", "10m", "1h")]


def _state_sql(entity: str) -> str:
    """What each transaction sees of its key's transactions up to itself: those of an hour ago are gone."""
    parts = ", ".join(
        f"count(*) FILTER (p.s >= t.s - {n}) AS txn_count_{w}, round(coalesce(sum(p.amount) FILTER (p.s >= t.s - {n}), 0), 4) AS txn_amount_sum_{w}, count(DISTINCT p.merchant_id) FILTER (p.s >= t.s - {n}) AS distinct_merchants_{w}" for w, n in SHORT
    )
    return f"""SELECT '{entity}' AS entity, t.{entity}_id AS key, t.transaction_id, {parts} FROM {EVENTS_SQL} t
 JOIN {EVENTS_SQL} p ON p.{entity}_id = t.{entity}_id AND p.s > t.s - 3600 AND (p.s < t.s OR p.s = t.s AND p.transaction_id <= t.transaction_id) GROUP BY ALL"""


@query("sliding_state", f"SELECT entity, key, transaction_id, {', '.join(STATE)} FROM ({_state_sql('user')} UNION ALL BY NAME {_state_sql('device')})")
def _(t):
    parts = [_sliding(t, False, f"{e}_id").select(F.lit(e).alias("entity"), "key", "transaction_id", *STATE) for e in ("user", "device")]
    return parts[0].unionByName(parts[1])


query("login_failure_state", f"""SELECT t.user_id AS key, t.transaction_id, count(DISTINCT l.s) FILTER (l.s >= t.s - 900) AS failed_logins_15m, count(DISTINCT l.s) AS failed_logins_1h
 FROM {EVENTS_SQL} t LEFT JOIN {FAILED_SQL} l ON l.user_id = t.user_id AND l.s > t.s - 3600 AND l.s <= t.s GROUP BY ALL""")(
    lambda t: _sliding(t, True).select("key", "transaction_id", "failed_logins_15m", "failed_logins_1h")
)


STREAM_FEATURES = ["amount", "local_hour", "user_txn_count_30d", "user_avg_ticket_30d", "device_txn_count_7d"]
_LATEST = "QUALIFY row_number() OVER (PARTITION BY {0} ORDER BY event_timestamp DESC, transaction_id DESC) = 1"
#: Gaussian naive Bayes with equal weight for both classes (variances raised by 1e-9 of the largest, as the library does), fitted on the
#: stream's transactions.
STREAM_MODEL_SQL = f"""WITH users AS (SELECT * FROM int_user_txn WHERE event_timestamp <= TIMESTAMP '2024-01-20 00:00:00' {_LATEST.format('user_id')}),
 devices AS (SELECT * FROM int_device WHERE event_timestamp <= TIMESTAMP '2024-01-20 00:00:00' {_LATEST.format('device_id')}),
 inputs AS (SELECT t.transaction_id, CAST(t.amount AS DOUBLE) AS amount, CAST(t.local_hour AS DOUBLE) AS local_hour, CAST(coalesce(u.user_txn_count_30d, 0) AS DOUBLE) AS user_txn_count_30d,
  coalesce(u.user_avg_ticket_30d, 0) AS user_avg_ticket_30d, CAST(coalesce(d.device_txn_count_7d, 0) AS DOUBLE) AS device_txn_count_7d
  FROM stream_transactions t LEFT JOIN users u USING (user_id) LEFT JOIN devices d USING (device_id) WHERE t.amount > 0),
 long AS (UNPIVOT inputs ON amount, local_hour, user_txn_count_30d, user_avg_ticket_30d, device_txn_count_7d INTO NAME feature VALUE x),
 means AS (SELECT feature, is_fraud, avg(x) AS m, avg(x * x) AS q FROM long JOIN labelled USING (transaction_id) GROUP BY 1, 2),
 told AS (SELECT feature, is_fraud, m, q - m * m + (SELECT 1e-9 * max(v) FROM (SELECT avg(q) - avg(m) * avg(m) AS v FROM means GROUP BY feature)) AS v FROM means),
 sums AS (SELECT transaction_id, is_fraud, sum(-0.5 * ln(2 * pi() * v) - (x - m) * (x - m) / (2 * v)) AS s FROM long JOIN told USING (feature) GROUP BY 1, 2),
 chances AS (SELECT transaction_id, 1 / (1 + exp(sum(CASE WHEN is_fraud = 0 THEN s ELSE -s END))) AS fraud_score FROM sums GROUP BY 1)"""


def _stream_scorer(t: Tables, kind: str = "gaussian") -> scoring.StreamScorer:
    """Snapshots of users and devices as of a day, and a model fitted on transactions with these snapshots' features."""
    folder, day = _folder(t, "snapshots"), F.lit("2024-01-20 00:00:00").cast("timestamp")
    stores = {}
    for key, made in (("user_id", features.user_txn_stats(t.txns)), ("device_id", features.device_stats(t.txns, "sweep"))):
        rows = serving.materialize_latest(made, key, end=day).select(key, *(c for c in STREAM_FEATURES if c in made.columns))
        stores[key] = store_module.KeyedStore(t.spark, f"{folder}/{key}", rows.schema, [key], buckets=8)
        stores[key].merge(rows, 0)
    empty = scoring.StreamScorer(STREAM_FEATURES, None, None, stores)
    txns = t.raw("stream_transactions").where("amount > 0").select("transaction_id", "user_id", "device_id", "amount", "local_hour")
    rows = features.with_labels(empty.with_features(txns), t.labels)
    assembler, model = evaluation.train_classifier(rows, STREAM_FEATURES, kind=kind, trees=5, depth=3)
    return replace(empty, assembler=assembler, model=model)


def _scored_stream(t: Tables, scorer: scoring.StreamScorer) -> tuple[DataFrame, int]:
    """(scored rows, the number of those that could not be scored, as it was observed) of a run over several batches."""
    folder = _folder(t, "scored")
    stream = jobs.observed(_stream(t), "scored", F.col("amount") > 0)
    counts = jobs.counted_run(stream, scorer.sink(f"{folder}/table"), f"{folder}/checkpoint")
    return jobs.read_apart(t.spark, f"{folder}/table", True), counts.totals["scored"]["bad"]


@query("scored_stream", STREAM_MODEL_SQL + f""" SELECT CAST(NULL AS BIGINT) AS n_failed, transaction_id, fraud_score, {BAND.format('fraud_score')} AS risk_band, fraud_score >= 0.5 AS is_flagged FROM (SELECT transaction_id, round(fraud_score, 6) AS fraud_score FROM chances)
 UNION ALL SELECT count(*), NULL, NULL, NULL, NULL FROM stream_transactions WHERE amount <= 0""")
def _(t):
    """A fitted model on a stream, with features of users and devices looked up for each batch; rows that cannot be scored land apart
    and are counted while the stream runs."""
    landed, failed = _scored_stream(t, _stream_scorer(t))
    rows = evaluation.scored_event(landed).select("transaction_id", "fraud_score", "risk_band", "is_flagged")
    return rows.unionByName(t.spark.range(1).select(F.lit(failed).cast("bigint").alias("n_failed")), allowMissingColumns=True)


@query("kafka_txn_source", "SELECT transaction_id, amount, channel FROM stream_transactions")
def _(t):
    """Values come as a stream of lines here; from topics the same job reads them as they are."""
    folder = _folder(t, "topics")
    _values(t).select("value").write.text(f"{folder}/values")
    good, _ = tables.decode(tables.kafka_txn_source(t.spark, "", format="text", path=f"{folder}/values"))
    return _landed(t, "decoded", good).select("transaction_id", "amount", "channel")


@query("kafka_sink_scored", SCORED_SQL.replace("SELECT transaction_id, fraud_score", "SELECT 'txn.scored' AS topic, transaction_id, fraud_score"))
def _(t):
    folder = _folder(t, "published")
    values = tables.scored_values(evaluation.scored_event(_score(_stream(t))))
    tables.kafka_sink(values, "", f"{folder}/checkpoint", "parquet", f"{folder}/values").trigger(availableNow=True).start().awaitTermination()
    kinds = (("transaction_id", "string"), ("fraud_score", "double"), ("risk_band", "string"), ("is_flagged", "boolean"))
    return t.spark.read.parquet(f"{folder}/values").select("topic", *(F.get_json_object("value", f"$.{c}").cast(kind).alias(c) for c, kind in kinds))


# --- training sets and evaluation ------------------------------------------------------------------------------------


def _scored(t: Tables) -> DataFrame:
    return monitoring.labelled(t.scores, t.labels)


query("hash_sample", "SELECT transaction_id FROM stg_transactions WHERE substr(md5(transaction_id), 1, 8) < '40000000'")(lambda t: evaluation.hash_sample(t.txns, 0.25).select("transaction_id"))
query("class_balance", "SELECT count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_fraud, sum(is_fraud) / count(*) AS fraud_rate, (count(*) - sum(is_fraud)) / greatest(sum(is_fraud), 1) AS pos_weight FROM labelled")(lambda t: evaluation.class_balance(features.with_labels(t.txns, t.labels)))
query("fill_missing", "SELECT transaction_id, coalesce(CAST(is_international AS DOUBLE), 0) AS is_international, CAST(0 AS DOUBLE) AS not_there FROM raw_transactions")(
    lambda t: evaluation.fill_missing(t.raw("raw_transactions").select("transaction_id", F.col("is_international").cast("int").alias("is_international")), ["is_international", "not_there"])
)
CUT = "(SELECT event_timestamp FROM {0} ORDER BY event_timestamp OFFSET (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM {0}) LIMIT 1)"
SPLIT_SQL = f"SELECT transaction_id, event_timestamp, CASE WHEN event_timestamp < {CUT.format('stg_transactions')} THEN 'train' ELSE 'oot' END AS part FROM stg_transactions"
query("temporal_split", SPLIT_SQL)(lambda t: evaluation.temporal_split(t.txns).select("transaction_id", "event_timestamp", "part"))
query("stratified_split", "SELECT transaction_id, CASE WHEN row_number() OVER (PARTITION BY is_fraud ORDER BY md5(concat('42', transaction_id)), transaction_id) <= floor(0.8 * count(*) OVER (PARTITION BY is_fraud)) THEN 'train' ELSE 'test' END AS part FROM labelled")(
    lambda t: evaluation.stratified_split(features.with_labels(t.txns.select("transaction_id"), t.labels)).select("transaction_id", "part")
)
query("calibration_carve", f"SELECT transaction_id, CASE WHEN part = 'train' AND event_timestamp >= {CUT.format(f'(SELECT * FROM ({SPLIT_SQL}) WHERE part = {chr(39)}train{chr(39)})')} THEN 'calibration' ELSE part END AS part FROM ({SPLIT_SQL})")(
    lambda t: evaluation.calibration_carve(evaluation.temporal_split(t.txns)).select("transaction_id", "part")
)


@query("numeric_scaling", """SELECT transaction_id, round((CAST(amount AS DOUBLE) - m) / s, 6) AS standard, round((CAST(amount AS DOUBLE) - lo) / (hi - lo), 6) AS minmax, round((CAST(amount AS DOUBLE) - q2) / (q3 - q1), 6) AS robust
 FROM stg_transactions, (SELECT avg(CAST(amount AS DOUBLE)) AS m, stddev_pop(CAST(amount AS DOUBLE)) AS s, CAST(min(amount) AS DOUBLE) AS lo, CAST(max(amount) AS DOUBLE) AS hi, quantile_cont(CAST(amount AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(amount AS DOUBLE), 0.5) AS q2, quantile_cont(CAST(amount AS DOUBLE), 0.75) AS q3 FROM stg_transactions WHERE txn_status = 'success')""")
def _(t):
    df = t.txns.select("transaction_id", "txn_status", *(F.col("amount").cast("double").alias(m) for m in ("standard", "minmax", "robust")))
    train = df.where("txn_status = 'success'")
    for method in ("standard", "minmax", "robust"):
        df = evaluation.numeric_scaling(df, train, [method], method)
    return df.select("transaction_id", *(F.round(m, 6).alias(m) for m in ("standard", "minmax", "robust")))


@query("categorical_encoding", "SELECT transaction_id, CAST(CASE currency WHEN 'EUR' THEN 0 WHEN 'USD' THEN 1 ELSE -1 END AS INTEGER) AS currency_code, CAST(payment_method = 'card' AS INTEGER) AS payment_method_card, CAST(payment_method = 'wallet' AS INTEGER) AS payment_method_wallet FROM stg_transactions")
def _(t):
    df = evaluation.categorical_encoding(t.txns, t.txns.where("currency <> 'GBP'"), "currency")
    df = evaluation.categorical_encoding(df, t.txns.where("payment_method <> 'bank_transfer'"), "payment_method", "onehot")
    return df.select("transaction_id", F.col("currency_code").cast("int").alias("currency_code"), "payment_method_card", "payment_method_wallet")


MODEL_FEATURES = ["txn_amount", "local_hour", "user_txn_count_7d", "user_txn_amount_sum_7d", "device_txn_count_1d", "merchant_avg_ticket_30d"]


def _trained(t: Tables):
    """(rows with part, their features, assembler, model), fitted on the train part."""
    rows = evaluation.fill_missing(t.training(), MODEL_FEATURES).select("transaction_id", "event_timestamp", "is_fraud", *MODEL_FEATURES)
    # Stored before they are split: the search for the cutoff reads the rows' times three times, and would lay all windows anew each time.
    rows = evaluation.temporal_split(tables.full_refresh(rows, _folder(t, "learned"))).select("transaction_id", "part", "is_fraud", *MODEL_FEATURES)
    return rows, *evaluation.train_classifier(rows.where("part = 'train'"), MODEL_FEATURES, trees=5, depth=3)


def _predicted(rows: DataFrame, assembler, model) -> DataFrame:
    out = evaluation.scored(rows, MODEL_FEATURES, assembler, model)
    return out.select("transaction_id", "part", F.col("is_fraud").alias("label"), F.col("fraud_score").alias("score"))


@query("train_classifier")
def _(t):
    rows, assembler, model = _trained(t)
    return evaluation.ranking_metrics(_predicted(rows, assembler, model).where("part = 'oot'"))


@query("top_importances")
def _(t):
    rows, assembler, model = _trained(t)
    return evaluation.top_importances(t.spark, MODEL_FEATURES, model)


@query("score_batch")
def _(t):
    rows, assembler, model = _trained(t)
    scored = _predicted(rows, assembler, model)
    grid = evaluation.calibration_grid(scored.where("part = 'train'").select("score", "label"))
    out = scored.where("part = 'oot'").withColumn("fraud_score", evaluation.apply_calibration(F.col("score"), *grid))
    return evaluation.with_band(out).select("transaction_id", "fraud_score", "risk_band", "is_flagged")


@query("backtest")
def _(t):
    rows, assembler, model = _trained(t)
    missing = [f for f in MODEL_FEATURES if f not in rows.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    scored = _predicted(rows, assembler, model)
    oot, train = scored.where("part = 'oot'"), scored.where("part = 'train'")
    ranks = evaluation.ranking_metrics(oot).select(F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in ("roc_auc", "pr_auc")))))
    parts = [ranks, evaluation.brier(oot).select(F.lit("brier").alias("metric"), F.col("brier").alias("value")), evaluation.ece(oot).select(F.lit("ece").alias("metric"), F.col("ece").alias("value"))]
    parts.append(monitoring.psi(train.select("score"), oot.select("score"), ["score"]).select(F.lit("psi").alias("metric"), F.col("psi").alias("value")))
    for least, band in evaluation.BANDS:
        wide = evaluation.confusion(oot, least)
        parts.append(wide.select(F.inline(F.array(*(F.struct(F.lit(f"{c}_{band}").alias("metric"), F.col(c).cast("double").alias("value")) for c in ("tn", "fp", "fn", "tp"))))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


TENTH_SQL = "floor({0} * 10) / 10"


@query("calibrate_scores", f"""SELECT transaction_id, round(y, 6) AS calibrated FROM score_log JOIN (
  SELECT x, max(low) AS y FROM (SELECT k.x AS x, p.i, min(p.mean) AS low FROM bins k JOIN runs p ON p.i <= k.x AND p.j >= k.x GROUP BY k.x, p.i) GROUP BY x) ON x = {TENTH_SQL.format('fraud_score')}""")
def _(t):
    """Isotonic regression of the labels on tenths of scores; in the SQL a tenth's value is the greatest least mean of runs of
    tenths around it."""
    tenth = F.floor(F.col("score") * 10) / 10
    grid = evaluation.calibration_grid(_scored(t).select(tenth.alias("score"), F.col("label").cast("double").alias("label")), points=11)
    return t.scores.select("transaction_id", F.round(evaluation.apply_calibration(F.floor(F.col("fraud_score") * 10) / 10, *grid), 6).alias("calibrated"))


ORACLES["calibrate_scores"] = ORACLES["calibrate_scores"].replace(f"{WITH}\n", f"""{WITH},
bins AS (SELECT {TENTH_SQL.format('score')} AS x, sum(label) AS y, count(*) AS n FROM scored GROUP BY 1),
runs AS (SELECT i.x AS i, j.x AS j, sum(b.y) / sum(b.n) AS mean FROM bins i JOIN bins j ON i.x <= j.x JOIN bins b ON b.x BETWEEN i.x AND j.x GROUP BY 1, 2)
""")
query("choose_threshold", "SELECT coalesce(max_by(score, (precision, score)), 0.5) AS threshold FROM (SELECT score, tp / (tp + fp) AS precision, tp / pos AS recall FROM points) WHERE recall >= 0.8")(lambda t: evaluation.choose_threshold(_scored(t)))
query("pr_curve", "SELECT score, round(tp / (tp + fp), 9) AS precision, round(tp / pos, 9) AS recall FROM points")(
    lambda t: evaluation.curve(_scored(t)).select("score", F.round(F.col("tp") / (F.col("tp") + F.col("fp")), 9).alias("precision"), F.round(F.col("tp") / F.col("pos"), 9).alias("recall"))
)
RANK_SQL = "round(sum(p * (neg - fp + n / 2)) / max(pos * neg), 9) AS roc_auc, round(sum(p * (tp / (tp + fp))) / max(pos), 9) AS pr_auc"
query("roc_auc", f"SELECT {RANK_SQL}, round(coalesce(max(tp / pos) FILTER (tp / (tp + fp) >= 0.5), 0), 9) AS recall_at_precision FROM points")(lambda t: evaluation.ranking_metrics(_scored(t)))
query("pr_auc", f"SELECT pr_auc FROM (SELECT {RANK_SQL} FROM points)")(lambda t: evaluation.ranking_metrics(_scored(t)).select("pr_auc"))
query("confusion_at_threshold", "SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall FROM (SELECT count(*) FILTER (score < 0.5 AND label = 0) AS tn, count(*) FILTER (score >= 0.5 AND label = 0) AS fp, count(*) FILTER (score < 0.5 AND label = 1) AS fn, count(*) FILTER (score >= 0.5 AND label = 1) AS tp FROM scored)")(lambda t: evaluation.confusion(_scored(t), 0.5))
query("brier_score", "SELECT round(avg((score - label) * (score - label)), 9) AS brier FROM scored")(lambda t: evaluation.brier(_scored(t)))
query("ece", "SELECT round(sum(CASE WHEN bin < 10 THEN n * abs(a - c) ELSE 0 END) / sum(n), 9) AS ece FROM (SELECT floor(score * 10) AS bin, count(*) AS n, avg(score) AS c, avg(label) AS a FROM scored GROUP BY 1)")(lambda t: evaluation.ece(_scored(t)))
query("reliability_bins", "SELECT CAST(floor(score * 10) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 9) AS mean_score, round(avg(label), 9) AS fraud_rate FROM scored WHERE score < 1 GROUP BY 1")(lambda t: evaluation.reliability_bins(_scored(t)))
query("risk_band", f"SELECT transaction_id, {BAND.format('fraud_score')} AS risk_band FROM score_log")(lambda t: t.scores.select("transaction_id", evaluation.risk_band(F.col("fraud_score")).alias("risk_band")))
query("scored_event", f"SELECT s.transaction_id, s.user_id, s.device_id, s.merchant_id, x.channel, x.amount, x.is_international, s.event_timestamp, s.fraud_score, {BAND.format('s.fraud_score')} AS risk_band, s.fraud_score >= 0.5 AS is_flagged, s.model_version, 'fraud_scoring_v1' AS feature_service_version, s.scored_at FROM score_log s JOIN stream_transactions x USING (transaction_id)")(
    lambda t: evaluation.scored_event(evaluation.with_band(t.scores.join(t.raw("stream_transactions").select("transaction_id", "channel", "amount", "is_international"), "transaction_id")))
)

# --- monitoring ------------------------------------------------------------------------------------------------------

_now = lambda: F.lit(NOW).cast("timestamp")
NOW_SQL = f"{sec(f'CAST({chr(39)}{NOW}{chr(39)} AS TIMESTAMP)')}"
AGE = f"({NOW_SQL} - {sec('scored_at')})"


@query("append_score_log", "SELECT transaction_id, model_version, fraud_score FROM score_log WHERE NOT (CAST(substr(transaction_id, 3) AS BIGINT) % 3 = 0)")
def _(t):
    stored = t.scores.where(F.substring("transaction_id", 3, 20).cast("bigint") % 3 == 0)
    later = t.scores.withColumns({"scored_at": F.col("scored_at") + F.expr("INTERVAL 1 MINUTE"), "fraud_score": F.lit(0.0)})
    return monitoring.append_score_log(t.scores.unionByName(later), stored).select("transaction_id", "model_version", "fraud_score")


@query("append_feature_log", "SELECT transaction_id, coalesce(CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 5 <> 0 THEN user_txn_count_1h END, 0) AS user_txn_count_1h FROM int_user_online WHERE CAST(substr(transaction_id, 3) AS BIGINT) % 3 <> 0")
def _(t):
    number = F.substring("transaction_id", 3, 20).cast("bigint")
    online = features.user_txn_online_stats(t.txns).select("transaction_id", F.when(number % 5 != 0, F.col("user_txn_count_1h")).alias("user_txn_count_1h"), F.col("event_timestamp").alias("scored_at"))
    return monitoring.append_feature_log(online, online.where(number % 3 == 0), ["user_txn_count_1h"]).select("transaction_id", "user_txn_count_1h")


query("recent_scores", "SELECT transaction_id, fraud_score, scored_at FROM score_log WHERE fraud_score >= 0.8 AND model_version = 'v1' ORDER BY scored_at DESC, transaction_id LIMIT 50")(
    lambda t: monitoring.recent_scores(t.scores, 50, F.col("fraud_score") >= 0.8, F.col("model_version") == "v1").select("transaction_id", "fraud_score", "scored_at")
)
BANDS_SQL = ", ".join(f"count(*) FILTER (a >= 0 AND a < {d * 86400} AND b = '{b}') AS {b}_{d}d" for d in (1, 7, 30) for b in ("low", "medium", "high", "critical"))
query("score_kpis", f"""SELECT count(*) FILTER (d) AS scored_24h, round(avg(CASE WHEN fraud_score >= 0.5 THEN 1.0 ELSE 0.0 END) FILTER (d), 9) AS flagged_24h, round(avg(CASE WHEN b = 'critical' THEN 1.0 ELSE 0.0 END) FILTER (d), 9) AS critical_24h,
 round(avg(fraud_score) FILTER (d), 9) AS mean_score_24h, quantile_cont(CAST(latency_ms AS DOUBLE), 0.95) FILTER (d) AS p95_latency_24h,
 round(avg(CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 10 <> 0 THEN 1.0 ELSE 0.0 END) FILTER (d), 9) AS feast_offline_ok_24h, round(avg(CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 20 <> 3 THEN 1.0 ELSE 0.0 END) FILTER (d), 9) AS redis_online_ok_24h, {BANDS_SQL}
 FROM (SELECT *, {AGE} AS a, {AGE} >= 0 AND {AGE} < 86400 AS d, {BAND.format('fraud_score')} AS b FROM score_log) WHERE a >= 0 AND a < 2592000""")(
    lambda t: monitoring.score_kpis(t.scores.withColumns({"feast_offline_ok": F.substring("transaction_id", 3, 20).cast("bigint") % 10 != 0, "redis_online_ok": F.substring("transaction_id", 3, 20).cast("bigint") % 20 != 3}), _now())
)
query("hourly_flag_rate", f"SELECT date_trunc('hour', scored_at) AS hour, count(*) AS n, round(avg(CASE WHEN fraud_score >= 0.5 THEN 1.0 ELSE 0.0 END), 9) AS flag_rate FROM score_log WHERE {AGE} >= 0 AND {AGE} < 172800 GROUP BY 1")(lambda t: monitoring.hourly_flag_rate(t.scores, _now()))
DAILY_SQL = ", ".join([
    *(f"round(quantile_cont(CAST(latency_ms AS DOUBLE), {p / 100}), 9) AS p{p}_latency" for p in (50, 95, 99)),
    *(f"count(*) FILTER (floor(fraud_score * 10) = {i}) AS bin_{i}" for i in range(10)),
    *(f"count(*) FILTER (b = '{b}') AS n_{b}" for b in ("low", "medium", "high", "critical")),
])
query("score_snapshot_daily", f"SELECT model_version, CAST(scored_at AS DATE) AS day, count(*) AS n, round(avg(fraud_score), 9) AS mean_score, round(stddev_pop(fraud_score), 9) AS std_score, round(avg(CASE WHEN fraud_score > 0.5 THEN 1.0 ELSE 0.0 END), 9) AS share_over_50, round(avg(CASE WHEN fraud_score > 0.8 THEN 1.0 ELSE 0.0 END), 9) AS share_over_80, {DAILY_SQL} FROM (SELECT *, {BAND.format('fraud_score')} AS b FROM score_log) GROUP BY 1, 2")(lambda t: monitoring.score_snapshot_daily(t.scores))


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows, cut = t.txns.select("event_timestamp", F.col("amount").cast("double").alias("amount"), "local_hour"), F.lit("2024-01-15 00:00:00").cast("timestamp")
    return rows.where(F.col("event_timestamp") < cut), rows.where(F.col("event_timestamp") >= cut)


DRIFT_BASE = "SELECT 'amount' AS feature, CAST(amount AS DOUBLE) AS value, event_timestamp < TIMESTAMP '2024-01-15 00:00:00' AS old FROM stg_transactions UNION ALL SELECT 'local_hour', CAST(local_hour AS DOUBLE), event_timestamp < TIMESTAMP '2024-01-15 00:00:00' FROM stg_transactions"
PSI_SQL = f"""SELECT feature, round(sum((p - q) * ln(p / q)), 6) AS psi FROM (
 SELECT feature, greatest(count(*) FILTER (NOT old) / max(nc), 1e-6) AS p, greatest(count(*) FILTER (old) / max(nr), 1e-6) AS q FROM (
  SELECT b.feature, b.old, len([e FOR e IN edges IF e < value]) AS bin, sum(CASE WHEN old THEN 1 ELSE 0 END) OVER (PARTITION BY b.feature) AS nr, sum(CASE WHEN old THEN 0 ELSE 1 END) OVER (PARTITION BY b.feature) AS nc
  FROM ({DRIFT_BASE}) b JOIN (SELECT feature, list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM ({DRIFT_BASE}) WHERE old GROUP BY 1) e USING (feature)) GROUP BY feature, bin) GROUP BY 1"""
query("psi", PSI_SQL)(lambda t: monitoring.psi(*_halves(t), ["amount", "local_hour"]))
query("ks_statistic", f"SELECT feature, round(max(abs(cr / nr - cc / nc)), 9) AS ks FROM (SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY feature) AS nr, sum(c) OVER (PARTITION BY feature) AS nc FROM (SELECT feature, value, count(*) FILTER (old) AS r, count(*) FILTER (NOT old) AS c FROM ({DRIFT_BASE}) GROUP BY 1, 2) WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY 1")(lambda t: monitoring.ks_statistic(*_halves(t), ["amount", "local_hour"]))


@query("drift_alerts", f"SELECT feature, psi, CASE WHEN psi > 0.2 THEN 'severe' WHEN psi >= 0.1 THEN 'moderate' ELSE 'none' END AS level FROM ({PSI_SQL})")
def _(t):
    old, new = _halves(t)
    return monitoring.drift_alerts(monitoring.psi(old, new, ["amount", "local_hour"]), new.count())


@query("retrain_rule", f"SELECT count(*) FILTER (psi >= 0.0005) AS critical_features, count(*) FILTER (psi >= 0.0005) >= 2 AS retrain FROM ({PSI_SQL})")
def _(t):
    """The rule that asks for a new model once enough features have drifted, with bounds low enough for this data."""
    old, new = _halves(t)
    alerts = monitoring.drift_alerts(monitoring.psi(old, new, ["amount", "local_hour"]), new.count())
    return monitoring.retrain(alerts, critical=0.0005, least=2)


def _ranks_sql(rows: str, by: str) -> str:
    return f"""SELECT {by}, {RANK_SQL} FROM (SELECT {by}, score, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY {by}) AS pos, sum(n) OVER (PARTITION BY {by}) AS neg FROM (
 SELECT {by}, score, sum(label) AS p, count(*) - sum(label) AS n FROM ({rows}) GROUP BY 1, 2) WINDOW w AS (PARTITION BY {by} ORDER BY score DESC)) GROUP BY 1"""


LAST30 = f"SELECT CAST(scored_at AS DATE) AS day, score, label FROM scored WHERE {AGE} >= 0 AND {AGE} < 2592000"
query("labelled_performance", f"SELECT * FROM (SELECT day, count(*) AS n, round(avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END), 9) AS flag_rate FROM ({LAST30}) GROUP BY 1) JOIN ({_ranks_sql(LAST30, 'day')}) USING (day)")(lambda t: monitoring.labelled_performance(t.scores, t.labels, _now()))
query("label_feedback", f"""SELECT CAST(scored_at AS DATE) AS day, count(*) AS n, round(avg(CASE WHEN is_fraud IS NULL THEN 0.0 ELSE 1.0 END), 9) AS coverage,
 round(quantile_cont(({sec('label_timestamp')} - {sec('scored_at')}) / 3600, 0.5), 6) AS median_lag_hours, round(avg(CASE WHEN is_fraud THEN 0.0 ELSE 1.0 END) FILTER (fraud_score >= 0.5 AND is_fraud IS NOT NULL), 9) AS false_alarm_rate
 FROM score_log LEFT JOIN (SELECT transaction_id, is_fraud, label_timestamp FROM stg_fraud_labels) USING (transaction_id) GROUP BY 1""")(lambda t: monitoring.label_feedback(t.scores, t.labels))
BOTH_SQL = "SELECT 'champion' AS model, score, label FROM scored UNION ALL SELECT 'challenger', 1 - score, label FROM scored"


@query("model_comparison", f"SELECT *, model = 'challenger' AND max(pr_auc) FILTER (model = 'challenger') OVER () > 1.05 * max(pr_auc) FILTER (model = 'champion') OVER () AS promote FROM (SELECT model, count(*) AS n, round(avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END), 9) AS flag_rate FROM ({BOTH_SQL}) GROUP BY 1) JOIN ({_ranks_sql(BOTH_SQL, 'model')}) USING (model)")
def _(t):
    return monitoring.model_comparison(t.scores, t.scores.withColumn("fraud_score", 1 - F.col("fraud_score")), t.labels)


@query("training_serving_skew", "SELECT 'user_txn_count_1h' AS feature, count(*) AS n, round(avg(CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 4 = 0 THEN 1.0 ELSE 0.0 END), 9) AS mismatch_rate FROM int_user_online UNION ALL SELECT 'user_txn_amount_sum_1h', count(*), CAST(0 AS DOUBLE) FROM int_user_online")
def _(t):
    columns = ["user_txn_count_1h", "user_txn_amount_sum_1h"]
    online = features.user_txn_online_stats(t.txns).select("transaction_id", *columns)
    served = online.withColumn("user_txn_count_1h", F.col("user_txn_count_1h") + F.when(F.substring("transaction_id", 3, 20).cast("bigint") % 4 == 0, 1).otherwise(0))
    return monitoring.training_serving_skew(served, online, columns)


FRESH = ["device_txn_count_7d", "device_txn_count_1d"]
query("feature_freshness", " UNION ALL ".join(f"SELECT 'device' AS view_name, '{c}' AS feature, max(event_timestamp) AS newest, {NOW_SQL} - max({sec()}) > 172800 AS stale, CAST(0 AS DOUBLE) AS null_rate, " + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), 0.{p}), 6) AS p{p}" for p in (25, 50, 75)) + " FROM int_device" for c in FRESH))(
    lambda t: monitoring.feature_freshness({"device": (features.device_stats(t.txns), FRESH)}, _now(), 86400)
)
query("top_risky", "SELECT CAST(scored_at AS DATE) AS day, transaction_id, fraud_score, CAST(row_number() OVER (PARTITION BY CAST(scored_at AS DATE) ORDER BY fraud_score DESC, transaction_id) AS INTEGER) AS place FROM score_log QUALIFY place <= 10")(lambda t: monitoring.top_risky(t.scores).select("day", "transaction_id", "fraud_score", "place"))
query("score_detail", "SELECT s.transaction_id, s.fraud_score, f.user_txn_count_1h FROM score_log s LEFT JOIN int_user_online f USING (transaction_id)")(
    lambda t: monitoring.score_detail(t.scores, features.user_txn_online_stats(t.txns)).select("transaction_id", "fraud_score", "user_txn_count_1h")
)


@query("log_retention", f"SELECT transaction_id, scored_at FROM score_log WHERE date_diff('day', CAST(scored_at AS DATE), DATE '{NOW[:10]}') < 7")
def _(t):
    """Day partitions of a table, dropped without rewriting what stays."""
    folder = _folder(t, "log")
    database = f"log_{folder.rsplit('-', 1)[1]}"
    catalog.day_database(t.spark, database, folder)
    catalog.append_days(t.scores.select("transaction_id", "scored_at"), f"{database}.scores", "scored_at")
    catalog.drop_days(t.spark, f"{database}.scores", datetime.fromisoformat(NOW), 7)
    return t.spark.table(f"{database}.scores").select("transaction_id", "scored_at")


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES
