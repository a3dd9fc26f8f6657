"""Point-in-time features per user, device and merchant, and the labelled training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudfeatures.operators.windows import Rolling, parse_window, rolling, seconds, windows_of
from fraudfeatures.sources.work import stored

M5, M10, M15, H1 = (seconds("MINUTE", n) for n in (5, 10, 15, 60))
D1, D7, D30 = (seconds("DAY", n) for n in (1, 7, 30))
ID = ["transaction_id"]
KEYS = ["transaction_id", "user_id", "device_id", "merchant_id", "event_timestamp"]


def user_txn_columns(only: str | None = None) -> list[Rolling]:
    """only: a flag column of the rows that count, where others are mixed in."""
    declined = F.coalesce(F.col("txn_status") == "decline", F.lit(False))
    return [
        *(Rolling(f"user_txn_count_{n}", "count", s, only) for n, s in (("1d", D1), ("7d", D7), ("30d", D30))),
        *(Rolling(f"user_txn_amount_sum_{n}", "sum", s, "amount") for n, s in (("1d", D1), ("7d", D7), ("30d", D30))),
        Rolling("user_avg_ticket_30d", "avg", D30, "amount"),
        Rolling("user_distinct_merchants_30d", "distinct", D30, "merchant_id"),
        Rolling("user_distinct_devices_30d", "distinct", D30, "device_id"),
        Rolling("user_decline_count_7d", "count", D7, declined),
    ]


def user_txn_online_columns(only: str | None = None) -> list[Rolling]:
    windows = (("5m", M5), ("10m", M10), ("1h", H1))
    return [
        *(Rolling(f"user_txn_count_{n}", "count", s, only) for n, s in windows),
        *(Rolling(f"user_txn_amount_sum_{n}", "sum", s, "amount") for n, s in windows),
        *(Rolling(f"user_distinct_merchants_{n}", "distinct", s, "merchant_id") for n, s in windows),
    ]


LOGIN = [Rolling("user_failed_logins_1d", "count", D1, "is_failed_login"), Rolling("user_failed_logins_7d", "count", D7, "is_failed_login")]
LOGIN_ONLINE = [Rolling("user_failed_logins_15m", "count", M15, "is_failed_login"), Rolling("user_failed_logins_1h", "count", H1, "is_failed_login")]
DEVICE = [
    Rolling("device_distinct_users_30d", "distinct", D30, "user_id"),
    Rolling("device_txn_count_7d", "count", D7),
    Rolling("device_txn_count_1d", "count", D1),
]
DEVICE_ONLINE = [Rolling(f"device_txn_count_{n}", "count", s) for n, s in (("5m", M5), ("10m", M10), ("1h", H1))]
MERCHANT = [
    Rolling("merchant_txn_count_30d", "count", D30),
    Rolling("merchant_avg_ticket_30d", "avg", D30, "amount"),
    Rolling("merchant_fraud_rate_30d", "avg", D30, "fraud_value"),
]


def names(columns: list[Rolling]) -> list[str]:
    return [c.name for c in columns]


def user_txn_stats(txns: DataFrame, engine: str = "range") -> DataFrame:
    cols, txns = user_txn_columns(), txns.select(*KEYS, "amount", "txn_status")
    return rolling(txns, "user_id", cols, engine=engine).select("transaction_id", "user_id", "event_timestamp", *names(cols))


def user_txn_online_stats(txns: DataFrame, engine: str = "range") -> DataFrame:
    cols, txns = user_txn_online_columns(), txns.select(*KEYS, "amount")
    return rolling(txns, "user_id", cols, engine=engine).select("transaction_id", "user_id", "event_timestamp", *names(cols))


def with_failed_logins(txns: DataFrame, logins: DataFrame) -> DataFrame:
    """Transactions and failed logins in one table, told apart by is_txn. Windows run over both; keep_txns comes after. txns
    must not have columns is_txn and is_failed_login."""
    if taken := {"is_txn", "is_failed_login"} & set(txns.columns):
        raise ValueError(f"columns {', '.join(sorted(taken))} are taken")
    failed = logins.where("login_status = 'failed'").select("user_id", "event_timestamp")
    both = txns.withColumn("is_txn", F.lit(True)).unionByName(failed.withColumn("is_txn", F.lit(False)), allowMissingColumns=True)
    return both.withColumn("is_failed_login", ~F.col("is_txn"))


def keep_txns(both: DataFrame) -> DataFrame:
    return both.where("is_txn").drop("is_txn", "is_failed_login")


def _login_stats(txns: DataFrame, logins: DataFrame, cols: list[Rolling], engine: str) -> DataFrame:
    slim = txns.select("transaction_id", "user_id", "event_timestamp")
    return keep_txns(rolling(with_failed_logins(slim, logins), "user_id", cols, engine=engine))


def user_login_stats(txns: DataFrame, logins: DataFrame, engine: str = "range") -> DataFrame:
    return _login_stats(txns, logins, LOGIN, engine)


def user_login_online_stats(txns: DataFrame, logins: DataFrame, engine: str = "range") -> DataFrame:
    return _login_stats(txns, logins, LOGIN_ONLINE, engine)


def device_stats(txns: DataFrame, engine: str = "range") -> DataFrame:
    return rolling(txns.select(*KEYS), "device_id", DEVICE, engine=engine).select("transaction_id", "device_id", "event_timestamp", *names(DEVICE))


def device_txn_online_stats(txns: DataFrame, engine: str = "range") -> DataFrame:
    return rolling(txns.select(*KEYS), "device_id", DEVICE_ONLINE, engine=engine).select("transaction_id", "device_id", "event_timestamp", *names(DEVICE_ONLINE))


def with_labels(txns: DataFrame, labels: DataFrame) -> DataFrame:
    """A transaction without a label is no fraud. fraud_value is the label as an exact number, for averages."""
    known = labels.select("transaction_id", F.col("is_fraud").alias("label_fraud"))
    out = txns.join(known, ID, "left").withColumn("is_fraud", F.coalesce("label_fraud", F.lit(False)).cast("int"))
    return out.withColumn("fraud_value", F.col("is_fraud").cast("bigint")).drop("label_fraud")


def merchant_stats(txns: DataFrame, labels: DataFrame, engine: str = "range") -> DataFrame:
    slim = with_labels(txns.select(*KEYS, "amount"), labels).select(*KEYS, "amount", "fraud_value")
    return rolling(slim, "merchant_id", MERCHANT, engine=engine).select("transaction_id", "merchant_id", "event_timestamp", *names(MERCHANT))


def merchant_fraud_rate_asof_labels(txns: DataFrame, labels: DataFrame, window: int = D30, engine: str = "range") -> DataFrame:
    """As in merchant_stats, but a transaction counts as fraud only where its label had arrived before the row's second.

    A label that arrives at second l for a transaction of second s counts for rows from max(s, l) + 1 to s + window:
    the running number of such labels is kept by two changes each, as in a sweep.
    """
    known = labels.where("is_fraud").select("transaction_id", "label_timestamp")
    counted = rolling(txns.select(*KEYS), "merchant_id", [Rolling("merchant_txn_count_30d", "count", window)], engine=engine)
    counted = counted.select("transaction_id", "merchant_id", "event_timestamp", "merchant_txn_count_30d")
    second = F.unix_timestamp("event_timestamp")
    frauds = txns.select("transaction_id", "merchant_id", second.alias("s")).join(known, ID)
    frauds = frauds.withColumn("from", F.greatest("s", F.unix_timestamp("label_timestamp")) + 1).withColumn("to", F.col("s") + window + 1)
    frauds = frauds.where("from < to")
    one = lambda at, n: F.struct(F.col(at).alias("at"), F.lit(n).cast("bigint").alias("change"))
    changes = frauds.select("merchant_id", F.inline(F.array(one("from", 1), one("to", -1))))
    changes = changes.groupBy("merchant_id", "at").agg(F.sum("change").alias("change"))
    probes = counted.select("merchant_id", F.unix_timestamp("event_timestamp").alias("at"), F.struct(*counted.columns).alias("row"))
    both = changes.unionByName(probes, allowMissingColumns=True).withColumn("span", F.floor(F.col("at") / D7))
    spans = both.groupBy("merchant_id", "span").agg(F.sum("change").alias("n"))
    before = Window.partitionBy("merchant_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("merchant_id", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.coalesce(F.sum("change").over(Window.partitionBy("merchant_id", "span").orderBy("at")), F.lit(0))
    both = both.withColumn("n", own).where("row IS NOT NULL").join(spans, ["merchant_id", "span"]).select("row.*", (F.col("n") + F.col("before")).alias("frauds"))
    rate = F.when(F.col("merchant_txn_count_30d") > 0, F.col("frauds") / F.col("merchant_txn_count_30d")).otherwise(0.0)
    return both.select("transaction_id", "merchant_id", "event_timestamp", rate.cast("double").alias("merchant_fraud_rate_30d"))


OPERATIONS = {"ZCOUNT": "count", "ZRANGEBYSCORE_SUM": "sum", "ZCARD_WINDOWED": "distinct"}


def window_from_registry(txns: DataFrame, name: str, key: str, operation: str, window: str, value: str | None = None, engine: str = "range") -> DataFrame:
    """A feature built from its registry entry: an operation, a window such as `5m`, and the value it reads."""
    if operation not in OPERATIONS:
        raise ValueError(f"operation {operation!r} is none of {', '.join(OPERATIONS)}")
    column = Rolling(name, OPERATIONS[operation], parse_window(window), value)
    return rolling(txns, key, [column], engine=engine).select("transaction_id", key, "event_timestamp", name)


def _profile(df: DataFrame, users: DataFrame) -> DataFrame:
    """With the account's age in days, and its flags as 0 and 1; 0 for an unknown user."""
    known = users.select("user_id", "account_type", "is_verified", "signup_date")
    out = df.join(known, "user_id", "left")
    return out.withColumns({
        "user_account_age_days": F.coalesce(F.datediff(F.to_date("event_timestamp"), "signup_date"), F.lit(0)),
        "user_is_standard_account": F.coalesce((F.col("account_type") == "standard").cast("int"), F.lit(0)),
        "user_is_verified": F.coalesce(F.col("is_verified").cast("int"), F.lit(0)),
    }).drop("account_type", "is_verified", "signup_date")


PROFILE = ["user_account_age_days", "user_is_standard_account", "user_is_verified"]


def with_user_features(txns: DataFrame, logins: DataFrame, users: DataFrame, engine: str = "range") -> DataFrame:
    """txns with all user features: one pass over transactions and failed logins together."""
    cols = [*user_txn_columns("is_txn"), *user_txn_online_columns("is_txn"), *LOGIN, *LOGIN_ONLINE]
    return _profile(keep_txns(rolling(with_failed_logins(txns, logins), "user_id", cols, engine=engine)), users)


def user_features(txns: DataFrame, logins: DataFrame, users: DataFrame, engine: str = "range") -> DataFrame:
    cols = [*PROFILE, *names(user_txn_columns()), *names(LOGIN), *names(user_txn_online_columns()), *names(LOGIN_ONLINE)]
    slim = txns.select("transaction_id", "user_id", "device_id", "merchant_id", "amount", "txn_status", "event_timestamp")
    return with_user_features(slim, logins, users, engine).select("transaction_id", "user_id", "event_timestamp", *cols)


def _shared_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("device_is_shared_flag", (F.col("device_distinct_users_30d") > 2).cast("int"))


def with_device_features(txns: DataFrame, engine: str = "range") -> DataFrame:
    return _shared_flag(rolling(txns, "device_id", [*DEVICE, *DEVICE_ONLINE], engine=engine))


def device_features(txns: DataFrame, engine: str = "range") -> DataFrame:
    slim = txns.select("transaction_id", "user_id", "device_id", "event_timestamp")
    cols = [*names(DEVICE), "device_is_shared_flag", *names(DEVICE_ONLINE)]
    return with_device_features(slim, engine).select("transaction_id", "device_id", "event_timestamp", *cols)


def with_merchant_features(txns: DataFrame, merchants: DataFrame, labels: DataFrame, engine: str = "range") -> DataFrame:
    """Also with is_fraud; category and tier stay null for an unknown merchant, its flags are 0."""
    return _merchant_profile(rolling(with_labels(txns, labels), "merchant_id", MERCHANT, engine=engine), merchants)


def _merchant_profile(out: DataFrame, merchants: DataFrame) -> DataFrame:
    known = merchants.select("merchant_id", "merchant_category", "risk_tier", "is_online")
    out = out.join(known, "merchant_id", "left")
    return out.withColumns({
        "merchant_is_high_risk": F.coalesce((F.col("risk_tier") == "high").cast("int"), F.lit(0)),
        "merchant_is_online": F.coalesce(F.col("is_online").cast("int"), F.lit(0)),
    })


def merchant_features(txns: DataFrame, merchants: DataFrame, labels: DataFrame, engine: str = "range") -> DataFrame:
    slim = txns.select("transaction_id", "merchant_id", "amount", "event_timestamp")
    cols = ["merchant_category", "risk_tier", "merchant_is_high_risk", "merchant_is_online", *names(MERCHANT)]
    return with_merchant_features(slim, merchants, labels, engine).select("transaction_id", "merchant_id", "event_timestamp", *cols)


def training_columns() -> list[str]:
    return [
        *PROFILE, *names(user_txn_columns()), *names(LOGIN), *names(DEVICE), "device_is_shared_flag", "merchant_is_high_risk",
        "merchant_is_online", *names(MERCHANT), *names(user_txn_online_columns()), *names(LOGIN_ONLINE), *names(DEVICE_ONLINE),
    ]


def _request(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id", "user_id", "device_id", "merchant_id", "event_timestamp",
        F.col("amount").cast("double").alias("txn_amount"), "currency", "payment_method",
        F.col("is_international").cast("int").alias("is_international"), "local_hour",
        F.coalesce((F.col("txn_status") == "decline").cast("int"), F.lit(0)).alias("prev_decline_flag"),
        *training_columns(), "is_fraud",
    )


#: Users hold few rows each; a device or merchant may hold a third of all.
TRAINING_ENGINES = {"user": "range", "device": "sweep", "merchant": "sweep"}


def training_dataset(txns: DataFrame, logins: DataFrame, users: DataFrame, merchants: DataFrame, labels: DataFrame, engines: dict[str, str] | None = None) -> DataFrame:
    """One row for each transaction with all features and the label. The transactions are numbered and written once; the windows of
    users, devices and merchants each take the few columns that they need from that table and give back their values by number,
    and these are joined to the wide rows once. engines: of each kind; see rolling."""
    engines = TRAINING_ENGINES | (engines or {})
    slim = txns.drop("country_code", "ip_address", "decline_reason", "ingestion_timestamp")
    base = stored(with_labels(slim, labels).withColumn("row_no", F.monotonically_increasing_id()), "numbered")
    of_user = with_failed_logins(base.select("row_no", "user_id", "device_id", "merchant_id", "amount", "txn_status", "event_timestamp"), logins)
    user_columns = [*user_txn_columns("is_txn"), *user_txn_online_columns("is_txn"), *LOGIN, *LOGIN_ONLINE]
    if engines["user"] == "sweep":
        of_user = stored(of_user, "with-logins")
    parts = [
        windows_of(of_user, "row_no", "user_id", user_columns, engine=engines["user"]),
        windows_of(base.select("row_no", "user_id", "device_id", "event_timestamp"), "row_no", "device_id", [*DEVICE, *DEVICE_ONLINE], engine=engines["device"]),
        windows_of(base.select("row_no", "merchant_id", "amount", "fraud_value", "event_timestamp"), "row_no", "merchant_id", MERCHANT, engine=engines["merchant"]),
    ]
    out = base
    for part in parts:
        out = out.join(part, "row_no")
    return _request(_merchant_profile(_shared_flag(_profile(out, users)), merchants))


def training_dataset_by_join(txns: DataFrame, users: DataFrame, devices: DataFrame, merchants: DataFrame, labels: DataFrame) -> DataFrame:
    """The same from the three feature tables, joined on transaction_id."""
    out = txns
    for table in (users.drop("user_id", "event_timestamp"), devices.drop("device_id", "event_timestamp"), merchants.drop("merchant_id", "event_timestamp")):
        out = out.join(table, ID, "left")
    return _request(with_labels(out, labels))
