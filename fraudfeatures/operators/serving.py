"""As-of joins, the latest state of entities, and what serving reads from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudfeatures.functions import registry
from fraudfeatures.operators.features import OPERATIONS
from fraudfeatures.operators.windows import Rolling, parse_window, rolling
from fraudfeatures.sources.work import fresh

TTL = 3 * 86400
WINDOWS = {"5m": 300, "10m": 600, "15m": 900, "1h": 3600}


def pit_join(left: DataFrame, right: DataFrame, key: str, columns: list[str], ts: str = "event_timestamp", ttl: int = TTL, tie: str = "transaction_id", span: int | None = None) -> DataFrame:
    """left with the columns of the newest right row of the same key at or before its time and no older than ttl seconds,
    else nulls. Of right rows of equal time the larger tie column wins. One exchange, by key; with span (seconds) keys are cut
    into spans of time whose last rows are carried forward, for keys that hold more rows than a task should sort."""
    taken = {c: f"asof_{c}" for c in left.columns}
    l = left.select(F.struct(*left.columns).alias("l"), F.col(key).alias("k"), F.col(ts).alias("at"), F.lit(1).alias("kind"))  # noqa: E741
    r = right.select(F.struct(F.col(ts).alias("asof_ts"), *columns).alias("r"), F.col(key).alias("k"), F.col(ts).alias("at"), F.lit(0).alias("kind"), F.col(tie).alias("tie"))
    both = l.unionByName(r, allowMissingColumns=True)
    parts = ["k"]
    if span is not None:
        both, parts = both.withColumn("span", F.floor(F.unix_timestamp("at") / span)), ["k", "span"]
        ends = both.where("kind = 0").groupBy("k", "span").agg(F.max_by("r", F.struct("at", "tie")).alias("end"))
        spans = both.select("k", "span").distinct().join(ends, ["k", "span"], "left")
        before = Window.partitionBy("k").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
        spans = spans.select("k", "span", F.last("end", ignorenulls=True).over(before).alias("carried"))
    newest = F.last("r", ignorenulls=True).over(Window.partitionBy(*parts).orderBy("at", "kind", "tie").rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("r", newest).where("kind = 1")
    if span is not None:
        out = out.join(spans, ["k", "span"], "left").withColumn("r", F.coalesce("r", "carried"))
    fresh = F.unix_timestamp("at") - F.unix_timestamp("r.asof_ts") <= ttl
    return out.select("l.*", *(F.when(fresh, F.col(f"r.{c}")).alias(c if c not in taken else taken[c]) for c in columns))


def override_from_log(features: DataFrame, log: DataFrame, columns: list[str]) -> DataFrame:
    """The logged value of each column where the transaction was logged, else the recomputed one."""
    logged = log.select("transaction_id", *(F.col(c).alias(f"logged_{c}") for c in columns))
    out = features.join(logged, "transaction_id", "left")
    kept = [F.coalesce(f"logged_{c}", c).alias(c) if c in columns else F.col(c) for c in features.columns]
    return out.select(*kept)


def materialize_latest(features: DataFrame, key: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """The newest row of each key within [start, end]; of equal times the larger transaction id. Each task keeps its newest row of
    a key before the exchange, which falls away where features are already dealt by the key."""
    rows = features.where(F.col(key).isNotNull())
    for bound, kept in ((start, lambda b: F.col("event_timestamp") >= b), (end, lambda b: F.col("event_timestamp") <= b)):
        rows = rows if bound is None else rows.where(kept(bound))
    place, newest = fresh(rows, "newest_first"), F.row_number().over(Window.partitionBy(key).orderBy(F.desc("event_timestamp"), F.desc("transaction_id")))
    return rows.withColumn(place, newest).where(F.col(place) == 1).drop(place)


def online_lookup(requests: DataFrame, users: DataFrame, devices: DataFrame, merchants: DataFrame) -> DataFrame:
    """Requests with the three snapshots' features; 0 for an unseen entity. feast_ok: whether the user was seen."""
    out = requests
    for table, key in ((users, "user_id"), (devices, "device_id"), (merchants, "merchant_id")):
        columns = [c for c, kind in table.dtypes if c not in ("transaction_id", "event_timestamp", key) and kind != "string"]
        known = table.select(key, *columns, *([F.lit(True).alias("feast_ok")] if key == "user_id" else []))
        out = out.join(known, key, "left").fillna(0, columns)
    return out.withColumn("feast_ok", F.coalesce("feast_ok", F.lit(False)))


def latest_rows(txns: DataFrame) -> DataFrame:
    """entity_type, entity_id, features (a map), event_timestamp, transaction_id: what each transaction says of its user and device. A
    batch or a stream, which is read once."""
    amount, hour, intl = (F.col(c).cast("double") for c in ("amount", "local_hour", "is_international"))
    common = [F.lit("last_txn_amount"), amount, F.lit("last_txn_local_hour"), hour]
    user = F.create_map(*common, F.lit("last_is_international"), intl, F.lit("last_txn_intl_flag"), intl)
    said = [
        F.struct(F.lit(kind).alias("entity_type"), F.col(f"{kind}_id").alias("entity_id"), value.alias("features"))
        for kind, value in (("user", user), ("device", F.create_map(*common)))
    ]
    return txns.select(F.inline(F.array(*said)), "event_timestamp", "transaction_id")


def latest_features(txns: DataFrame) -> DataFrame:
    """entity_type, entity_id, features (a map), event_timestamp: of each user and device the newest transaction's."""
    newest = F.max_by(F.struct("features", "event_timestamp"), F.struct("event_timestamp", "transaction_id")).alias("row")
    return latest_rows(txns).groupBy("entity_type", "entity_id").agg(newest).select("entity_type", "entity_id", "row.*")


def cold_fallback(requests: DataFrame, offline: DataFrame, latest: DataFrame, columns: list[str]) -> DataFrame:
    """Offline features where the user has them; else the latest-state values alone and 0 for the rest, with feast_ok false."""
    users = latest.where("entity_type = 'user'").select(F.col("entity_id").alias("user_id"), F.col("features").alias("latest"))
    known = offline.select("user_id", *columns, F.lit(True).alias("feast_ok"))
    out = requests.join(known, "user_id", "left").join(users, "user_id", "left")
    out = out.withColumn("feast_ok", F.coalesce("feast_ok", F.lit(False))).fillna(0, columns)
    last = ["last_txn_amount", "last_txn_local_hour", "last_is_international"]
    values = {c: F.when(~F.col("feast_ok"), F.coalesce(F.col("latest")[c], F.lit(0.0))).otherwise(0.0) for c in last}
    return out.withColumns(values).drop("latest")


def online_features_at(requests: DataFrame, txns: DataFrame, logins: DataFrame, engine: str = "range") -> DataFrame:
    """For requests (request_id, user_id, device_id, now) the 14 sliding features as a serving store answers them: events
    from now - W up to now, both ends included. A transaction counts once however often it came; merchants are a set that
    keeps the last time; failed logins of one second are one. Sums are rounded to four places.

    Requests ride along with the events as probes of rolling windows that end a second after them; engine: see rolling.
    """
    at = lambda ts: F.timestamp_seconds(F.unix_timestamp(ts))
    asked = requests.select("request_id", "user_id", "device_id", at(F.col("now") + F.expr("INTERVAL 1 SECOND")).alias("at"))
    events = txns.select("transaction_id", "user_id", "device_id", "merchant_id", "amount", at("event_timestamp").alias("at")).dropDuplicates(["transaction_id"])
    failed = logins.where("login_status = 'failed'").select("user_id", at("event_timestamp").alias("at")).distinct()
    sizes = {w: n + 1 for w, n in WINDOWS.items()}
    columns = [
        *(Rolling(f"user_txn_count_{w}", "count", sizes[w], "is_txn") for w in ("5m", "10m", "1h")),
        *(Rolling(f"user_txn_amount_sum_{w}", "sum", sizes[w], "amount") for w in ("5m", "10m", "1h")),
        *(Rolling(f"user_distinct_merchants_{w}", "distinct", sizes[w], "merchant_id") for w in ("5m", "10m", "1h")),
        *(Rolling(f"user_failed_logins_{w}", "count", sizes[w], "is_login") for w in ("15m", "1h")),
    ]
    both = events.drop("device_id").withColumn("is_txn", F.lit(True)).unionByName(failed.withColumn("is_login", F.lit(True)), allowMissingColumns=True)
    both = both.unionByName(asked.drop("device_id").withColumn("is_probe", F.lit(True)), allowMissingColumns=True)
    of_user = rolling(both, "user_id", columns, "at", engine).where("is_probe").select("request_id", *(c.name for c in columns))
    sums = {c.name: F.round(c.name, 4) for c in columns if c.kind == "sum"}
    counts = [Rolling(f"device_txn_count_{w}", "count", sizes[w], "is_txn") for w in ("5m", "10m", "1h")]
    both = events.select("device_id", "at", F.lit(True).alias("is_txn")).unionByName(asked.drop("user_id").withColumn("is_probe", F.lit(True)), allowMissingColumns=True)
    of_device = rolling(both, "device_id", counts, "at", engine).where("is_probe").select("request_id", *(c.name for c in counts))
    out = requests.select("request_id", "user_id", "device_id", "now").join(of_user.withColumns(sums), "request_id", "left").join(of_device, "request_id", "left")
    return out.select("request_id", "user_id", "device_id", "now", *(c.name for c in columns[:-2]), *(c.name for c in counts), *(c.name for c in columns[-2:]))


def service_features_at(service: str, requests: DataFrame, txns: DataFrame, logins: DataFrame, engine: str = "range", known: dict | None = None, services: dict | None = None) -> DataFrame:
    """The online features of a registered service, compiled from their entries, as of the times of requests (request_id, the ids of the
    entities that the service needs, now): request_id and the features in the service's order.

    Entries are grouped by the entity of their key. Each entity's events and requests make one table, and all of its windows are laid
    in one pass over it. Events from now - W up to now count, both ends included; a transaction counts once however often it came,
    failed logins of one second are one; sums are rounded to four places; an empty window gives the entry's default.
    """
    entries = registry.features() if known is None else known
    names = registry.online_names(service, entries, services)
    out = requests.select("request_id")
    for entity in sorted({entries[n].entity for n in names}):
        out = out.join(_entity_windows(entity, [entries[n] for n in names if entries[n].entity == entity], requests, txns, logins, engine), "request_id", "left")
    return out.select("request_id", *(F.coalesce(F.col(n), F.lit(entries[n].default)).cast("double" if entries[n].operation == "ZRANGEBYSCORE_SUM" else "bigint").alias(n) for n in names))


def _entity_windows(entity: str, entries: list, requests: DataFrame, txns: DataFrame, logins: DataFrame, engine: str) -> DataFrame:
    """request_id and the entries' values, all of one entity."""
    key, columns = registry.ENTITIES[entity], []
    at = lambda ts: F.timestamp_seconds(F.unix_timestamp(ts))
    for e in entries:
        if e.operation not in OPERATIONS or (OPERATIONS[e.operation] != "count" and not e.source):
            raise ValueError(f"{e.name}: operation {e.operation} on {e.source} cannot be compiled")
        # A second more, because requests are probes a second after their time.
        columns.append(Rolling(e.name, OPERATIONS[e.operation], parse_window(e.window) + 1, f"is_{e.events}" if OPERATIONS[e.operation] == "count" else e.source))
    values = sorted({e.source for e in entries if e.operation != "ZCOUNT"})
    both = requests.select("request_id", key, at(F.col("now") + F.expr("INTERVAL 1 SECOND")).alias("at"))
    kinds = {e.events for e in entries}
    if "txn" in kinds:
        once = txns.select("transaction_id", key, *(c for c in values if c != key), at("event_timestamp").alias("at")).dropDuplicates(["transaction_id"])
        both = both.unionByName(once.drop("transaction_id").withColumn("is_txn", F.lit(True)), allowMissingColumns=True)
    if "login" in kinds:
        failed = logins.where("login_status = 'failed'").select(key, at("event_timestamp").alias("at")).distinct()
        both = both.unionByName(failed.withColumn("is_login", F.lit(True)), allowMissingColumns=True)
    found = rolling(both, key, columns, "at", engine).where("request_id IS NOT NULL")
    return found.select("request_id", *(F.round(c.name, 4).alias(c.name) if c.kind == "sum" else c.name for c in columns))


def split_member(member: Column) -> tuple[Column, Column]:
    """`id:amount`, split on the last colon."""
    amount = F.substring_index(member, ":", -1)
    return F.substr(member, F.lit(1), F.length(member) - F.length(amount) - 1), amount.cast("double")
