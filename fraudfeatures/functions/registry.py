"""Features, the ordered services that models read, and checks of both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Feature:
    """mode: request, batch or online. source: the column of the batch table, the field of a request, or the value that an online feature
    sums up or counts. An online feature has an operation over a window on the events (txn, or login for failed logins) of a key, written
    with the entity's id in braces. default: where there is no value."""

    name: str
    entity: str | None
    mode: str
    source: str | None = None
    default: float = 0.0
    operation: str | None = None
    window: str | None = None
    key: str | None = None
    events: str = "txn"


#: The entities and their ids.
ENTITIES = {"user": "user_id", "device": "device_id", "merchant": "merchant_id"}
#: What online features may do with the events of a window.
ONLINE_OPERATIONS = ("ZCOUNT", "ZRANGEBYSCORE_SUM", "ZCARD_WINDOWED")
REQUEST = ["txn_amount", "is_international", "local_hour"]
# The services' orders, which models depend on.
FRAUD_V1 = [
    "txn_amount", "is_international", "local_hour", "user_account_age_days", "user_is_verified", "user_is_standard_account",
    "user_txn_count_1d", "user_txn_count_7d", "user_txn_count_30d", "user_txn_amount_sum_1d", "user_txn_amount_sum_7d",
    "user_txn_amount_sum_30d", "user_avg_ticket_30d", "user_distinct_merchants_30d", "user_distinct_devices_30d",
    "user_decline_count_7d", "user_failed_logins_7d", "user_failed_logins_1d", "device_distinct_users_30d",
    "device_txn_count_7d", "device_txn_count_1d", "device_is_shared_flag", "merchant_is_high_risk", "merchant_is_online",
    "merchant_txn_count_30d", "merchant_avg_ticket_30d", "merchant_fraud_rate_30d", "user_txn_count_5m",
    "user_txn_count_10m", "user_txn_count_1h", "user_txn_amount_sum_10m", "user_distinct_merchants_1h",
    "device_txn_count_5m", "device_txn_count_10m", "user_failed_logins_15m",
]
FRAUD_FULL = [
    "txn_amount", "is_international", "local_hour", "user_account_age_days", "user_is_verified", "user_is_standard_account",
    "user_txn_count_1d", "user_txn_count_7d", "user_txn_count_30d", "user_txn_amount_sum_1d", "user_txn_amount_sum_7d",
    "user_txn_amount_sum_30d", "user_avg_ticket_30d", "user_distinct_merchants_30d", "user_distinct_devices_30d",
    "user_decline_count_7d", "user_failed_logins_7d", "user_failed_logins_1d", "device_distinct_users_30d",
    "device_txn_count_7d", "device_txn_count_1d", "device_is_shared_flag", "merchant_is_high_risk", "merchant_is_online",
    "merchant_txn_count_30d", "merchant_avg_ticket_30d", "merchant_fraud_rate_30d", "user_txn_count_5m",
    "user_txn_count_10m", "user_txn_count_1h", "user_txn_amount_sum_5m", "user_txn_amount_sum_10m", "user_txn_amount_sum_1h",
    "user_distinct_merchants_5m", "user_distinct_merchants_10m", "user_distinct_merchants_1h", "device_txn_count_5m",
    "device_txn_count_10m", "device_txn_count_1h", "user_failed_logins_15m", "user_failed_logins_1h",
]
SERVICES = {"fraud_v1": FRAUD_V1, "fraud_full": FRAUD_FULL}
ONLINE = [f for f in FRAUD_FULL if f.endswith(("_5m", "_10m", "_15m", "_1h"))]


def _online(name: str, entity: str) -> Feature:
    what, window = name.removeprefix(f"{entity}_").rsplit("_", 1)
    operation = "ZRANGEBYSCORE_SUM" if "sum" in what else "ZCARD_WINDOWED" if "distinct" in what else "ZCOUNT"
    source = {"ZRANGEBYSCORE_SUM": "amount", "ZCARD_WINDOWED": "merchant_id"}.get(operation)
    return Feature(name, entity, "online", source, 0.0, operation, window, f"{entity}:{{{ENTITIES[entity]}}}:{what}", "login" if "login" in what else "txn")


def online_names(service: str, known: dict[str, Feature] | None = None, services: dict[str, list[str]] | None = None) -> list[str]:
    """The online features of a service, in its order."""
    known, services = features() if known is None else known, SERVICES if services is None else services
    return [f for f in services[service] if known[f].mode == "online"]


def features() -> dict[str, Feature]:
    out = {}
    for name in FRAUD_FULL:
        entity = name.split("_")[0]
        if name in REQUEST:
            out[name] = Feature(name, None, "request", name)
        else:
            out[name] = _online(name, entity) if name in ONLINE else Feature(name, entity, "batch", name)
    return out


def _faults(f: Feature) -> list[str]:
    """What a feature's mode asks for and it lacks."""
    if f.mode not in ("request", "batch", "online"):
        return [f"{f.name}: mode {f.mode}"]
    if f.mode != "online":
        return [] if f.source else [f"{f.name}: mode {f.mode} needs a source"]
    lacks = [f"{f.name}: mode online needs {part}" for part in ("operation", "window", "key") if not getattr(f, part)]
    if f.operation and f.operation not in ONLINE_OPERATIONS:
        lacks.append(f"{f.name}: operation {f.operation} is none of {', '.join(ONLINE_OPERATIONS)}")
    if f.key and f.entity in ENTITIES and f"{{{ENTITIES[f.entity]}}}" not in f.key:
        lacks.append(f"{f.name}: key {f.key} lacks {{{ENTITIES[f.entity]}}}")
    return lacks


def validate(tables: dict[str, DataFrame], known: dict[str, Feature] | None = None, services: dict[str, list[str]] | None = None) -> list[str]:
    """What is wrong: features of services that do not exist or repeat, unknown entities and modes, what a mode asks for and a
    feature lacks, unknown operations, keys without the entity's id, batch features whose entity's table lacks their column.
    Empty if all is well."""
    known, services = features() if known is None else known, SERVICES if services is None else services
    wrong = [f"{s}: {f} is not known" for s, names in services.items() for f in names if f not in known]
    wrong += [f"{s}: {f} repeats" for s, names in services.items() for f in sorted({f for f in names if names.count(f) > 1})]
    for f in known.values():
        if f.entity not in ENTITIES and not (f.entity is None and f.mode == "request"):
            wrong.append(f"{f.name}: entity {f.entity} is not known")
        wrong += _faults(f)
        if f.mode == "batch" and f.entity in tables and f.source and f.source not in tables[f.entity].columns:
            wrong.append(f"{f.name}: column {f.source} is not in the {f.entity} table")
    return wrong


def feature_vector(df: DataFrame, service: str = "fraud_v1", prefixes: tuple[str, ...] = ("request_", "online_", "offline_", "")) -> Column:
    """The service's features in order, as doubles. A feature is read from the first of its columns, by prefix, that is
    there, even if its value is null; what is missing, null or no number is the default."""
    have, known, parts = set(df.columns), features(), []
    for name in SERVICES[service]:
        found = next((F.col(p + name).try_cast("double") for p in prefixes if p + name in have), F.lit(None))
        parts.append(F.coalesce(found, F.lit(known[name].default)))
    return F.array(*parts)
