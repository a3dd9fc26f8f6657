"""Windows at their edges, and both engines on random data."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fraudfeatures.operators import features
from fraudfeatures.operators.windows import Rolling, parse_window, rolling, seconds

T0 = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, user_id string, device_id string, merchant_id string, amount decimal(18,4), txn_status string, event_timestamp timestamp"


def txn(i, at, user="u", device="d", merchant="m", amount=10, status="success"):
    from decimal import Decimal

    return (f"t_{i}", user, device, merchant, Decimal(amount), status, T0 + timedelta(seconds=at))


def test_units():
    assert seconds("HOUR", 2) == 7200 and parse_window("5m") == 300 and parse_window("30d") == 30 * 86400
    for bad in ("5x", "m", "x5m"):
        with pytest.raises(ValueError):
            parse_window(bad)
    with pytest.raises(ValueError):
        seconds("WEEK", 1)


@pytest.mark.parametrize("engine", ["range", "sweep"])
def test_edges(spark, engine):
    rows = [txn(1, 0, merchant="a"), txn(2, 0, merchant="b"), txn(3, 60, merchant="a"), txn(4, 61), txn(5, 121, amount=7), txn(6, 500)]
    cols = [
        Rolling("n", "count", 60), Rolling("s", "sum", 60, "amount"), Rolling("a", "avg", 60, "amount"),
        Rolling("d", "distinct", 60, "merchant_id"), Rolling("c", "count", 60, F.col("amount") > 8),
    ]
    got = {r["transaction_id"]: (r["n"], r["s"], r["a"], r["d"], r["c"]) for r in rolling(spark.createDataFrame(rows, SCHEMA), "user_id", cols, engine=engine).collect()}
    assert got["t_1"] == got["t_2"] == (0, 0.0, 0.0, 0, 0)  # same second: neither counts the other
    assert got["t_3"] == (2, 20.0, 10.0, 2, 2)  # exactly 60 seconds back is in
    assert got["t_4"] == (1, 10.0, 10.0, 1, 1)  # 61 seconds back is out
    assert got["t_5"] == (1, 10.0, 10.0, 1, 1) and got["t_6"] == (0, 0.0, 0.0, 0, 0)


def test_engines_agree_on_random_rows(spark):
    rng = random.Random(4)
    rows = [
        txn(i, rng.choice([rng.randrange(40 * 86400), rng.randrange(900)]), rng.choice("uvw"), rng.choice("de"), rng.choice("abcdef"), rng.randrange(1, 99), rng.choice(["success", "decline"]))
        for i in range(600)
    ]
    rows += [(*txn(1000 + i, i)[:1], None, *txn(1000 + i, i)[2:]) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    cols = [*features.user_txn_columns(), *features.user_txn_online_columns()]
    one, two = (rolling(df, "user_id", cols, engine=e).orderBy("transaction_id").collect() for e in ("range", "sweep"))
    assert one == two


def test_failed_login_counts_for_the_next_transaction(spark):
    txns = spark.createDataFrame([txn(1, 100), txn(2, 5000)], SCHEMA)
    logins = spark.createDataFrame([("u", "failed", T0 + timedelta(seconds=99)), ("u", "success", T0), ("u", "failed", T0 + timedelta(seconds=100))], "user_id string, login_status string, event_timestamp timestamp")
    got = {r["transaction_id"]: r["user_failed_logins_15m"] for r in features.user_login_online_stats(txns, logins).collect()}
    assert got == {"t_1": 1, "t_2": 0}


def test_label_counts_once_it_has_arrived(spark):
    txns = spark.createDataFrame([txn(1, 0), txn(2, 100), txn(3, 2000)], SCHEMA)
    labels = spark.createDataFrame([("t_1", True, T0 + timedelta(seconds=1000))], "transaction_id string, is_fraud boolean, label_timestamp timestamp")
    got = {r["transaction_id"]: r["merchant_fraud_rate_30d"] for r in features.merchant_fraud_rate_asof_labels(txns, labels).collect()}
    assert got == {"t_1": 0.0, "t_2": 0.0, "t_3": 0.5}
    plain = {r["transaction_id"]: r["merchant_fraud_rate_30d"] for r in features.merchant_stats(txns, labels).collect()}
    assert plain == {"t_1": 0.0, "t_2": 1.0, "t_3": 0.5}
