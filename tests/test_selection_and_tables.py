"""Exact quantiles, exact splits, stored tables and compiled services."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudfeatures.functions import registry
from fraudfeatures.operators import evaluation, features, monitoring, serving
from fraudfeatures.operators.quantiles import exact_quantiles
from fraudfeatures.operators.windows import Rolling, rolling
from fraudfeatures.plans import queries
from fraudfeatures.sources import catalog

T0 = datetime(2024, 1, 1)


def test_quantiles_against_numpy(spark):
    """Few values are sorted at once here, so that the passes have to find the ranks."""
    rng = random.Random(1)
    groups = {
        "even": [float(i) for i in range(500)], "skewed": [rng.random() ** 9 * 1e9 for _ in range(800)], "ties": [float(rng.randrange(3)) for _ in range(700)],
        "wide": [-1.7e308, 1.7e308, *(rng.gauss(0, 1) for _ in range(300))], "close": [1.0 + i * 2.2e-16 for i in range(40)] * 5, "one": [4.0], None: [2.0, 1.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("even", None), ("none", None), ("none", float("nan")), ("none", float("inf"))]
    rng.shuffle(rows)
    shares = [0.0, 0.05, 0.5, 0.5, 0.77, 1.0]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, ["g"], "v", shares, few=16, pieces=8).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        vs, want = sorted(vs), []
        for q in shares:
            k, part = divmod(q * (len(vs) - 1), 1)
            want.append(vs[int(k)] + (vs[int(k) + 1] - vs[int(k)]) * part if part else vs[int(k)])
        assert got[g][0] == len(vs) and np.allclose(got[g][1], want, rtol=1e-12, atol=0), g
    assert exact_quantiles(df, [], F.col("v") * 0 + 1, [0.5]).first()["quantiles"] == [1.0]
    assert exact_quantiles(df.limit(0), [], "v", [0.5]).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(df, [], "v", [1.5])


def test_psi_of_empty_tables(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "v double")
    assert monitoring.psi(df.limit(0), df, ["v"]).count() == 0
    assert monitoring.psi(df, df.limit(0), ["v"]).first()["psi"] > 10 and monitoring.psi(df, df, ["v"]).first()["psi"] == 0
    exact, near = (evaluation.scaling_statistics(df, ["v"], e).first()["v_q"] for e in (True, False))
    assert exact == [24.75, 49.5, 74.25] and all(abs(a - b) <= 1 for a, b in zip(exact, near, strict=True))


def test_stratified_split_is_exact(spark):
    rng = random.Random(2)
    rows = [(f"t{i}", rng.choice([0, 0, 0, 1, None]), "x") for i in range(997)] + [("same", 1, "x")] * 20 + [(None, 0, "x")] * 3
    df = spark.createDataFrame(rows, "transaction_id string, is_fraud int, split_place string")
    for fraction in (0.8, 0.0, 1.0, 0.333):
        out = evaluation.stratified_split(df, fraction)
        assert out.columns == [*df.columns, "part"]
        got = Counter((r["is_fraud"], r["part"]) for r in out.collect())
        for label, n in Counter(r[1] for r in rows).items():
            assert got[label, "train"] == int(fraction * n) and got[label, "test"] == n - int(fraction * n)
    first, again = (sorted(map(str, evaluation.stratified_split(d).select("transaction_id", "part").distinct().collect())) for d in (df, df.repartition(5)))
    assert first == again
    assert evaluation.stratified_split(df, label=None).where("part = 'train'").count() == int(0.8 * 1020)


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_windows_exchange_rows_once(spark, small):
    """Frames and distinct values of one key ask for one exchange."""
    t = queries.Tables(spark, small)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert exchanges(features.user_txn_stats(t.txns)) == 1
        assert exchanges(features.user_txn_online_stats(t.txns)) == 1
        assert exchanges(features.device_stats(t.txns)) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_training_set_with_every_engine(spark, small):
    """Also: the raw tables are read once each for the wide rows, since windows take theirs from the numbered table."""
    t = queries.Tables(spark, small)
    made = [features.training_dataset(t.txns, t.logins, t.users, t.merchants, t.labels, dict.fromkeys(("user", "device", "merchant"), e)) for e in ("range", "sweep")]
    key = lambda df: sorted(map(str, df.collect()))
    assert key(made[0]) == key(made[1])
    plan = t.training()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("events.parquet") + plan.count("Relation [event_id") <= 2, "the events are read for failed logins alone, the transactions come from the table"


def test_sweep_refuses_doubles(spark):
    df = spark.createDataFrame([("u", 1.0, T0)], "user_id string, v double, event_timestamp timestamp")
    with pytest.raises(ValueError):
        rolling(df, "user_id", [Rolling("s", "sum", 10, "v")], engine="sweep")
    assert rolling(df, "user_id", [Rolling("d", "distinct", 10, "v")], engine="sweep").first()["d"] == 0
    exact = df.withColumn("v", F.col("v").cast("decimal(30,4)"))
    assert rolling(exact, "user_id", [Rolling("s", "sum", 10, "v")], engine="sweep").first()["s"] == 0.0


def test_stored_tables_are_joined_without_an_exchange(spark, small):
    t = queries.Tables(spark, small)
    key = lambda df: sorted(map(str, df.collect()))
    want = t.training()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = queries._stored_training(t).select(want.columns)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan
        got = key(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == key(want)


def test_days_are_dropped_as_metadata(spark, tmp_path):
    catalog.day_database(spark, "log_days", f"file://{tmp_path}/db")
    rows = [(f"t{i}", T0 + timedelta(days=i % 5, hours=1)) for i in range(50)] + [("none", None)]
    df = spark.createDataFrame(rows, "transaction_id string, scored_at timestamp")
    for half in (df.where("transaction_id < 't3'"), df.where("transaction_id >= 't3'")):
        catalog.append_days(half, "log_days.scores", "scored_at")
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(tmp_path / "db") for f in fs if f.startswith("part-")}
    before = files()
    dropped = catalog.drop_days(spark, "log_days.scores", T0 + timedelta(days=5), 3)
    assert [d.day for d in dropped] == [1, 2, 3] and [d.day for d in catalog.days_of(spark, "log_days.scores")] == [4, 5]
    assert spark.table("log_days.scores").count() == 21
    after = files()
    assert after and all(before[f] == m for f, m in after.items()) and len(after) < len(before), "kept files are not written again"
    assert catalog.drop_days(spark, "log_days.scores", T0 + timedelta(days=5), 3) == []
    spark.sql("DROP DATABASE log_days CASCADE")


def test_services_compile_to_one_pass_for_each_key(spark, small):
    t = queries.Tables(spark, small)
    requests = t.txns.select(F.col("transaction_id").alias("request_id"), "user_id", "device_id", "merchant_id", F.col("event_timestamp").alias("now"))
    want = serving.online_features_at(requests.drop("merchant_id"), t.txns, t.logins)
    got = serving.service_features_at("fraud_full", requests, t.txns, t.logins)
    key = lambda df: sorted(map(str, df.select("request_id", *registry.online_names("fraud_full")).collect()))
    assert key(got) == key(want) and len(registry.online_names("fraud_full")) == 14
    for swept in (serving.online_features_at(requests.drop("merchant_id"), t.txns, t.logins, "sweep"), serving.service_features_at("fraud_full", requests, t.txns, t.logins, "sweep")):
        assert key(swept) == key(want)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = serving.service_features_at("fraud_full", requests, t.txns, t.logins)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_COL") == 2, "one exchange to windows for users and one for devices"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    own = {"merchant_sum_30m": registry.Feature("merchant_sum_30m", "merchant", "online", "amount", 0.0, "ZRANGEBYSCORE_SUM", "30m", "merchant:{merchant_id}:sum")}
    out = serving.service_features_at("mine", requests, t.txns, t.logins, known=own, services={"mine": ["merchant_sum_30m"]})
    assert out.columns == ["request_id", "merchant_sum_30m"] and out.count() == requests.count() and out.where("merchant_sum_30m > 0").count() > 0
    assert serving.service_features_at("none", requests, t.txns, t.logins, known={}, services={"none": []}).columns == ["request_id"]
