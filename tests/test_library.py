"""Serving, sources, streams, evaluation, checks and the registry on small hand-made tables."""

import random
from dataclasses import replace
from datetime import datetime, timedelta
from math import exp

import pytest
from pyspark.sql import functions as F

from fraudfeatures.functions import registry
from fraudfeatures.operators import checks, evaluation, monitoring, serving
from fraudfeatures.sources import tables
from fraudfeatures.streaming import jobs

T0 = datetime(2024, 1, 1)


def at(s):
    return T0 + timedelta(seconds=s)


def test_registry():
    assert len(registry.FRAUD_V1) == 35 and len(registry.FRAUD_FULL) == 41 and len(set(registry.FRAUD_FULL)) == 41
    assert registry.validate({}) == []
    bad = {"x": registry.Feature("x", "user", "batch", "x"), "y": registry.Feature("y", "user", "odd")}
    assert registry.validate({}, bad, {"s": ["x", "z", "x"]}) == ["s: z is not known", "s: x repeats", "y: mode odd"]
    online = registry.Feature("f", "device", "online", None, 0.0, "ZCOUNT", "5m", "device:{device_id}:n")
    cases = {
        "f: entity shop is not known": {"entity": "shop", "key": "{shop_id}"}, "f: mode online needs operation": {"operation": None},
        "f: mode online needs window": {"window": None}, "f: mode online needs key": {"key": None},
        "f: operation SUM is none of ZCOUNT, ZRANGEBYSCORE_SUM, ZCARD_WINDOWED": {"operation": "SUM"},
        "f: key device:{user_id} lacks {device_id}": {"key": "device:{user_id}"}, "f: mode batch needs a source": {"mode": "batch"},
        "f: mode request needs a source": {"mode": "request"},
    }
    assert registry.validate({}, {"f": online}, {}) == []
    for want, change in cases.items():
        assert registry.validate({}, {"f": replace(online, **change)}, {}) == [want]


def test_feature_vector_order_and_defaults(spark):
    df = spark.createDataFrame([(5.0, 7.0, "abc", None)], "txn_amount double, request_txn_amount double, is_international string, local_hour int")
    vector = df.select(registry.feature_vector(df).alias("v")).first()["v"]
    assert len(vector) == 35 and vector[:3] == [7.0, 0.0, 0.0]
    df = spark.createDataFrame([("abc", 5.0), (None, 5.0), ("2", 5.0)], "request_local_hour string, offline_local_hour double")
    assert [r["v"][2] for r in df.select(registry.feature_vector(df).alias("v")).collect()] == [0.0, 0.0, 2.0], "the request wins, null or not"


def test_requests(spark):
    rows = [("t", "u", "d", "m", 1.0, None), ("t", "u", "d", "m", 0.0, 3), ("t", "", "d", "m", 1.0, 3), ("t", "u", "d", "m", 1.0, 24), ("t", "u", "d", "m", None, 1)]
    good, bad = checks.request_validation(spark.createDataFrame(rows, "transaction_id string, user_id string, device_id string, merchant_id string, amount double, local_hour int"))
    assert good.count() == 1 and sorted(r["reason"] for r in bad.collect()) == ["amount not positive", "amount not positive", "local_hour out of range", "missing user_id"]


def test_pit_join_age_and_ties(spark):
    left = spark.createDataFrame([("u", at(100)), ("u", at(400_000)), ("v", at(5)), ("u", at(9))], "k string, event_timestamp timestamp")
    right = spark.createDataFrame([("u", at(10), "t_1", 1), ("u", at(100), "t_2", 2), ("u", at(100), "t_3", 3)], "k string, event_timestamp timestamp, transaction_id string, x int")
    got = {(r["k"], r["event_timestamp"]): r["x"] for r in serving.pit_join(left, right, "k", ["x"]).collect()}
    assert got == {("u", at(100)): 3, ("u", at(400_000)): None, ("v", at(5)): None, ("u", at(9)): None}
    rng = random.Random(5)
    left = spark.createDataFrame([(rng.choice("uv"), at(rng.randrange(10**6)), i) for i in range(200)], "k string, event_timestamp timestamp, i int")
    right = spark.createDataFrame([(rng.choice("uv"), at(rng.randrange(10**6)), f"t_{i % 40}", i) for i in range(200)], "k string, event_timestamp timestamp, transaction_id string, x int")
    whole, cut = (sorted(map(tuple, serving.pit_join(left, right, "k", ["x"], span=s).collect()), key=str) for s in (None, 50_000))
    assert whole == cut


def test_online_features(spark):
    txns = spark.createDataFrame([(f"t{i}", "u", "d", f"m{i % 2}", a, at(i * 100)) for i, a in enumerate((10, 20, 30))] + [("t0", "u", "d", "m0", 10, at(0))], "transaction_id string, user_id string, device_id string, merchant_id string, amount int, event_timestamp timestamp")
    logins = spark.createDataFrame([("u", "failed", at(50)), ("u", "failed", at(50)), ("u", "success", at(60))], "user_id string, login_status string, event_timestamp timestamp")
    asked = spark.createDataFrame([(1, "u", "d", at(200)), (2, "new", "other", at(200)), (3, "u", "d", at(3700))], "request_id int, user_id string, device_id string, now timestamp")
    got = {r["request_id"]: r for r in serving.online_features_at(asked, txns, logins).collect()}
    assert (got[1]["user_txn_count_5m"], got[1]["user_txn_amount_sum_5m"], got[1]["user_distinct_merchants_1h"], got[1]["user_failed_logins_15m"], got[1]["device_txn_count_10m"]) == (3, 60.0, 2, 1, 3)
    assert all(got[2][c] == 0 for c in got[2].__fields__[4:])
    assert got[3]["user_txn_count_1h"] == 2 and got[3]["user_txn_count_5m"] == 0


def test_split_member(spark):
    row = spark.createDataFrame([("a:b:1.5",)], "m string").select(*(c.alias(n) for c, n in zip(serving.split_member(F.col("m")), "xy", strict=True))).first()
    assert tuple(row) == ("a:b", 1.5)


def test_sinks_are_idempotent(spark, tmp_path):
    months = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("c", 2)], "transaction_id string, month int")
    for batch in (months.where("month = 1"), months, months.where("month = 2")):
        tables.append_missing(batch, f"{tmp_path}/months", partition="month")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/months").collect())) == [("a", 1), ("b", 2), ("c", 2)]
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "transaction_id string, x int")
    for _ in range(2):
        tables.append_missing(df, f"{tmp_path}/t")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/t").collect())) == [("a", 1), ("b", 2)]
    for _ in range(2):
        assert tables.full_refresh(df, f"{tmp_path}/r").count() == 3


def test_decode_keeps_bad_values_apart(spark):
    good, bad = tables.decode(spark.createDataFrame([('{"transaction_id": "a", "amount": 1.5}',), ("{oops",), ('{"amount": 2}',), (None,)], "value string"))
    assert [r["amount"] for r in good.collect()] == [1.5] and bad.count() == 3


def test_confluent_header(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02abc"),), (bytearray(b"\x01\x00\x00\x00\x01x"),), (bytearray(b"\x00"),)], "v binary")
    rows = df.select(*(c.alias(n) for c, n in zip(tables.confluent_header(F.col("v")), ("ok", "id", "body"), strict=True))).collect()
    assert [(r["ok"], r["id"], r["body"]) for r in rows] == [(True, 258, bytearray(b"abc")), (False, None, None), (False, None, None)]


def test_bands_and_ece(spark):
    df = spark.createDataFrame([(0.8, 1), (0.5, 0), (0.2, 0), (0.19, 0), (1.0, 1)], "score double, label int")
    assert [r[0] for r in df.select(evaluation.risk_band(F.col("score"))).collect()] == ["critical", "high", "medium", "low", "critical"]
    assert evaluation.reliability_bins(df).agg(F.sum("n")).first()[0] == 4  # 1.0 lies in no bin
    assert abs(evaluation.ece(df).first()[0] - (0.2 + 0.5 + 0.2 + 0.19) / 5) < 1e-8


def test_cutoff_is_an_order_statistic(spark):
    df = spark.createDataFrame([(i, at(i // 3 * 40_000)) for i in range(17)], "i int, event_timestamp timestamp")
    want = sorted(r["event_timestamp"] for r in df.collect())[int(17 * 0.8)]
    assert evaluation.time_cutoff(df).first()[0] == want


def test_ranking_metrics_with_ties(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 1), (0.5, 0), (0.1, 0)], "score double, label int")
    assert evaluation.ranking_metrics(df).first()["roc_auc"] == 0.875
    assert evaluation.choose_threshold(df).first()[0] == 0.5


def test_calibration_fits(spark):
    """Isotonic against pooling of neighbours, sigmoid against the curve that labels were drawn from, both applied natively."""
    rng = random.Random(6)
    rows = [(round(s, 2), int(rng.random() < 1 / (1 + exp(-(4 * s - 2))))) for s in (rng.random() for _ in range(3000))]
    df = spark.createDataFrame(rows, "score double, label int")
    pools = []  # [sum of labels, rows, scores]
    for score in sorted({s for s, _ in rows}):
        own = [y for s, y in rows if s == score]
        pools.append([sum(own), len(own), [score]])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            y, n, scores = pools.pop()
            pools[-1] = [pools[-1][0] + y, pools[-1][1] + n, pools[-1][2] + scores]
    want = {s: y / n for y, n, scores in pools for s in scores}
    x, y = evaluation.calibration_grid(df, "isotonic", points=101)
    got = {r["score"]: r["c"] for r in df.select("score", evaluation.apply_calibration(F.col("score"), x, y).alias("c")).distinct().collect()}
    assert all(abs(got[s] - want[s]) < 1e-9 for s in want)
    x, y = evaluation.calibration_grid(df, "sigmoid")
    assert max(abs(b - 1 / (1 + exp(-(4 * a - 2)))) for a, b in zip(x, y, strict=True)) < 0.06
    points = spark.createDataFrame([(-1.0,), (0.1,), (0.3,), (0.75,), (2.0,), (None,)], "s double")
    uneven = [r[0] for r in points.select(evaluation.apply_calibration(F.col("s"), [0.0, 0.25, 0.5, 1.0], [0.0, 0.1, 0.6, 1.0])).collect()]
    assert [None if v is None else round(v, 9) for v in uneven] == [0.0, 0.04, 0.2, 0.8, 1.0, None]
    with pytest.raises(ValueError):
        evaluation.calibration_grid(df, "other")


def test_curve_and_ks_against_plain_versions(spark):
    rng = random.Random(7)
    rows = [(round(rng.random() ** 3, 4), int(rng.random() < 0.3)) for _ in range(2000)]
    got = {r["score"]: (r["tp"], r["fp"], r["pos"], r["neg"]) for r in evaluation.curve(spark.createDataFrame(rows, "score double, label int")).collect()}
    pos = sum(y for _, y in rows)
    assert got == {s: (sum(y for t, y in rows if t >= s), sum(1 - y for t, y in rows if t >= s), pos, len(rows) - pos) for s in {s for s, _ in rows}}
    wide = [(rng.choice([rng.gauss(0, 1e6), rng.gauss(0, 1), float("inf"), -1e308]), int(rng.random() < 0.3)) for _ in range(500)]
    got = {r["score"]: (r["tp"], r["fp"]) for r in evaluation.curve(spark.createDataFrame(wide, "score double, label int")).collect()}
    assert got == {s: (sum(y for t, y in wide if t >= s), sum(1 - y for t, y in wide if t >= s)) for s in {s for s, _ in wide}}
    a, b = [rng.gauss(0, 1) for _ in range(900)], [round(rng.gauss(0.3, 2), 1) for _ in range(700)]
    frames = [spark.createDataFrame([(v,) for v in x], "v double") for x in (a, b)]
    want = max(abs(sum(v <= t for v in a) / 900 - sum(v <= t for v in b) / 700) for t in {*a, *b})
    assert abs(monitoring.ks_statistic(*frames, ["v"]).first()["ks"] - want) < 1e-8


def test_retrain(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.7), ("c", 0.51), ("d", 0.1)], "feature string, psi double")
    assert tuple(monitoring.retrain(df).first()) == (3, True) and tuple(monitoring.retrain(df.where("psi < 0.6")).first()) == (2, False)


def test_onehot_refuses_many_values(spark):
    df = spark.createDataFrame([(str(i),) for i in range(5)], "x string")
    with pytest.raises(ValueError):
        evaluation.categorical_encoding(df, df, "x", "onehot", most=4)
    assert len(evaluation.categorical_encoding(df, df, "x", "onehot", most=5).columns) == 6


@pytest.mark.parametrize("kind", ["gbt", "sampled_gbt", "forest"])
def test_tree_models_learn(spark, kind):
    rng = random.Random(8)
    rows = [(rng.random(), rng.random()) for _ in range(400)]
    df = spark.createDataFrame([(a, b, int(a + b > 1.2)) for a, b in rows], "a double, b double, is_fraud int")
    assembler, model = evaluation.train_classifier(df, ["a", "b"], kind=kind, trees=8, depth=3)
    out = model.transform(assembler.transform(df))
    assert out.where("prediction = is_fraud").count() > 360
    with pytest.raises(ValueError):
        evaluation.train_classifier(df, ["a", "b"], kind="other")


def test_registry_without_optional_packages(monkeypatch):
    import sys
    import warnings

    import __spark_entry__

    for name in [m for m in sys.modules if m.startswith(("fraudfeatures.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    for name in ("tokenizers", "xxhash"):
        monkeypatch.setitem(sys.modules, name, None)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert "training_dataset" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.queries()


def test_calibration_grid_is_monotone(spark):
    df = spark.createDataFrame([(i / 100, int(i % 7 < i // 15)) for i in range(100)], "score double, label int")
    for method in ("isotonic", "sigmoid"):
        x, y = evaluation.calibration_grid(df, method)
        assert len(x) == 1000 and all(a <= b + 1e-12 for a, b in zip(y, y[1:], strict=False))


def test_score_log_keeps_the_first(spark):
    new = spark.createDataFrame([("a", "v1", 0.1, at(2)), ("a", "v1", 0.2, at(1)), ("b", "v1", 0.3, at(1))], "transaction_id string, model_version string, fraud_score double, scored_at timestamp")
    got = monitoring.append_score_log(new, new.where("transaction_id = 'b'")).collect()
    assert [(r["transaction_id"], r["fraud_score"]) for r in got] == [("a", 0.2)]


def test_stream_state_equals_the_batch_lookup(spark, small):
    """W7 against M5 on the given events; only what comes in the same second may differ."""
    from fraudfeatures.plans import queries

    t = queries.Tables(spark, small)
    got = {r["transaction_id"]: r["txn_count_1h"] for r in queries._sliding(t, True).collect()}
    asked = t.txns.select(F.col("transaction_id").alias("request_id"), "user_id", "device_id", F.col("event_timestamp").alias("now"))
    want = {r["request_id"]: r["user_txn_count_1h"] for r in serving.online_features_at(asked, t.txns, t.logins).collect()}
    assert got == want


def test_velocity_merge(spark):
    rows = [("t1", "u", "m1", 1.0, True, at(0)), ("t2", "u", "m2", 2.0, False, at(299)), ("t3", "u", "m1", 4.0, False, at(300))]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, merchant_id string, amount double, is_international boolean, event_timestamp timestamp")
    buckets = jobs.user_velocity(df, "5m")
    assert sorted((r["txn_count"], r["txn_amount"], r["intl_count"]) for r in buckets.collect()) == [(1, 4.0, 0), (2, 3.0, 1)]
    merged = jobs.velocity_merge(buckets, "user_id", "merchant_id", F.lit("2024-01-01 00:00:00").cast("timestamp")).first()
    assert (merged["txn_count"], merged["n_distinct"]) == (3, 2)


def test_chained_training_set_equals_the_joined_one(spark, small):
    from fraudfeatures.operators import features
    from fraudfeatures.plans import queries

    t = queries.Tables(spark, small)
    chained = t.training()
    joined = features.training_dataset_by_join(t.txns, t.user_features(), t.device_features(), t.merchant_features(), t.labels)
    key = lambda df: sorted(map(str, df.select(chained.columns).collect()))
    assert key(chained) == key(joined)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("method", ["standard", "minmax", "robust", "passthrough"])
def test_scaling_of_a_constant(spark, method):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert {r["x"] for r in evaluation.numeric_scaling(df, df, ["x"], method).collect()} == {1.0 if method == "passthrough" else 0.0}
