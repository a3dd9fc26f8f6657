"""Streams that run in several batches: stores, sliding state, counts, scoring."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fraudfeatures.operators import evaluation, serving
from fraudfeatures.plans import queries
from fraudfeatures.streaming import jobs, scoring
from fraudfeatures.streaming.store import KeyedStore

T0 = datetime(2024, 1, 1)
EVENT = "transaction_id string, user_id string, merchant_id string, amount double, is_login boolean, event_timestamp timestamp"


def at(s):
    return T0 + timedelta(seconds=s)


def files(spark, tmp_path, batches, schema, name="source"):
    """A stream that reads a file for each batch, in this order."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")


def test_store_keeps_the_newest(spark, tmp_path):
    schema = "k string, v int, t int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    rng = random.Random(1)
    store = KeyedStore(spark, f"file://{tmp_path}/s", frame([]).schema, ["k"], ["t"], buckets=4)
    assert store.read().count() == 0
    want = {}
    for number in range(4):
        rows = [(rng.choice([None, *"abcdefgh"]), rng.randrange(100), rng.randrange(20)) for _ in range(5)]
        rows = list({r[0]: r for r in rows}.values())
        for _ in range(2):  # a repeated batch changes nothing
            store.merge(frame(rows), number)
        for k, v, t in rows:
            if k not in want or t >= want[k][1]:  # of equal times the later batch
                want[k] = v, t
        assert {r["k"]: (r["v"], r["t"]) for r in store.read().collect()} == want
    assert all(len(numbers) <= store.keep for numbers in store.versions().values()), "older versions are compacted"
    before = store.versions()
    store.merge(frame([]), 4)
    store.merge(frame([("a", 1, 99)]), 5)
    touched = [b for b, v in store.versions().items() if v[0] == 5]
    assert len(touched) == 1 and all(store.versions()[b] == before[b] for b in before if b not in touched), "other buckets stay as they are"
    # A version whose write has not ended does not count.
    frame([("a", 5, 500)]).write.parquet(f"file://{tmp_path}/s/version=6/bucket_no={touched[0]}")
    assert {r["k"]: r["v"] for r in store.read().collect()}["a"] == 1
    assert {r["k"] for r in store.lookup(frame([("a", 0, 0)])).collect()} <= set(want) and "a" in {r["k"] for r in store.lookup(frame([("a", 0, 0)])).collect()}
    with pytest.raises(ValueError):
        KeyedStore(spark, "x", frame([]).withColumn("bucket_no", F.lit(1)).schema, ["k"])


def test_latest_features_whatever_the_order_of_batches(spark, tmp_path):
    schema = "transaction_id string, user_id string, device_id string, amount double, local_hour int, is_international boolean, event_timestamp timestamp"
    rng = random.Random(2)
    rows = [(f"t{i}", rng.choice("uvw"), rng.choice("de"), float(i), i % 24, None if i % 5 == 0 else i % 2 == 0, at(rng.randrange(60) * 60)) for i in range(60)]
    rng.shuffle(rows)
    store = jobs.latest(files(spark, tmp_path, [rows[:20], rows[20:40], rows[40:], rows[:10]], schema), f"file://{tmp_path}/latest", f"{tmp_path}/checkpoint", buckets=3)
    want = serving.latest_features(spark.createDataFrame(rows, schema))
    key = lambda df: sorted(map(str, df.select("entity_type", "entity_id", F.to_json("features"), "event_timestamp").collect()))
    assert key(store.read()) == key(want) and store.read().count() == 5


def plain_sliding(events, i):
    """The windows' values at events[i] (second, kind, name, amount, merchant), by looking at all up to it."""
    now, seen = events[i][0], events[: i + 1]
    out = {}
    for w, limit in (("5m", 300), ("10m", 600), ("1h", 3599)):
        txns = {(e[2], e[3]): e for e in seen if e[1] == "txn" and now - e[0] <= limit}
        out |= {f"txn_count_{w}": len(txns), f"txn_amount_sum_{w}": round(sum(a for _, a in txns), 4), f"distinct_merchants_{w}": len({e[4] for e in seen if e[1] == "txn" and now - e[0] <= limit})}
    for w, limit in (("15m", 900), ("1h", 3599)):
        out[f"failed_logins_{w}"] = len({e[0] for e in seen if e[1] == "login" and now - e[0] <= limit})
    return out


def test_sliding_values_against_plain_version():
    rng = random.Random(3)
    events = [(float(rng.choice([rng.randrange(9000), rng.randrange(30) * 300])), "txn", f"t{rng.randrange(150)}", float(rng.randrange(3)), rng.choice("mnop")) for _ in range(200)]
    events += [(float(rng.randrange(9000)), "login", "", 0.0, "") for _ in range(60)]
    events = sorted(set(events), key=lambda e: (e[0], e[1] != "login", *e[2:]))
    got = dict(jobs.sliding_values(events))
    assert got == {i: plain_sliding(events, i) for i, e in enumerate(events) if e[1] == "txn"} and len(got) > 150


def test_sliding_state_over_several_batches(spark, tmp_path):
    """Batches in order of time, a transaction that comes twice, a late row within the watermark, and one behind it (rows count as late
    by the watermark that the batch before theirs began with)."""
    first = [("t1", "u", "m", 1.5, False, at(0)), ("t2", "u", "n", 2.0, False, at(100)), ("t3", "v", "m", 4.0, False, at(50)), (None, "u", None, None, True, at(90))]
    second = [("t4", "u", "m", 8.0, False, at(390)), ("t2", "u", "n", 2.0, False, at(400)), ("t5", None, "m", 1.0, False, at(400))]
    third = [("t6", "u", "o", 16.0, False, at(200)), ("t7", "u", "m", 32.0, False, at(4000))]
    fourth, last = [("t9", "u", "m", 64.0, False, at(4001))], [("t8", "u", "m", 1.0, False, at(300))]
    events = files(spark, tmp_path, [first, second, third, fourth, last], EVENT)
    with jobs.settings(spark, jobs.ROCKSDB):
        store = jobs.upserted(jobs.sliding_features(events, "user_id"), f"file://{tmp_path}/t", ["key", "transaction_id"], f"{tmp_path}/c")
    got = {r["transaction_id"]: (r["txn_count_5m"], r["txn_count_1h"], r["txn_amount_sum_1h"], r["distinct_merchants_1h"], r["failed_logins_1h"]) for r in store.read().collect()}
    assert got == {
        "t1": (1, 1, 1.5, 1, 0), "t3": (1, 1, 4.0, 1, 0), "t4": (2, 3, 11.5, 2, 1), "t2": (2, 3, 11.5, 2, 1),
        "t6": (3, 3, 19.5, 3, 1), "t7": (1, 1, 32.0, 1, 0), "t9": (2, 2, 96.0, 1, 0),
    }


def test_idle_keys_expire_after_a_day(spark, tmp_path):
    day = 86_400
    batches = [[(f"t{i}", f"u{i}", "m", 1.0, False, at(i)) for i in range(5)], [("x1", "u9", "m", 1.0, False, at(day - 3600))], [("x2", "u9", "m", 1.0, False, at(day + 3600))], [("x3", "u9", "m", 1.0, False, at(day + 3601))]]
    rows = []

    def sink(batch, number):
        rows.append(batch.count())

    with jobs.settings(spark, jobs.ROCKSDB):
        query = jobs.run_once(jobs.sliding_features(files(spark, tmp_path, batches, EVENT), "user_id"), sink, f"{tmp_path}/c")
    held = [p["stateOperators"][0]["customMetrics"].get("numValueStateVars") is not None and p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert sum(rows) == 8 and max(held) > held[-1] and held[-1] <= 6, held  # of six keys one is left


def test_late_and_repeated_rows(spark, tmp_path):
    row = lambda i, s: (f"t{i}", "u", "m", 1.0, False, at(s))
    batches = [[row(1, 0), row(2, 10)], [row(2, 10), row(3, 5000)], [row(3, 5000)], [row(1, 0), row(4, 20), row(5, 4900)]]
    got = []
    once = jobs.deduplicated(files(spark, tmp_path, batches, EVENT))
    jobs.run_once(once, lambda batch, number: got.extend(r["transaction_id"] for r in batch.collect()), f"{tmp_path}/c", "append")
    assert sorted(got) == ["t1", "t2", "t3", "t5"]  # t4 lies behind the watermark


def test_velocity_windows_grow_over_batches(spark, tmp_path):
    schema = "transaction_id string, user_id string, merchant_id string, amount double, is_international boolean, event_timestamp timestamp"
    rows = [(f"t{i}", "uv"[i % 2], f"m{i % 3}", float(i), i % 4 == 0, at(i * 40)) for i in range(60)]
    stream = files(spark, tmp_path, [rows[:25], rows[25:40], rows[40:]], schema)
    store = jobs.upserted(jobs.user_velocity(stream.withWatermark("event_timestamp", "10 minutes"), "5m"), f"file://{tmp_path}/t", ["user_id", "window_start"], f"{tmp_path}/c")
    key = lambda df: sorted(map(str, df.withColumn("merchant_id_set", F.array_sort("merchant_id_set")).collect()))
    assert key(store.read()) == key(jobs.user_velocity(spark.createDataFrame(rows, schema), "5m"))


def test_sketches_of_any_range_of_windows(spark):
    """Many values over many windows, some of which repeat: the merged sketches are within the stated bound of exact counts."""
    df = spark.range(60_000).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), F.concat(F.lit("u"), F.col("id") % 3).alias("user_id"), F.concat(F.lit("m"), F.col("id") % 25_000).alias("merchant_id"),
        F.lit(1.0).alias("amount"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 5).alias("event_timestamp"),
    )
    buckets = jobs.velocity(df, "user_id", "1h", "merchant_id", international=False, sketch=True).cache()
    at = lambda hours: F.timestamp_seconds(F.lit(1_704_067_200 + hours * 3600))
    for first, last in ((0, None), (10, 20), (0, 1), (40, 80)):
        got = {r["user_id"]: (r["txn_count"], r["n_distinct"]) for r in jobs.velocity_merge_sketches(buckets, "user_id", "merchant_id", at(first), None if last is None else at(last)).collect()}
        rows = df.where((F.col("event_timestamp") >= at(first)) & (F.col("event_timestamp") < at(last or 10**4)))
        want = {r["user_id"]: (r["a"], r["b"]) for r in rows.groupBy("user_id").agg(F.count("*").alias("a"), F.count_distinct("merchant_id").alias("b")).collect()}
        assert set(got) == set(want) and all(got[u][0] == n and abs(got[u][1] - d) <= jobs.SKETCH_ERROR * d for u, (n, d) in want.items()), (first, last)


def test_counts_while_a_stream_runs(spark, tmp_path):
    batches = [[("a", 1), ("b", None), ("c", -1)], [("d", 2)], [("e", -5), ("f", 5)]]
    stream = jobs.observed(files(spark, tmp_path, batches, "k string, v int"), "checked", F.col("v") > 0)
    counts = jobs.counted_run(stream, jobs.apart(f"{tmp_path}/t"), f"{tmp_path}/c")
    assert counts.totals["checked"] == Counter(good=3, bad=3) and counts.batches["checked"] == 3
    assert counts.rows_read == 6, "the source is read once"
    assert sorted(r["k"] for r in jobs.read_apart(spark, f"{tmp_path}/t", False).collect()) == ["b", "c", "e"]
    assert sorted(r["k"] for r in jobs.read_apart(spark, f"{tmp_path}/t", True).collect()) == ["a", "d", "f"]


@pytest.mark.parametrize("kind", ["gbt", "gaussian"])
def test_scores_of_a_stream(spark, tmp_path, kind):
    """The stream's scores are the batch's, follow the snapshot, and take in a snapshot that changes between batches."""
    schema = "transaction_id string, device_id string, amount double, event_timestamp timestamp"
    rng = random.Random(4)
    devices = [(f"d{i}", i % 10) for i in range(40)]
    rows = [(f"t{i:03}", f"d{rng.randrange(44)}", rng.random() * 10, at(i)) for i in range(300)]
    stores = {"device_id": KeyedStore(spark, f"file://{tmp_path}/d", spark.createDataFrame([], "device_id string, n long").schema, ["device_id"], buckets=4)}
    stores["device_id"].merge(spark.createDataFrame(devices, "device_id string, n long"), 0)
    empty = scoring.StreamScorer(["amount", "n", "not_there"], None, None, stores)
    batch = spark.createDataFrame(rows, schema)
    learn = empty.with_features(batch).withColumn("is_fraud", (F.col("n") + F.col("amount") / 5 > 6).cast("int"))
    scorer = scoring.StreamScorer(empty.features, *evaluation.train_classifier(learn, empty.features, kind=kind, trees=5, depth=3), stores)
    want = {r["transaction_id"]: r["fraud_score"] for r in scorer.score(batch).collect()}
    again = {r["transaction_id"]: r["fraud_score"] for r in evaluation.scored(empty.with_features(batch), scorer.features, scorer.assembler, scorer.model).collect()}
    assert want == again and len(set(want.values())) > 1
    stream = jobs.observed(files(spark, tmp_path, [rows[:150], rows[150:]], schema), "scored", F.col("amount") > 0.5)
    write = scorer.sink(f"{tmp_path}/t")

    def sink(part, number):
        if number == 1:  # all devices fall to 0 between the batches
            stores["device_id"].merge(spark.createDataFrame([(d, 0) for d, _ in devices], "device_id string, n long"), 1)
        write(part, number)

    counts = jobs.counted_run(stream, sink, f"{tmp_path}/c")
    got = {r["transaction_id"]: r["fraud_score"] for r in jobs.read_apart(spark, f"{tmp_path}/t", True).collect()}
    later = {r["transaction_id"]: r["fraud_score"] for r in scorer.score(batch).collect()}
    good = [r for r in rows if r[2] > 0.5]
    assert got == {r[0]: (want if i < len([x for x in rows[:150] if x[2] > 0.5]) else later)[r[0]] for i, r in enumerate(good)}
    assert any(want[t] != later[t] for t in want) and counts.totals["scored"] == Counter(good=len(good), bad=300 - len(good))
    bad = jobs.read_apart(spark, f"{tmp_path}/t", False)
    assert bad.count() == 300 - len(good) and bad.where("fraud_score IS NOT NULL OR is_flagged IS NOT NULL").count() == 0


def test_parity_of_two_streams(spark, small):
    """What one of two streams loses shows in the rate; that both agree on what both get is the registered query's SQL."""
    t = queries.Tables(spark, small)
    lossy = queries._parity(t, "transaction_id LIKE '%7'").first()
    whole = t.txns.select("user_id", F.window("event_timestamp", "1 hour")).distinct().count()
    assert 0 < lossy["n"] < whole and lossy["off_rate"] > 0


def many_files(spark, small, folder, copies=5):
    """The given events again and again under keys of their own, each copy a file over all the time."""
    events = spark.read.parquet(f"{small}/events.parquet").coalesce(1)
    n = events.count()
    for i in range(copies):
        events.withColumns({"event_id": F.col("event_id") + i * n, "user_id": F.col("user_id") + i * 10**6}).write.mode("append").parquet(f"{folder}/events.parquet")
    return queries.Tables(spark, str(folder))


def test_slices_of_a_stream_are_batches_however_many_files_they_take(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 400, raising=False)
    t, spans = many_files(spark, small, tmp_path), []
    jobs.run_once(queries._stream(t), lambda batch, number: spans.append(tuple(batch.agg(F.min("event_timestamp"), F.max("event_timestamp"), F.count("*")).first())), f"{tmp_path}/c", "append")
    assert len(spans) == 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False)), spans
    assert sum(n for *_, n in spans) == t.raw("stream_transactions").count()


def test_failed_logins_of_a_table_of_many_files(spark, small, tmp_path):
    """Each transaction sees the failed logins before it, as a join has them."""
    t = many_files(spark, small, tmp_path)
    second = F.unix_timestamp("event_timestamp").alias("s")
    txns = t.raw("stream_transactions").where("amount > 0").select("user_id", "transaction_id", second)
    failed = t.raw("raw_login_events").where("lower(trim(login_status)) = 'failed'").select("user_id", second).distinct()
    near = (F.col("t.user_id") == F.col("l.user_id")) & (F.col("l.s") > F.col("t.s") - 3600) & (F.col("l.s") <= F.col("t.s"))
    joined = txns.alias("t").join(failed.alias("l"), near, "left").groupBy("t.transaction_id").agg(F.count(F.when(F.col("l.s") >= F.col("t.s") - 900, 1)).alias("a"), F.count("l.s").alias("b"))
    want = sorted(map(tuple, joined.collect()))
    got = queries.QUERIES["login_failure_state"](spark, str(tmp_path)).select("transaction_id", "failed_logins_15m", "failed_logins_1h")
    assert sorted(map(tuple, got.collect())) == want and any(b for *_, b in want)


def test_parity_of_a_table_of_many_files(spark, small, tmp_path):
    t = many_files(spark, small, tmp_path)
    got = queries._parity(t).first()
    assert got["n"] == t.txns.select("user_id", F.window("event_timestamp", "1 hour")).distinct().count() and got["off_rate"] == 0
