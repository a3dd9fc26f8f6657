"""Structured Streaming jobs: landing, deduplication, velocity windows, sliding state and scored streams.

Aggregations are functions that run on batches and streams alike. Windows are kept in update mode and written with
foreachBatch, so that a window shows from its first event on; rows later than the watermark are dropped.
"""

from __future__ import annotations

import time
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener

from fraudfeatures.operators import serving
from fraudfeatures.streaming.store import KeyedStore

WATERMARK = "10 minutes"
WINDOWS = {"5m": "5 minutes", "1h": "1 hour", "24h": "1 day"}


def landed(stream: DataFrame) -> DataFrame:
    """What a landing table gets: the rows, when they came, and the month they belong to."""
    return stream.withColumns({"ingested_at": F.current_timestamp(), "event_month": F.date_format("event_timestamp", "yyyyMM")})


def land(stream: DataFrame, path: str, checkpoint: str):
    return landed(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("event_month").option("path", path)


def deduplicated(stream: DataFrame, id: str = "transaction_id", watermark: str = WATERMARK) -> DataFrame:
    """One row of each id: on a stream within the watermark, in a batch over all."""
    if stream.isStreaming:
        return stream.withWatermark("event_timestamp", watermark).dropDuplicatesWithinWatermark([id])
    return stream.dropDuplicates([id])


def velocity(txns: DataFrame, key: str, window: str, distinct: str, international: bool = True, sketch: bool = False) -> DataFrame:
    """Tumbling windows of a key: txn_count, txn_amount, the set of distinct values (or a sketch of it), and for users the
    number of international transactions. Amounts are added as exact decimals."""
    parts = [
        F.count("*").alias("txn_count"),
        F.sum(F.col("amount").cast("decimal(18,4)")).cast("double").alias("txn_amount"),
        (F.hll_sketch_agg(distinct) if sketch else F.collect_set(distinct)).alias(f"{distinct}_set"),
    ]
    if international:
        parts.append(F.count_if("is_international").alias("intl_count"))
    return txns.groupBy(key, F.window("event_timestamp", WINDOWS[window]).alias("w")).agg(*parts).select(
        key, F.col("w.start").alias("window_start"), "txn_count", "txn_amount", f"{distinct}_set", *(["intl_count"] if international else [])
    )


def user_velocity(txns: DataFrame, window: str) -> DataFrame:
    return velocity(txns, "user_id", window, "merchant_id")


def device_velocity(txns: DataFrame, window: str) -> DataFrame:
    return velocity(txns, "device_id", window, "user_id", international=False)


def latest(stream: DataFrame, path: str, checkpoint: str, buckets: int = 32) -> KeyedStore:
    """Keeps the latest features of each user and device of a stream of transactions: a batch is reduced to a row for each entity
    before it is merged, and the newest event time wins, of equal ones the larger transaction id, in whatever order batches come."""
    rows = serving.latest_rows(stream)
    return upserted(rows, path, ["entity_type", "entity_id"], checkpoint, ["event_timestamp", "transaction_id"], buckets)


def velocity_merge(buckets: DataFrame, key: str, distinct: str, since: Column) -> DataFrame:
    """Stored windows from `since` on, merged per key."""
    rows = buckets.where(F.col("window_start") >= since)
    sets = rows.select(key, F.explode(f"{distinct}_set").alias("v")).groupBy(key).agg(F.count_distinct("v").alias("n_distinct"))
    sums = rows.groupBy(key).agg(F.sum("txn_count").alias("txn_count"), F.sum(F.col("txn_amount").cast("decimal(28,4)")).cast("double").alias("txn_amount"))
    return sums.join(sets, key, "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))


#: Three standard errors of a sketch of 2**12 registers, relative to the count. Small counts are nearly exact.
SKETCH_ERROR = 0.05


def velocity_merge_sketches(buckets: DataFrame, key: str, distinct: str, since: Column, until: Column | None = None) -> DataFrame:
    """Stored windows with sketches (velocity with sketch=True) from `since` on, and before `until` if given, merged per key: txn_count,
    txn_amount and n_distinct, which is within SKETCH_ERROR but for one key in some hundred. A sketch has a few KB at most, however
    many values it has seen, so that a key's windows are merged task by task."""
    rows = buckets.where(F.col("window_start") >= since)
    rows = rows if until is None else rows.where(F.col("window_start") < until)
    return rows.groupBy(key).agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum(F.col("txn_amount").cast("decimal(28,4)")).cast("double").alias("txn_amount"),
        F.hll_sketch_estimate(F.hll_union_agg(f"{distinct}_set")).alias("n_distinct"),
    )


def finished_velocity(txns: DataFrame, key: str, distinct: str) -> DataFrame:
    """The hourly windows of a stream with a watermark, each once, when that has passed its end: key, window_end, txn_count. For append
    mode."""
    rows = velocity(txns, key, "1h", distinct, international=False)
    return rows.select(F.col(key).alias("key"), (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"), "txn_count")


#: Keys share the state of their bucket. A batch costs a bucket a few calls of the state, whatever keys it has.
STATE_BUCKETS = 256


def _by_bucket(rows: DataFrame):
    return rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(STATE_BUCKETS)).cast("int")).groupBy("bucket")


class SlidingEnds(StatefulProcessor):
    """For a bucket's keys the number of transactions in the hour before each full hour in whose own hour a key had any, each counted once
    by second and id.

    Transactions are appended to a list, and a bucket has one timer, at the first full hour that is not answered yet: it answers all full
    hours that the watermark has passed, keeps what comes after them, and moves on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "key string, s double, id string")
        self.next = handle.getValueState("next", "end long")

    def _wait(self, end: int) -> None:
        self.handle.registerTimer(end * HOUR * 1000)
        self.next.update((end,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            self.waiting.appendList([(k, float(s), i or "") for k, s, i in zip(part["key"], part["s"], part["transaction_id"], strict=True)])
            end = int(part["s"].min() // HOUR) + 1
            first = end if first is None else min(first, end)
        timer = self.next.get()
        if first is not None and (timer is None or first < timer[0]):
            if timer is not None:
                self.handle.deleteTimer(timer[0] * HOUR * 1000)
            self._wait(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) // (HOUR * 1000)
        entries = set(map(tuple, self.waiting.get()))
        later = sorted(e for e in entries if e[1] // HOUR + 1 > passed)
        if later:
            self.waiting.put(later)
            self._wait(int(min(s for _, s, _ in later) // HOUR) + 1)
        else:
            self.waiting.clear()
            self.next.clear()
        counts = Counter((k, int(s // HOUR) + 1) for k, s, _ in entries if s // HOUR + 1 <= passed)
        if counts:
            keys, ends = zip(*counts, strict=True)
            yield pd.DataFrame({"key": keys, "window_end": pd.to_datetime([end * HOUR for end in ends], unit="s"), "txn_count": list(counts.values())})

    def close(self) -> None:
        pass


def sliding_at_ends(txns: DataFrame, key: str) -> DataFrame:
    """The sliding hour at the end of each hour, of a stream with a watermark: key, window_end, txn_count. For append mode; needs ROCKSDB
    as the state store."""
    rows = txns.where(F.col(key).isNotNull()).select("event_timestamp", F.col(key).alias("key"), "transaction_id", F.unix_timestamp("event_timestamp").cast("double").alias("s"))
    return _by_bucket(rows).transformWithStateInPandas(SlidingEnds(), "key string, window_end timestamp, txn_count long", "append", "eventTime")


def parity_rows(buckets: DataFrame, sliding: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Joins two streams of (key, window_end, txn_count) by key and event time: key, window_end, buckets_count, sliding_count. Neither side
    waits for longer than the watermark's delay."""
    a = buckets.withWatermark("window_end", watermark).withColumnRenamed("txn_count", "buckets_count").alias("a")
    b = sliding.withWatermark("window_end", watermark).withColumnRenamed("txn_count", "sliding_count").alias("b")
    joined = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.window_end") == F.col("b.window_end")))
    return joined.select("a.key", "a.window_end", "buckets_count", "sliding_count")


def velocity_parity(both: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """n and off_rate of parity_rows: the share of counts that differ by more than the tolerance."""
    off = F.abs(F.col("buckets_count") - F.col("sliding_count")) > tolerance * F.greatest("sliding_count", F.lit(1))
    return both.agg(F.count("*").alias("n"), F.round(F.avg(F.when(off, 1.0).otherwise(0.0)), 9).alias("off_rate"))


def landed_run(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Everything there is of a stream, appended to files."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


#: Seconds of each window, and whether an event exactly so old still counts. What is an hour old is gone.
SPANS = {"5m": (300, True), "10m": (600, True), "15m": (900, True), "1h": (3600, False)}
TXN_WINDOWS, LOGIN_WINDOWS = ("5m", "10m", "1h"), ("15m", "1h")
HOUR, IDLE_MS = 3600, 86_400_000
SLIDING_SCHEMA = (
    "key string, transaction_id string, s double, txn_count_5m long, txn_count_10m long, txn_count_1h long, txn_amount_sum_5m double, "
    "txn_amount_sum_10m double, txn_amount_sum_1h double, distinct_merchants_5m long, distinct_merchants_10m long, "
    "distinct_merchants_1h long, failed_logins_15m long, failed_logins_1h long"
)


class _Held:
    """How many distinct members lie in a window, and the sum of their amounts, exact to a part in 2**40."""

    def __init__(self):
        self.times: Counter = Counter()
        self.total = 0

    def add(self, member, amount: float) -> None:
        self.times[member] += 1
        if self.times[member] == 1:
            self.total += round(amount * 2**40)

    def drop(self, member, amount: float) -> None:
        self.times[member] -= 1
        if not self.times[member]:
            del self.times[member]
            self.total -= round(amount * 2**40)


def sliding_values(events: list[tuple], asked: set[int] | None = None) -> Iterator[tuple[int, dict]]:
    """From events (second, kind, name, amount, merchant) in order, (place, the windows' values up to it) of each transaction, or those asked for.

    A transaction of one id and amount counts once in a window, a merchant once, and failed logins of one second once. Each window has a
    running state of its own that every event enters once and leaves once.
    """
    state = {(kind, w): _Held() for kind, windows in (("txn", TXN_WINDOWS), ("merchant", TXN_WINDOWS), ("login", LOGIN_WINDOWS)) for w in windows}
    first = dict.fromkeys(SPANS, 0)

    def members(event: tuple):
        s, kind, name, amount, merchant = event
        return [("login", s, 0.0)] if kind == "login" else [("txn", (name, amount), amount), ("merchant", merchant, 0.0)]

    for i, event in enumerate(events):
        for kind, member, amount in members(event):
            for w in LOGIN_WINDOWS if kind == "login" else TXN_WINDOWS:
                state[kind, w].add(member, amount)
        for w, (seconds, inclusive) in SPANS.items():
            while (age := event[0] - events[first[w]][0]) > seconds or (age == seconds and not inclusive):
                for kind, member, amount in members(events[first[w]]):
                    if (kind, w) in state:
                        state[kind, w].drop(member, amount)
                first[w] += 1
        if event[1] == "txn" and (asked is None or i in asked):
            out = {f"txn_count_{w}": len(state["txn", w].times) for w in TXN_WINDOWS}
            out |= {f"txn_amount_sum_{w}": round(state["txn", w].total / 2**40, 4) for w in TXN_WINDOWS}
            out |= {f"distinct_merchants_{w}": len(state["merchant", w].times) for w in TXN_WINDOWS}
            yield i, out | {f"failed_logins_{w}": len(state["login", w].times) for w in LOGIN_WINDOWS}


class SlidingState(StatefulProcessor):
    """The last hour of a bucket's users' or devices' transactions and failed logins, in typed state.

    Each transaction gives a row with its windows' values by event time, among all that is known of its key when it comes; what is an
    hour or more older than the key's newest event is trimmed, and a key that the watermark has left a day behind goes when its bucket
    gets rows. A timer clears the bucket when the watermark passes a day after its newest event. (TTL of states goes by the clock alone,
    so it could not be replayed.)
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "key string, second double, kind string, name string, amount double, merchant string")
        self.timer = handle.getValueState("timer", "ends long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[str, set] = defaultdict(set)
        for part in rows:
            for k, s, is_login, name, amount, merchant in zip(*(part[c] for c in ("key", "s", "is_login", "transaction_id", "amount", "merchant_id")), strict=True):
                new[k].add((float(s), "login", "", 0.0, "") if is_login else (float(s), "txn", name or "", float(amount), merchant or ""))
        held: dict[str, list] = defaultdict(list)
        for k, *event in self.held.get():
            held[k].append(tuple(event))
        out = []
        for k, added in new.items():
            since = min(e[0] for e in added) - HOUR
            events = sorted(added.union(e for e in held.get(k, ()) if e[0] > since), key=lambda e: (e[0], e[1] != "login", e[2], e[3], e[4]))
            asked = {i for i, e in enumerate(events) if e in added}
            out += [{"key": k, "transaction_id": events[i][2], "s": events[i][0], **values} for i, values in sliding_values(events, asked)]
            known = added.union(held.get(k, ()))
            newest = max(e[0] for e in known)
            held[k] = sorted(e for e in known if e[0] > newest - HOUR)

        watermark = timerValues.getCurrentWatermarkInMs()
        kept = [(k, *e) for k, events in held.items() if (max(e[0] for e in events)) * 1000 + IDLE_MS > watermark for e in events]
        self.held.put(kept) if kept else self.held.clear()
        timer = self.timer.get()
        ends = max(int(max((e[1] for e in kept), default=0) * 1000), watermark) + IDLE_MS
        if timer is None or timer[0] != ends:
            if timer is not None:
                self.handle.deleteTimer(timer[0])
            self.handle.registerTimer(ends)
            self.timer.update((ends,))
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        self.timer.clear()
        return iter(())

    def close(self) -> None:
        pass


def sliding_features(events: DataFrame, key: str, watermark: str = WATERMARK) -> DataFrame:
    """A stream of (key, transaction_id, merchant_id, amount, is_login, event_timestamp) as a stream of each transaction's sliding
    features. Needs ROCKSDB as the state store. Rows with a null key are left out."""
    rows = events.withWatermark("event_timestamp", watermark).where(F.col(key).isNotNull()).select(
        "event_timestamp", F.col(key).alias("key"), "transaction_id", "merchant_id", F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"), "is_login",
        F.unix_timestamp("event_timestamp").cast("double").alias("s"),
    )
    return _by_bucket(rows).transformWithStateInPandas(SlidingState(), SLIDING_SCHEMA, "update", "eventTime")


ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these settings; a stream keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Counts(StreamingQueryListener):
    """Adds up what streams observe while they run (DataFrame.observe): totals[name of the observation][metric]. Batches that are
    repeated after a failure report again, so that a count is one of rows handled."""

    def __init__(self):
        self.totals: dict[str, Counter] = {}
        self.batches: Counter = Counter()
        self.rows_read = 0
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows_read += event.progress.numInputRows
        for name, row in event.progress.observedMetrics.items():
            self.batches[name] += 1
            self.totals.setdefault(name, Counter()).update({k: v or 0 for k, v in row.asDict().items()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def observed(stream: DataFrame, name: str, good: Column) -> DataFrame:
    """The stream, with `is_good` (a null is bad), counted as good and bad while it passes by."""
    out = stream.withColumn("is_good", F.coalesce(good, F.lit(False)))
    return out.observe(name, F.count_if("is_good").alias("good"), F.count_if(~F.col("is_good")).alias("bad"))


def counted_run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", wait: float = 60.0) -> Counts:
    """run_once, and what it observed."""
    counts = Counts()
    streams = stream.sparkSession.streams
    streams.addListener(counts)
    try:
        query = run_once(stream, sink, checkpoint, mode)
        ends = time.monotonic() + wait
        while str(query.runId) not in counts.ended and time.monotonic() < ends:  # events come a little after the end
            time.sleep(0.05)
    finally:
        streams.removeListener(counts)
    return counts


def apart(path: str, part: str = "is_good") -> Callable[[DataFrame, int], None]:
    """A sink that writes a batch in one pass, good and bad rows to folders of their own; a repeated batch replaces itself."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy(part).parquet(f"{path}/batch={number}")

    return sink


def read_apart(spark: SparkSession, path: str, good: bool) -> DataFrame:
    """The good or the bad rows that `apart` has written."""
    return spark.read.option("basePath", path).parquet(path).where(F.col("is_good") == good).drop("batch", "is_good")


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update"):
    """Everything there is, in as many batches as the source is cut into, then an end; the ended query."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upserted(stream: DataFrame, path: str, keys: list[str], checkpoint: str, order: list[str] | None = None, buckets: int = 32) -> KeyedStore:
    """Runs a stream in update mode into a store of the newest row of each key."""
    store = KeyedStore(stream.sparkSession, path, stream.schema, keys, order, buckets)
    run_once(stream, store.merge, checkpoint)
    return store
