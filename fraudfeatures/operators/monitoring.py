"""Score logs, dashboards' numbers, drift, and comparisons of models and of training with serving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudfeatures.operators.evaluation import quantiles, ranking_metrics, risk_band, unpivoted
from fraudfeatures.operators.quantiles import exact_quantiles


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in this order."""
    newest = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(newest).select("row.*")


def new_rows(new: DataFrame, stored: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """What to append: the first new row of each key that is not stored yet."""
    return first_per_key(new, keys, order).join(stored.select(*keys).distinct(), keys, "left_anti").select(new.columns)


def append_score_log(new: DataFrame, stored: DataFrame) -> DataFrame:
    return new_rows(new, stored, ["transaction_id", "model_version"], ["scored_at"])


def append_feature_log(new: DataFrame, stored: DataFrame, features: list[str]) -> DataFrame:
    """Nulls become 0; one row for each transaction, the first wins."""
    return new_rows(new.fillna(0, features), stored, ["transaction_id"], ["scored_at"])


def recent_scores(scores: DataFrame, n: int, *conditions: Column) -> DataFrame:
    for c in conditions:
        scores = scores.where(c)
    return scores.orderBy(F.desc("scored_at"), "transaction_id").limit(n)


def score_kpis(scores: DataFrame, now: Column, threshold: float = 0.5) -> DataFrame:
    """One row: the last 24 hours' number, shares flagged and critical, mean and 95th percentile of latency, how many of
    each band in 24 hours, 7 and 30 days, and, where the log has their columns, how often the two feature sources answered."""
    age, band = F.unix_timestamp(now) - F.unix_timestamp("scored_at"), risk_band(F.col("fraud_score"))
    last = lambda days: (age >= 0) & (age < days * 86400)
    day = last(1)
    share = lambda c: F.round(F.avg(F.when(day, F.when(c, 1.0).otherwise(0.0))), 9)
    sources = [c for c in ("feast_offline_ok", "redis_online_ok") if c in scores.columns]
    rows = scores.where(last(30))
    counts = rows.agg(
        F.count_if(day).alias("scored_24h"),
        share(F.col("fraud_score") >= threshold).alias("flagged_24h"),
        share(band == "critical").alias("critical_24h"),
        F.round(F.avg(F.when(day, F.col("fraud_score"))), 9).alias("mean_score_24h"),
        *(share(F.coalesce(F.col(c), F.lit(False))).alias(f"{c}_24h") for c in sources),
        *(F.count_if(last(d) & (band == b)).alias(f"{b}_{d}d") for d in (1, 7, 30) for b in ("low", "medium", "high", "critical")),
    )
    slow = exact_quantiles(rows.where(day), [], "latency_ms", [0.95])
    return counts.join(slow.select(F.col("quantiles")[0].alias("p95_latency_24h")), F.lit(True), "left")  # a row each, or none


def hourly_flag_rate(scores: DataFrame, now: Column, hours: int = 48, threshold: float = 0.5) -> DataFrame:
    age = F.unix_timestamp(now) - F.unix_timestamp("scored_at")
    rows = scores.where((age >= 0) & (age < hours * 3600)).groupBy(F.date_trunc("hour", "scored_at").alias("hour"))
    return rows.agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("fraud_score") >= threshold, 1.0).otherwise(0.0)), 9).alias("flag_rate"))


LATENCIES = (50, 95, 99)


def score_snapshot_daily(scores: DataFrame, exact: bool = True) -> DataFrame:
    """For each model and day: number, mean, spread, shares, latencies' percentiles, histogram and bands. exact: percentiles by
    selection, else within 1 / 10,000 of the rank, in the same pass as the rest."""
    s, band = F.col("fraud_score"), risk_band(F.col("fraud_score"))
    rows, keys = scores.withColumn("day", F.to_date("scored_at")), ["model_version", "day"]
    out = rows.groupBy(keys).agg(
        F.count("*").alias("n"),
        F.round(F.avg(s), 9).alias("mean_score"),
        F.round(F.stddev_pop(s), 9).alias("std_score"),
        F.round(F.avg(F.when(s > 0.5, 1.0).otherwise(0.0)), 9).alias("share_over_50"),
        F.round(F.avg(F.when(s > 0.8, 1.0).otherwise(0.0)), 9).alias("share_over_80"),
        *([] if exact else [quantiles(F.col("latency_ms"), [p / 100 for p in LATENCIES]).alias("quantiles")]),
        *(F.count_if(F.floor(s * 10) == i).alias(f"bin_{i}") for i in range(10)),
        *(F.count_if(band == b).alias(f"n_{b}") for b in ("low", "medium", "high", "critical")),
    )
    if exact:
        out = _joined(out, exact_quantiles(rows, keys, "latency_ms", [p / 100 for p in LATENCIES]).drop("n"), keys)
    return out.withColumns({f"p{p}_latency": F.round(F.col("quantiles")[i], 9) for i, p in enumerate(LATENCIES)}).drop("quantiles")


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with right's other columns where all keys are equal, nulls included."""
    of = {k: f"{k}_of" for k in keys}
    right = right.withColumnsRenamed(of)
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in of.items()]
    return left.join(right, same, "left").drop(*of.values())


def psi(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10, exact: bool = True) -> DataFrame:
    """feature, psi: how far the current values have moved between the reference's quantile bins; shares are 1e-6 at least, so that a
    table without values counts as one whose bins all hold that. A feature without reference values has no bins and gives no row.
    exact: quantiles by selection, else within 1 / 10,000 of the rank."""
    ref, cur = unpivoted(reference, columns), unpivoted(current, columns)
    shares = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(ref, ["feature"], "value", shares) if exact else ref.groupBy("feature").agg(quantiles(F.col("value"), shares).alias("quantiles"))
    edges = edges.select("feature", F.array_distinct("quantiles").alias("edges"))
    # A row for each feature.
    place = lambda df: df.join(F.broadcast(edges), "feature").select("feature", F.size(F.filter("edges", lambda e: e < F.col("value"))).alias("bin"))
    both = place(ref).withColumn("r", F.lit(1)).withColumn("c", F.lit(0)).unionByName(place(cur).withColumn("r", F.lit(0)).withColumn("c", F.lit(1)))
    counts = both.groupBy("feature", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    total = Window.partitionBy("feature")
    p, q = (F.greatest(F.col(c) / F.greatest(F.sum(c).over(total), F.lit(1)), F.lit(1e-6)) for c in ("c", "r"))
    return counts.withColumn("part", (p - q) * F.log(p / q)).groupBy("feature").agg(F.round(F.sum("part"), 6).alias("psi"))


KS_BUCKETS = 256


def ks_statistic(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """feature, ks: the largest distance between the two empirical distributions. Values are counted, the counts added up in
    buckets of about equal numbers of values first and then within each, so that no task sorts all values of a feature."""
    r, c = unpivoted(reference, columns).withColumns({"r": F.lit(1), "c": F.lit(0)}), unpivoted(current, columns).withColumns({"r": F.lit(0), "c": F.lit(1)})
    counts = r.unionByName(c).groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    edges = counts.groupBy("feature").agg(F.percentile_approx("value", F.array(*(F.lit(i / KS_BUCKETS) for i in range(1, KS_BUCKETS))), 2000).alias("edges"))
    # A row for each feature.
    counts = counts.join(F.broadcast(edges), "feature").withColumn("bucket", F.size(F.filter("edges", lambda e: e < F.col("value")))).drop("edges")
    before, all_ = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("feature")
    sums = counts.groupBy("feature", "bucket").agg(F.sum("r").alias("r_in"), F.sum("c").alias("c_in"))
    sums = sums.select("feature", "bucket", *(F.coalesce(F.sum(f"{x}_in").over(before), F.lit(0)).alias(f"{x}_before") for x in "rc"), *(F.sum(f"{x}_in").over(all_).alias(f"{x}_all") for x in "rc"))
    within = Window.partitionBy("feature", "bucket").orderBy("value")
    rows = counts.select("feature", "bucket", *(F.sum(x).over(within).alias(f"{x}_upto") for x in "rc")).join(sums, ["feature", "bucket"])
    cdf = lambda x: (F.col(f"{x}_upto") + F.col(f"{x}_before")) / F.greatest(F.col(f"{x}_all"), F.lit(1))
    return rows.groupBy("feature").agg(F.round(F.max(F.abs(cdf("r") - cdf("c"))), 9).alias("ks"))


def drift_alerts(psis: DataFrame, rows: int, warn: float = 0.1, severe: float = 0.2, least_rows: int = 100) -> DataFrame:
    """The level of each feature; with fewer rows than least_rows it is skipped."""
    level = F.when(F.col("psi") > severe, "severe").when(F.col("psi") >= warn, "moderate").otherwise("none")
    return psis.select("feature", "psi", (F.lit("skipped") if rows < least_rows else level).alias("level"))


def retrain(alerts: DataFrame, critical: float = 0.5, least: int = 3) -> DataFrame:
    n = F.count_if(F.col("psi") >= critical)
    return alerts.agg(n.alias("critical_features"), (n >= least).alias("retrain"))


def labelled(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """score and label of scores whose transaction is labelled."""
    known = labels.select("transaction_id", F.col("is_fraud").cast("int").alias("label"))
    return scores.join(known, "transaction_id").withColumn("score", F.col("fraud_score"))


def labelled_performance(scores: DataFrame, labels: DataFrame, now: Column, days: int = 30, threshold: float = 0.5) -> DataFrame:
    """For each day of the last `days`: rows, flag rate, roc_auc and pr_auc on labelled scores."""
    age = F.unix_timestamp(now) - F.unix_timestamp("scored_at")
    rows = labelled(scores, labels).where((age >= 0) & (age < days * 86400)).withColumn("day", F.to_date("scored_at"))
    rate = F.round(F.avg(F.when(F.col("score") >= threshold, 1.0).otherwise(0.0)), 9)
    counts = rows.groupBy("day").agg(F.count("*").alias("n"), rate.alias("flag_rate"))
    return counts.join(ranking_metrics(rows.select("day", "score", "label"), ["day"]).drop("recall_at_precision"), "day", "left")


def label_feedback(scores: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """For each day: label coverage, median lag in hours and the share of false alarms among flagged and labelled scores."""
    known = labels.select("transaction_id", "is_fraud", "label_timestamp")
    rows = scores.join(known, "transaction_id", "left")
    lag = (F.unix_timestamp("label_timestamp") - F.unix_timestamp("scored_at")) / 3600
    false = F.when((F.col("fraud_score") >= threshold) & F.col("is_fraud").isNotNull(), F.when(F.col("is_fraud"), 0.0).otherwise(1.0))
    rows = rows.withColumn("day", F.to_date("scored_at"))
    out = rows.groupBy("day").agg(
        F.count("*").alias("n"),
        F.round(F.avg(F.col("is_fraud").isNotNull().cast("double")), 9).alias("coverage"),
        F.round(F.avg(false), 9).alias("false_alarm_rate"),
    )
    medians = exact_quantiles(rows, ["day"], lag, [0.5]).select("day", F.round(F.col("quantiles")[0], 6).alias("median_lag_hours"))
    return _joined(out, medians, ["day"])


def model_comparison(champion: DataFrame, challenger: DataFrame, labels: DataFrame, threshold: float = 0.5, gain: float = 1.05) -> DataFrame:
    """Both models on the transactions that both scored: model, n, roc_auc, pr_auc, flag_rate, and whether the challenger's
    pr_auc is more than `gain` times the champion's."""
    pairs = champion.select("transaction_id", F.col("fraud_score").alias("champion")).join(challenger.select("transaction_id", F.col("fraud_score").alias("challenger")), "transaction_id")
    known = labels.select("transaction_id", F.col("is_fraud").cast("int").alias("label"))
    stack = F.stack(F.lit(2), F.lit("champion"), F.col("champion"), F.lit("challenger"), F.col("challenger")).alias("model", "score")
    rows = pairs.join(known, "transaction_id").select("label", stack)
    counts = rows.groupBy("model").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("score") >= threshold, 1.0).otherwise(0.0)), 9).alias("flag_rate"))
    both = counts.join(ranking_metrics(rows, ["model"]).drop("recall_at_precision"), "model")
    of = lambda m: F.max(F.when(F.col("model") == m, F.col("pr_auc"))).over(Window.partitionBy())
    return both.withColumn("promote", (F.col("model") == "challenger") & (of("challenger") > gain * of("champion")))


def training_serving_skew(served: DataFrame, recomputed: DataFrame, columns: list[str], tolerance: float = 0.01) -> DataFrame:
    """feature, n, mismatch_rate: how often the served value is more than the tolerance off the recomputed one, relative to it."""
    a = served.select("transaction_id", *(F.col(c).cast("double").alias(f"s_{c}") for c in columns))
    both = a.join(recomputed.select("transaction_id", *(F.col(c).cast("double").alias(f"r_{c}") for c in columns)), "transaction_id")
    stack = F.stack(F.lit(len(columns)), *(x for c in columns for x in (F.lit(c), F.col(f"s_{c}"), F.col(f"r_{c}"))))
    rows = both.select(stack.alias("feature", "s", "r"))
    off = F.abs(F.col("s") - F.col("r")) > tolerance * F.greatest(F.abs("r"), F.lit(1e-9))
    return rows.groupBy("feature").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.coalesce(off, F.lit(True)), 1.0).otherwise(0.0)), 9).alias("mismatch_rate"))


def feature_freshness(views: dict[str, tuple[DataFrame, list[str]]], now: Column, cadence: int) -> DataFrame:
    """For each view's features: the view's newest time, whether that is older than twice the cadence (seconds), the share of
    nulls, and quartiles (exact, by selection)."""
    out = None
    for name, (df, columns) in views.items():
        wide = df.agg(F.max("event_timestamp").alias("newest"), F.count("*").alias("n"), *(F.count(c).alias(f"n_{c}") for c in columns))
        stack = F.stack(F.lit(len(columns)), *(x for c in columns for x in (F.lit(c), F.col(f"n_{c}"))))
        rows = wide.select("newest", "n", stack.alias("feature", "known"))
        stale = F.unix_timestamp(now) - F.unix_timestamp("newest") > 2 * cadence
        rows = rows.select(F.lit(name).alias("view_name"), "feature", "newest", stale.alias("stale"), F.round(1 - F.col("known") / F.col("n"), 9).alias("null_rate"))
        quartiles = exact_quantiles(unpivoted(df, columns), ["feature"], "value", [0.25, 0.5, 0.75])
        quartiles = quartiles.select("feature", *(F.round(F.col("quantiles")[i], 6).alias(p) for i, p in enumerate(("p25", "p50", "p75"))))
        rows = rows.join(quartiles, "feature", "left")
        out = rows if out is None else out.unionByName(rows)
    return out


def top_risky(scores: DataFrame, n: int = 10) -> DataFrame:
    order = Window.partitionBy("day").orderBy(F.desc("fraud_score"), "transaction_id")
    return scores.withColumn("day", F.to_date("scored_at")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def score_detail(scores: DataFrame, features: DataFrame) -> DataFrame:
    return scores.join(features.drop("user_id", "device_id", "merchant_id", "event_timestamp"), "transaction_id", "left")


def retained(df: DataFrame, ts: str, now: Column, days: int) -> DataFrame:
    """Rows of the last `days` days, by date, so that whole day partitions stay or go."""
    return df.where(F.datediff(F.to_date(now), F.to_date(ts)) < days)
