"""Training sets and the evaluation of scores: sampling, splits, scaling, encoding, thresholds, curves and calibration."""

from __future__ import annotations

from math import exp

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudfeatures.operators.quantiles import exact_quantiles
from fraudfeatures.sources.work import fresh, stored

BANDS = ((0.80, "critical"), (0.50, "high"), (0.20, "medium"))


def _share(id: Column, fraction: float) -> Column:
    """Whether the first eight hex digits of a hash lie under the fraction."""
    return F.substring(F.md5(id), 1, 8) < F.lit(f"{int(fraction * 2**32):08x}") if fraction < 1 else F.lit(True)


def hash_sample(df: DataFrame, fraction: float, id: str = "transaction_id") -> DataFrame:
    """The same rows each time, about this fraction of them."""
    return df.where(_share(F.col(id), fraction))


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    fraud = F.sum(F.col(label).cast("bigint"))
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(fraud, F.lit(0)).alias("n_fraud")).select(
        "n_rows",
        "n_fraud",
        (F.col("n_fraud") / F.col("n_rows")).alias("fraud_rate"),
        ((F.col("n_rows") - F.col("n_fraud")) / F.greatest("n_fraud", F.lit(1))).alias("pos_weight"),
    )


def fill_missing(df: DataFrame, columns: list[str], value: float = 0.0) -> DataFrame:
    """With absent columns added and nulls filled."""
    have = set(df.columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(value)) if c in have else F.lit(value) for c in columns})


def time_cutoff(df: DataFrame, fraction: float = 0.8, ts: str = "event_timestamp") -> DataFrame:
    """cutoff: the time at row int(n * fraction) in order of time; null without rows. Rows are counted by day, then by second in
    the day that holds the row, then by microsecond in the second, so that nothing is sorted and at most 86,400 counts of days or
    seconds, or the distinct times of a second, come to the driver."""
    day, second = 86_400_000_000, 1_000_000
    rows = df.where(F.col(ts).isNotNull()).select(F.unix_micros(F.col(ts).cast("timestamp")).alias("t"))
    rank, low = None, 0
    for width in (day, second, 1):
        counts = sorted(map(tuple, rows.groupBy(F.floor(F.col("t") / width).alias("at")).count().collect()))
        rank = int(sum(n for _, n in counts) * fraction) if rank is None else rank
        for low, n in counts:
            if rank < n:
                break
            rank -= n
        else:
            return df.agg(F.max(ts).alias("cutoff"))
        rows = rows.where((F.col("t") >= low * width) & (F.col("t") < (low + 1) * width))
    return df.sparkSession.range(1).select(F.timestamp_micros(F.lit(low)).alias("cutoff"))


def temporal_split(df: DataFrame, fraction: float = 0.8, ts: str = "event_timestamp", cutoff: Column | None = None) -> DataFrame:
    """With `part`: train before the cutoff, oot from it on."""
    if cutoff is None:
        cutoff = F.lit(time_cutoff(df, fraction, ts).first()[0])
    return df.withColumn("part", F.when(F.col(ts) < cutoff, "train").otherwise("oot"))


SPLIT_DIGITS = 4  # hex digits of a hash that make a bucket


def stratified_split(df: DataFrame, fraction: float = 0.8, seed: int = 42, id: str = "transaction_id", label: str | None = "is_fraud") -> DataFrame:
    """With `part`: train for exactly floor(fraction * n) of the n rows of each label (null is one; label None: of all rows), those of the
    smallest hashes of seed and id, ties by id; else test. Rows with a null id come last.

    Rows are counted by label and the hash's leading digits; only the one bucket of a label that holds the cut is ranked.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    cls, hashed, bucket = (F.lit(0) if label is None else F.col(label)), F.col("split_hash"), F.col("split_bucket")
    # ~ comes after all hex digits.
    rows = df.withColumn("split_hash", F.coalesce(F.md5(F.concat(F.lit(str(seed)), F.col(id).cast("string"))), F.lit("~" * 32)))
    rows = rows.withColumns({"split_class": cls, "split_bucket": F.substring("split_hash", 1, SPLIT_DIGITS)})
    # 16**SPLIT_DIGITS + 1 rows of each label at most.
    counts = rows.groupBy("split_class", "split_bucket").agg(F.count("*").alias("split_n"))
    of = Window.partitionBy("split_class")
    upto, total = F.sum("split_n").over(of.orderBy("split_bucket")), F.sum("split_n").over(of)
    counts = counts.withColumns({"split_upto": upto, "split_want": F.floor(F.lit(fraction) * total)})
    cut = counts.where((F.col("split_upto") > F.col("split_want")) & (F.col("split_upto") - F.col("split_n") <= F.col("split_want")))
    cut = cut.select(F.col("split_class").alias("cut_class"), F.col("split_bucket").alias("cut_bucket"), (F.col("split_want") - F.col("split_upto") + F.col("split_n")).alias("cut_take"))
    # A row for each label. A label whose rows are all train has none.
    rows = rows.join(F.broadcast(cut), rows["split_class"].eqNullSafe(cut["cut_class"]), "left")
    inside = F.coalesce(bucket == F.col("cut_bucket"), F.lit(False))
    whole = rows.where(~inside).withColumn("part", F.when(F.coalesce(bucket < F.col("cut_bucket"), F.lit(True)), "train").otherwise("test"))
    place = F.row_number().over(Window.partitionBy("split_class").orderBy(hashed, F.col(id)))
    ranked = rows.where(inside).withColumn("part", F.when(place <= F.col("cut_take"), "train").otherwise("test"))
    return whole.unionByName(ranked).select(*df.columns, "part")


def calibration_carve(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Of a split table: the newest fifth of train becomes calibration."""
    train = df.where("part = 'train'")
    late = (F.col("part") == "train") & (F.col(ts) >= F.lit(time_cutoff(train, 0.8, ts).first()[0]))
    return df.withColumn("part", F.when(late, "calibration").otherwise(F.col("part")))


def quantiles(value: Column, shares: list[float]) -> Column:
    """Quantiles of a group within 1 / 10,000 of the rank, from a bounded sketch. Exact ones: operators.quantiles."""
    return F.percentile_approx(value.cast("double"), F.array(*map(F.lit, shares)), 10_000)


def scaling_statistics(train: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """One row with the mean, spread, least, most and quartiles of every column: one pass, and those of a selection for exact quartiles."""
    parts, shares = [], [0.25, 0.5, 0.75]
    for c in columns:
        parts += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
        parts += [] if exact else [quantiles(F.col(c), shares).alias(f"{c}_q")]
    out = train.agg(*parts)
    if exact and columns:
        found = exact_quantiles(unpivoted(train, columns), ["feature"], "value", shares)
        # A row for each column.
        out = out.crossJoin(F.broadcast(found.agg(F.map_from_entries(F.collect_list(F.struct("feature", "quantiles"))).alias("all_q"))))
        out = out.withColumns({f"{c}_q": F.try_element_at("all_q", F.lit(c)) for c in columns}).drop("all_q")
    return out


def unpivoted(df: DataFrame, columns: list[str]) -> DataFrame:
    """feature, value: a row for each column, nulls left out."""
    stack = F.stack(F.lit(len(columns)), *(x for c in columns for x in (F.lit(c), F.col(c).cast("double"))))
    return df.select(stack.alias("feature", "value")).where("value IS NOT NULL")


def numeric_scaling(df: DataFrame, train: DataFrame, columns: list[str], method: str = "standard", exact: bool = True) -> DataFrame:
    """columns scaled by what `train` alone tells. method: passthrough, standard, minmax, robust (median and quartile
    distance). A column that does not vary is only shifted."""
    if method == "passthrough":
        return df
    if method not in ("standard", "minmax", "robust"):
        raise ValueError(f"unknown method {method!r}")
    told, scaled = scaling_statistics(train, columns, exact and method == "robust").first(), {}
    for c in columns:
        if method == "standard":
            shift, width = told[f"{c}_mean"], told[f"{c}_std"]
        elif method == "minmax":
            shift, width = told[f"{c}_min"], (told[f"{c}_max"] or 0) - (told[f"{c}_min"] or 0)
        else:
            low, shift, high = told[f"{c}_q"] or (0, 0, 0)
            width = high - low
        scaled[c] = (F.col(c).cast("double") - F.lit(float(shift or 0))) / F.lit(float(width or 1))
    return df.withColumns(scaled)


def categorical_encoding(df: DataFrame, train: DataFrame, column: str, method: str = "ordinal", most: int = 1000) -> DataFrame:
    """ordinal: the value's place among train's sorted values, -1 if unknown. onehot: a column of 0 and 1 for each value,
    all 0 if unknown; as values become columns, more than `most` of them are refused."""
    if method == "ordinal":
        # Values are sorted over all tasks and numbered in each; a row for each task tells how many lie before it.
        at, before = fresh(df, "encoded_at"), Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        values = train.where(F.col(column).isNotNull()).select(column).distinct().repartitionByRange(column).sortWithinPartitions(column)
        values = stored(values.withColumn(at, F.monotonically_increasing_id()), "encoded").withColumn("task", F.shiftright(at, 33))
        sizes = values.groupBy("task").agg(F.count("*").alias("n"))
        sizes = sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lower"))
        place = (F.col(at).bitwiseAND(F.lit(2**33 - 1)) + F.col("lower")).alias(at)
        places = values.join(F.broadcast(sizes), "task").select(column, place)
        return df.join(places, column, "left").withColumn(f"{column}_code", F.coalesce(at, F.lit(-1))).drop(at)
    values = [r[0] for r in train.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values; encode it as ordinal")
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values})


def train_classifier(df: DataFrame, features: list[str], label: str = "is_fraud", kind: str = "gbt", trees: int = 20, depth: int = 5, seed: int = 42):
    """A model of MLlib on weighted classes: (the assembler, the model). kind: gbt (boosted trees), sampled_gbt (boosted trees, each on a
    part of the rows and features), forest, or gaussian (naive Bayes, fitted by one pass of sums)."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    balance = class_balance(df, label).first()
    rows = assembler.transform(fill_missing(df, features)).withColumn("weight", F.when(F.col(label) == 1, balance["pos_weight"]).otherwise(1.0))
    kinds = {
        "gbt": lambda: GBTClassifier(maxIter=trees),
        "sampled_gbt": lambda: GBTClassifier(maxIter=trees, subsamplingRate=0.8, featureSubsetStrategy="0.8"),
        "forest": lambda: RandomForestClassifier(numTrees=trees),
        "gaussian": lambda: NaiveBayes(modelType="gaussian"),
    }
    if kind not in kinds:
        raise ValueError(f"kind {kind!r} is none of {', '.join(kinds)}")
    made = kinds[kind]()
    made = made.setLabelCol(label).setFeaturesCol("features").setWeightCol("weight")
    if kind != "gaussian":
        made = made.setMaxDepth(depth).setSeed(seed)
    return assembler, made.fit(rows.select("features", label, "weight"))


def top_importances(spark, features: list[str], model, n: int = 20) -> DataFrame:
    """feature, importance: the n largest."""
    rows = sorted(zip(features, map(float, model.featureImportances.toArray()), strict=True), key=lambda r: (-r[1], r[0]))[:n]
    return spark.createDataFrame(rows, "feature string, importance double")


def calibration_grid(scored: DataFrame, method: str = "isotonic", points: int = 1000) -> tuple[list[float], list[float]]:
    """x and y of a map from scores to chances, fitted on (score, label). isotonic, also for beta; sigmoid: a logistic curve."""
    if method not in ("isotonic", "beta", "sigmoid"):
        raise ValueError(f"unknown method {method!r}")
    grid = [i / (points - 1) for i in range(points)]
    if method == "sigmoid":
        rows = VectorAssembler(inputCols=["score"], outputCol="features").transform(scored)
        model = LogisticRegression(labelCol="label", featuresCol="features").fit(rows)
        a, b = float(model.coefficients[0]), float(model.intercept)
        return grid, [1 / (1 + exp(-(a * x + b))) for x in grid]
    model = IsotonicRegression(labelCol="label", featuresCol="score").fit(scored)
    xs, ys = list(map(float, model.boundaries.toArray())), list(map(float, model.predictions.toArray()))
    return grid, [float(y) for y in np.interp(grid, xs, ys)]


def apply_calibration(score: Column, x: list[float], y: list[float]) -> Column:
    """Linear interpolation between the points, constant outside them; x rises. Evenly spaced points are looked up by place."""
    n, width = len(x), (x[-1] - x[0]) / max(1, len(x) - 1)
    if n < 2:
        return F.when(score.isNotNull(), F.lit(float(y[0])))
    if all(abs(x[0] + i * width - v) < 1e-9 for i, v in enumerate(x)):
        place = (F.least(F.greatest(score, F.lit(x[0])), F.lit(x[-1])) - F.lit(x[0])) / F.lit(width)
        low = F.least(F.floor(place), F.lit(n - 2)).cast("int")
        values = F.array(*map(F.lit, map(float, y)))
        left, right = F.get(values, low), F.get(values, low + 1)
        return F.when(score.isNotNull(), left + (right - left) * (place - low))
    if n > 200:
        raise ValueError("more than 200 points must be evenly spaced")
    out = F.lit(float(y[0]))
    for x0, x1, y0, y1 in zip(x, x[1:], y, y[1:], strict=False):
        inside = F.least(F.greatest(score - F.lit(x0), F.lit(0.0)), F.lit(x1 - x0))
        out = out + inside * F.lit((y1 - y0) / (x1 - x0))
    return F.when(score.isNotNull(), out)


def risk_band(score: Column) -> Column:
    out = F.lit("low")
    for least, band in reversed(BANDS):
        out = F.when(score >= least, band).otherwise(out)
    return out


def with_band(df: DataFrame, threshold: float = 0.5, score: str = "fraud_score") -> DataFrame:
    rounded = F.round(score, 6)
    return df.withColumns({score: rounded, "risk_band": risk_band(rounded), "is_flagged": rounded >= threshold})


def scored(rows: DataFrame, features: list[str], assembler, model, grid: tuple[list[float], list[float]] | None = None, threshold: float = 0.5) -> DataFrame:
    """rows with fraud_score (the model's chance of fraud, through the calibration's points if given, to six places), risk_band and
    is_flagged. Features that are absent or null count as 0; other columns keep their values."""
    inputs = fill_missing(rows.select(F.struct(*rows.columns).alias("scored_row"), *(c for c in features if c in rows.columns)), features)
    chance = vector_to_array("probability")[1]
    out = model.transform(assembler.transform(inputs)).select("scored_row.*", chance.alias("raw_fraud_score"))
    score = F.col("raw_fraud_score") if grid is None else apply_calibration(F.col("raw_fraud_score"), *grid)
    return with_band(out.withColumn("fraud_score", score).drop("raw_fraud_score"), threshold)


def scored_event(df: DataFrame, service: str = "fraud_scoring_v1") -> DataFrame:
    """The 14 fields of a scored transaction."""
    return df.select(
        "transaction_id", "user_id", "device_id", "merchant_id", "channel", "amount",
        F.col("is_international").cast("boolean").alias("is_international"), "event_timestamp",
        F.col("fraud_score").cast("double").alias("fraud_score"), "risk_band", "is_flagged",
        F.coalesce("model_version", F.lit("unknown")).alias("model_version"), F.lit(service).alias("feature_service_version"), "scored_at",
    )


CURVE_BUCKETS = 16_384


def curve(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """From (score, label): for each distinct score the true and false positives at it and above (tp, fp), those at it
    (p, n) and the totals (pos, neg). One row for each distinct score, so that ties count together. Scores are added up in buckets
    first and then within each, so that no task sorts all scores; the buckets cover all numbers, a quarter of them those from 0 to 1."""
    by = by or []
    counts = scored.groupBy(*by, "score").agg(F.sum(F.col("label").cast("bigint")).alias("p"), F.count("*").alias("rows"))
    finite = F.greatest(F.least(F.col("score").cast("double"), F.lit(1e300)), F.lit(-1e300))
    bucket = F.floor((finite / (1 + F.abs(finite)) + 1) / 2 * CURVE_BUCKETS)
    counts = counts.withColumns({"n": F.col("rows") - F.col("p"), "bucket": bucket}).drop("rows")
    # CURVE_BUCKETS + 1 rows of each group at most.
    sums = counts.groupBy(*by, "bucket").agg(F.sum("p").alias("p_in"), F.sum("n").alias("n_in"))
    before = Window.partitionBy(*by).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(*by)
    sums = sums.select(
        *(F.col(c).alias(f"{c}_") for c in by), F.col("bucket").alias("bucket_"),
        F.coalesce(F.sum("p_in").over(before), F.lit(0)).alias("p_above"), F.coalesce(F.sum("n_in").over(before), F.lit(0)).alias("n_above"),
        F.sum("p_in").over(all_).alias("pos"), F.sum("n_in").over(all_).alias("neg"),
    )
    same = F.col("bucket").eqNullSafe(F.col("bucket_"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    within = Window.partitionBy(*by, "bucket").orderBy(F.desc("score"))
    rows = counts.withColumns({"p_upto": F.sum("p").over(within), "n_upto": F.sum("n").over(within)}).join(sums, same)
    return rows.select(*by, "score", "p", "n", (F.col("p_upto") + F.col("p_above")).alias("tp"), (F.col("n_upto") + F.col("n_above")).alias("fp"), "pos", "neg")


def ranking_metrics(scored: DataFrame, by: list[str] | None = None, least_precision: float = 0.5) -> DataFrame:
    """roc_auc (ties count half), pr_auc (average precision) and the highest recall at a precision of least_precision or
    more; null without both labels."""
    by = by or []
    precision, recall = F.col("tp") / (F.col("tp") + F.col("fp")), F.col("tp") / F.col("pos")
    below = F.col("neg") - F.col("fp")
    out = curve(scored, by).groupBy(*by).agg(
        (F.sum(F.col("p") * (below + F.col("n") / 2)) / F.max(F.col("pos") * F.col("neg"))).alias("roc_auc"),
        (F.sum(F.col("p") * precision) / F.max("pos")).alias("pr_auc"),
        F.coalesce(F.max(F.when(precision >= least_precision, recall)), F.lit(0.0)).alias("recall_at_precision"),
    )
    return out.select(*by, *(F.round(c, 9).alias(c) for c in ("roc_auc", "pr_auc", "recall_at_precision")))


def choose_threshold(scored: DataFrame, least_recall: float = 0.80) -> DataFrame:
    """The threshold of the best precision among those of enough recall (of equal precision the highest); 0.5 if there is none."""
    points = curve(scored).withColumns({"precision": F.col("tp") / (F.col("tp") + F.col("fp")), "recall": F.col("tp") / F.col("pos")})
    best = points.where(F.col("recall") >= least_recall).agg(F.max_by("score", F.struct("precision", "score")).alias("t"))
    return best.select(F.coalesce("t", F.lit(0.5)).alias("threshold"))


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    hit, bad = F.col("score") >= threshold, F.col("label") == 1
    counts = scored.agg(
        F.count_if(~hit & ~bad).alias("tn"), F.count_if(hit & ~bad).alias("fp"), F.count_if(~hit & bad).alias("fn"), F.count_if(hit & bad).alias("tp")
    )
    return counts.withColumns({
        "precision": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0)),
    })


def brier(scored: DataFrame) -> DataFrame:
    return scored.agg(F.round(F.avg(F.pow(F.col("score") - F.col("label"), 2)), 9).alias("brier"))


def reliability_bins(scored: DataFrame, bins: int = 10) -> DataFrame:
    """bin (from 0), rows, mean prediction and actual rate; a score of exactly 1 lies in no bin."""
    rows = scored.withColumn("bin", F.floor(F.col("score") * bins).cast("int")).where((F.col("score") >= 0) & (F.col("score") < 1))
    return rows.groupBy("bin").agg(
        F.count("*").alias("n"), F.round(F.avg("score"), 9).alias("mean_score"), F.round(F.avg(F.col("label").cast("double")), 9).alias("fraud_rate")
    )


def ece(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean distance of prediction and rate over the bins, by rows; rows outside all bins count in the total."""
    rows = scored.withColumn("bin", F.when(F.col("score") < 1, F.floor(F.col("score") * bins)))
    parts = rows.groupBy("bin").agg(F.count("*").alias("n"), F.avg("score").alias("c"), F.avg(F.col("label").cast("double")).alias("a"))
    gap = F.when(F.col("bin").isNotNull(), F.col("n") * F.abs(F.col("a") - F.col("c"))).otherwise(0.0)
    return parts.agg(F.round(F.sum(gap) / F.sum("n"), 9).alias("ece"))
