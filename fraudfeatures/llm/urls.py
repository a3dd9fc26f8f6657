"""URL filters by gradient-boosted trees on lexical features, below hand-made rules.

A URL that a rule fits gets the verdict of the longest such rule. The others are judged by boosted trees that know only
what the URL looks like: its length and depth, its shares of digits, letters and signs, the entropy of its characters,
its parameters, and how often labelled URLs of the same host suffix were bad. The trees are trained on URLs whose
documents are labelled.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, frozen, sampled, table

SUFFIX_LIMIT = 200_000  # suffixes to broadcast (some 10 MB); beyond, the join is by shuffle
SMOOTHING = 20.0
FEATURES = ["length", "depth", "digits", "letters", "signs", "entropy", "parameters", "fragment", "host_length", "labels", "longest_number", "suffix_n", "suffix_bad"]


@dataclass(frozen=True)
class Rule:
    """Fits URLs of the host and its subdomains whose path starts with the path."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """After the first `://`, up to `/`, `?`, `#` or the end, with A-Z lower-cased; empty without it or for null."""
    found = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"(?s)^([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """After the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(the longest rule that fits, as host and path; its verdict), null where none does. Of rules of equal length and
    of equal rules the first in order of host, path and verdict counts."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    order = sorted(rules, key=lambda r: (-len(r.host) - len(r.path), r.host, r.path, r.verdict))
    for r in reversed(order):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.host + r.path).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers that a URL's characters tell; zeros for null and empty ones."""
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = lambda kept: F.length(F.regexp_replace(text, kept, "")) / n
    counted = F.transform(F.array_distinct(F.split(text, "")), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    entropy = F.aggregate(counted, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1)
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)), F.length)
    return {
        "length": F.length(text).cast("double"),
        "depth": (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
        "digits": share(r"[^0-9]"),
        "letters": share(r"[^A-Za-z]"),
        "signs": share(r"[A-Za-z0-9]"),
        "entropy": entropy,
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "fragment": text.contains("#").cast("double"),
        "host_length": F.length(host).cast("double"),
        "labels": F.size(F.split(host, r"\.")).cast("double"),
        "longest_number": F.coalesce(F.array_max(numbers), F.lit(0)).cast("double"),
    }


@dataclass
class UrlModel:
    """The trees, the labelled URLs and bad ones of each suffix (a written table, marked to be broadcast if it is small
    enough), and the share of bad ones overall."""

    trees: GBTClassificationModel
    suffixes: DataFrame
    base: float


def _assembled(urls: DataFrame, url: str, suffixes: DataFrame, base: float, features: str, label: str | None = None) -> DataFrame:
    """urls with a vector of features. With the column of their labels, each URL, which the suffixes must have counted, is
    left out of its own suffix's figures."""
    parts = host(F.col(url)), path(F.col(url))
    names = {f: fresh(urls, f"f_{f}") for f in FEATURES}
    key, n, bad = (fresh(urls, c) for c in ("suffix_key", "suffix_rows", "suffix_bad_rows"))
    out = urls.withColumns({key: suffix(parts[0]), **{names[f]: c for f, c in lexical(F.col(url), *parts).items()}})
    known = suffixes.select(F.col("suffix").alias(key), F.col("n").alias(n), F.col("bad").alias(bad))
    out = out.join(known, key, "left")
    if label is not None:
        out = out.withColumns({n: F.col(n) - 1, bad: F.col(bad) - F.col(label)})
    out = out.withColumn(names["suffix_n"], F.log1p(F.coalesce(n, F.lit(0))))
    out = out.withColumn(names["suffix_bad"], (F.coalesce(bad, F.lit(0)) + SMOOTHING * base) / (F.coalesce(n, F.lit(0)) + SMOOTHING))
    out = VectorAssembler(inputCols=[names[f] for f in FEATURES], outputCol=features).transform(out)
    return out.drop(key, n, bad, *names.values())


def fit(labelled: DataFrame, trees: int = 12, depth: int = 3, labelled_rows: int = 20_000) -> UrlModel | None:
    """labelled: (url, bad), null ones left out; a URL with both labels is bad. Suffixes and the share of bad ones are
    counted over all; the trees learn from at most labelled_rows URLs, those of the smallest hashes. None unless both
    labels occur among these."""
    some = labelled.where("url IS NOT NULL AND bad IS NOT NULL").select("url", F.col("bad").cast("double").alias("bad"))
    every = frozen(some.groupBy("url").agg(F.max("bad").alias("bad")), "labelled_urls")
    some = sampled(every, labelled_rows, "url")
    some = frozen(some.repartitionByRange(4, "url").sortWithinPartitions("url"), "learned_urls")
    total, seen = (x.agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).first() for x in (every, some))
    if not seen["n"] or not 0 < seen["bad"] < seen["n"]:
        return None
    base, share = total["bad"] / total["n"], seen["bad"] / seen["n"]
    suffixes = frozen(every.groupBy(suffix(host(F.col("url"))).alias("suffix")).agg(F.count("*").alias("n"), F.sum("bad").alias("bad")), "suffixes")
    suffixes = F.broadcast(suffixes) if suffixes.count() <= SUFFIX_LIMIT else suffixes
    rows = _assembled(some, "url", suffixes, base, "features", "bad").withColumn("weight", F.when(F.col("bad") > 0, 0.5 / share).otherwise(0.5 / (1 - share)))
    booster = GBTClassifier(labelCol="bad", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=depth, seed=7)
    return UrlModel(booster.fit(rows.select("bad", "features", "weight")), suffixes, base)


def judge(urls: DataFrame, model: UrlModel | None, rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """urls with host, path, rule, score and verdict (columns of these names get underscores in front): allow or block by
    the longest rule that fits, else by the trees' score, block from 0.5 on.

    A null, empty or malformed URL has an empty host and path and is judged by the trees like others; URLs of any length are
    read whole. Without a model (no labels, or of one kind only) the score is 0 and the verdict allow where no rule
    fits. Repeated URLs are judged alike; an empty table gives no rows.
    """
    columns = urls.columns
    names = {c: fresh(urls, c) for c in ("host", "path", "rule", "score", "verdict")}
    ruled = fresh(urls, "ruled")
    if model is None:
        out = urls.withColumn(names["score"], F.lit(0.0))
    else:
        made = {c: fresh(urls, c) for c in ("features", "probability", "raw", "guess")}
        trees = model.trees.copy().setFeaturesCol(made["features"]).setProbabilityCol(made["probability"])
        trees = trees.setRawPredictionCol(made["raw"]).setPredictionCol(made["guess"])
        out = trees.transform(_assembled(urls, url, model.suffixes, model.base, made["features"]))
        out = out.withColumn(names["score"], vector_to_array(F.col(made["probability"]))[1])
    out = out.withColumns({names["host"]: host(F.col(url)), names["path"]: path(F.col(url))})
    rule, verdict = rule_of(F.col(names["host"]), F.col(names["path"]), rules)
    out = out.withColumns({names["rule"]: rule, ruled: verdict})
    other = F.when(F.col(names["score"]) >= 0.5, "block").otherwise("allow")
    out = out.withColumn(names["verdict"], F.coalesce(ruled, other))
    return out.select(*columns, *names.values())


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): the pages whose document is labelled, the last number of the path being its id; bad if the document is
    of low quality or toxic."""
    number = F.regexp_extract(path(F.col("url")), r"(\d{1,18})[^\d]*$", 1)
    known = pages.select("url", F.when(number != "", number).cast("bigint").alias("doc_id"))
    bad = ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")
    return known.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("url", "bad")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = fit(labelled_urls(pages, table(spark, sf_dir, "labels")))
    return judge(pages, model).select("page_id", "host", "path", "rule", "verdict", "score")


QUERIES = {"op3_url_filter": op3_url_filter}
ORACLES: dict[str, str] = {}
