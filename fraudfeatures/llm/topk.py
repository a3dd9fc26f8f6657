"""Exact top-k inner products by a pivot-distance index.

Vectors are keyed by their nearest pivot and by the annulus around it that their distance falls into. For a query q and an
annulus whose vectors lie between r and R from pivot p and have squared norms of M at most, the triangle inequality gives
|q - v| >= max(0, |q - p| - R, r - |q - p|), and so q.v <= (|q|^2 + M - that^2) / 2. A query first expands the annuli of
the highest bounds until they hold more than k vectors, which gives it a k-th best score; then it looks at every annulus
whose bound reaches that score, and stops there. Large annuli are cut into blocks, so that no task holds an unbounded
one. The index holds every vector and the result is exact; the pivots are a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frozen, table

PIVOTS = 16  # vectors with the smallest hashes of their ids
RINGS = 16  # annuli of equal width around each pivot
BLOCK = 4096  # vectors of an annulus that are searched together
CHUNK = 4096  # queries that are searched together


def usable(vector: Column) -> Column:
    """Not null, with finite components only."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)
    )


def integer_vector(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1024))


def _matrix(rows: pd.Series | list, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled with zeros."""
    out = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        v = np.frombuffer(x, np.int64)
        out[i, : len(v)] = v
    return out


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if most < 2**53:  # then every partial sum is exact in doubles
        return (queries @ vectors.T).astype(np.int64)
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


def _bounds(queries: np.ndarray, pivots: np.ndarray, rings: pd.DataFrame) -> np.ndarray:
    """Upper bounds of the scores of each query (row) in each ring (column)."""
    norm = (queries**2).sum(axis=1)
    away = np.sqrt(np.maximum(norm[:, None] + (pivots**2).sum(axis=1) - 2 * queries @ pivots.T, 0))
    away = away[:, rings["pivot"].to_numpy()]
    gap = np.maximum(0, np.maximum(away - rings["far"].to_numpy(), rings["near"].to_numpy() - away))
    bound = (norm[:, None] + rings["norm"].to_numpy() - gap**2) / 2
    return bound + 1 + np.abs(bound) * 1e-9  # room for rounding


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """vectors: (vec_id long, vector array<long>); queries: the same columns. For each query its k highest inner products
    with the vectors of other ids, ties to the smaller id: query_id, rank (from 1), vec_id, score.

    All results if there are fewer than k. Null ids and null vectors take no part. Rows that repeat an id are vectors of
    their own: a query may get an id more than once, and queries of one id share one list of k results over all their rows. A
    shorter vector counts as if filled up with zeros. Without vectors or queries the result is empty. Other columns are
    not read.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return df.select("vec_id", "vector").where("vec_id IS NOT NULL AND vector IS NOT NULL")

    table_schema = "vec_id long, pivot int, distance double, norm double, vector binary"
    vectors = frozen(clean(vectors), "vectors")
    sample = [np.array(r["vector"], np.float64) for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(PIVOTS).collect()]
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not sample:
        return nothing
    width = vectors.agg(F.max(F.size("vector"))).first()[0]
    pivots = np.zeros((len(sample), width))
    for i, v in enumerate(sample):
        pivots[i, : len(v)] = v

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [np.asarray(v, np.int64).tobytes() for v in batch["vector"]]
            v = _matrix(raw, width)
            norm = (v**2).sum(axis=1)
            away = np.sqrt(np.maximum(norm[:, None] + (pivots**2).sum(axis=1) - 2 * v @ pivots.T, 0))
            pivot = away.argmin(axis=1) if len(v) else np.zeros(0, int)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "pivot": pivot, "distance": away[np.arange(len(v)), pivot], "norm": norm, "vector": raw})

    keyed = frozen(vectors.mapInPandas(key, table_schema), "keyed")
    spans = keyed.groupBy("pivot").agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    width_of = F.greatest(F.col("high") - F.col("low"), F.lit(1e-9))
    ring = F.least(F.floor((F.col("distance") - F.col("low")) / width_of * RINGS), F.lit(RINGS - 1)).cast("int")
    keyed = keyed.join(F.broadcast(spans), "pivot").withColumn("ring", ring)
    # PIVOTS x RINGS rows at most.
    directory = keyed.groupBy("pivot", "ring").agg(
        F.count("*").alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far"), F.max("norm").alias("norm")
    )
    rings = pd.DataFrame([r.asDict() for r in directory.orderBy("pivot", "ring").collect()])
    rings["blocks"] = -(-rings["n"] // BLOCK)
    sizes = spark.createDataFrame(
        [tuple(map(int, r)) for r in rings[["pivot", "ring", "blocks"]].itertuples(index=False)], "pivot int, ring int, blocks int"
    )
    keyed = keyed.join(F.broadcast(sizes), ["pivot", "ring"])
    keyed = keyed.select("pivot", "ring", F.pmod(F.xxhash64("vec_id", "vector"), "blocks").cast("int").alias("block"), "vec_id", "vector")

    asked = clean(queries).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.lit(None).cast("long").alias("least"))
    asked = frozen(asked, "queries")
    chunks = -(-asked.count() // CHUNK)
    target_schema = "query_id long, query binary, least long, pivot int, ring int, block int, chunk int"

    def targets(first: bool):
        """The blocks that a query looks at: first those that give it more than k candidates, then all that can hold a
        result."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            n, blocks = rings["n"].to_numpy(), rings["blocks"].to_numpy()
            for batch in batches:
                raw = [np.asarray(v, np.int64).tobytes() for v in batch["query"]]
                own_width = max([width, *(len(x) // 8 for x in raw)])
                wide = np.zeros((len(pivots), own_width))
                wide[:, :width] = pivots
                bounds = _bounds(_matrix(raw, own_width), wide, rings)
                rows = []
                for i, (query_id, least) in enumerate(zip(batch["query_id"], batch["least"], strict=True)):
                    order = np.argsort(-bounds[i], kind="stable")
                    if first:
                        held = np.cumsum(np.minimum(n[order], BLOCK // 2))
                        order = order[: np.searchsorted(held, k + 1) + 1]
                    elif not pd.isna(least):
                        order = order[bounds[i, order] >= least]
                    for r in order:
                        which = [(query_id // 100) % blocks[r]] if first else range(blocks[r])
                        rows += [(query_id, raw[i], least, rings["pivot"][r], rings["ring"][r], b, 0) for b in which]
                yield pd.DataFrame(rows, columns=["query_id", "query", "least", "pivot", "ring", "block", "chunk"]).astype({"least": "Int64"})

        return run

    def best(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        block = block.sort_values("vec_id", ignore_index=True)
        ids = block["vec_id"].to_numpy()
        wide = max([width, *(len(x) // 8 for x in asked["query"])])
        stored, out = _matrix(block["vector"], wide), []
        for at in range(0, len(asked), 256):
            part = asked.iloc[at : at + 256]
            scores = _scores(_matrix(part["query"], wide), stored)
            for row, query_id, least in zip(scores, part["query_id"], part["least"], strict=True):
                at_all = np.flatnonzero(ids != query_id)
                if not pd.isna(least):
                    at_all = at_all[row[at_all] >= least]
                if len(at_all) > k:
                    at_all = at_all[row[at_all] >= np.partition(row[at_all], -k)[-k]]
                for j in at_all[np.argsort(-row[at_all], kind="stable")][:k]:
                    out.append((query_id, ids[j], row[j]))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    def search(asked: DataFrame, first: bool) -> DataFrame:
        at = asked.mapInPandas(targets(first), target_schema)
        at = at.withColumn("chunk", F.pmod(F.xxhash64("query_id", "query"), F.lit(max(chunks, 1))).cast("int"))
        at, place = frozen(at, "targets"), ["pivot", "ring", "block"]
        needed = at.select(*place, F.col("chunk").alias("asks")).distinct()
        blocks = keyed.join(needed, place).withColumnRenamed("asks", "chunk")
        return at.groupBy(*place, "chunk").cogroup(blocks.groupBy(*place, "chunk")).applyInPandas(best, "query_id long, vec_id long, score long")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    least = ranked(search(asked, True)).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    asked = frozen(asked.drop("least").join(least, "query_id", "left"), "asked")
    ranked = ranked(search(asked, False))
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding")))
    vectors = rows.select("vec_id", integer_vector(F.col("embedding")).alias("vector"))
    return exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

QUERIES = {"op6_exact_topk": op6_exact_topk}
ORACLES = {"op6_exact_topk": OP6_SQL}
