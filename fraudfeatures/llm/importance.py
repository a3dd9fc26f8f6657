"""Importance resampling towards a target: documents are weighed by how much likelier their words are in the target than in the corpus,
and drawn without replacement by adding random noise to the weights and taking the highest sums.

Words and pairs of words fall into buckets by hash. Two arrays, of counts in the corpus and in the target, give each bucket a gain, and a
document's weight is the mean gain of its features. Scores are ranked by a distributed LSD radix sort: rows have positions, and a pass
for each digit of the composite key, from the least significant one on, sends each row to the number of rows with smaller digits, plus
those of its digit in blocks before its own, plus those before it in its block. Every pass is stable, so that after the last one a
row's position is its rank.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frozen, scratch, small_batches, table

BUCKETS = 10_000
DIGIT = 11  # bits of a key that a pass sorts by
LEAST_BLOCK, MOST_BLOCK = 1024, 2**20  # rows of a block
#: A-Z to a-z; digits, a-z and all bytes of other characters stay; what is left parts words.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def feature_buckets(text: bytes | None, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of a text's words and of its pairs of neighbouring words, repeats included. A pair's hash goes on from its first
    word's, which is that of the two words joined by a space."""
    words = (text or b"").translate(LETTERS).split()
    ones = list(map(crc32, words))
    twos = map(crc32, [b" " + w for w in words[1:]], ones)
    return np.fromiter((*ones, *twos), np.int64) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (a column text) each bucket holds. Tasks count first; one count for each bucket comes to the
    driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount(feature_buckets(text, buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    out = np.zeros(buckets, np.int64)
    with small_batches(texts.sparkSession):
        counted = texts.select(F.col("text").cast("binary").alias("text")).mapInPandas(count, "bucket int, n long")
        for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: the floor of 1000 times the log of its share in the target over that in the corpus, each count raised by 1."""
    b, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    up = [(x + 1) * (s + b) / ((y + 1) * (t + b)) for x, y in zip(target.tolist(), corpus.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in up], np.int64)


def noise(doc_id: str | None, seed: int = 7) -> int:
    """The floor of 1000 times a standard Gumbel value that seed and id, as text, alone tell; a null id is read as an empty text."""
    name = f"{seed}:{doc_id or ''}".encode()
    h = int(hashlib.sha256(name).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def radix_ranked(df: DataFrame, keys: list[tuple[str, bool]], block: int | None = None) -> DataFrame:
    """df with a column `place`: from 0 on, its rows in the order of the long columns named in keys, the first being the most
    significant; True sorts a column downwards. Nulls come last. Rows equal in all keys follow in the order in which df was read. df must
    not have columns place, digit_no, block_no, in_block and starts_at.

    Each key takes a pass for every DIGIT bits between its least and its greatest value, and one for its nulls if it has any. block: rows
    of a block; by the number of rows if not given.
    """
    columns = df.columns
    told = {"low": F.min, "high": F.max, "nulls": lambda k: F.count_if(F.isnull(k))}
    bounds = df.agg(F.count("*").alias("n"), *(f(k).alias(f"{name}_{i}") for i, (k, _) in enumerate(keys) for name, f in told.items())).first()
    block = block or min(MOST_BLOCK, max(LEAST_BLOCK, -(-bounds["n"] // 256)))

    # Rows are numbered in the order of their partitions: how many rows lie before a partition, plus the place within.
    numbered = frozen(df.withColumn("place", F.monotonically_increasing_id()), "radix")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit(2**33 - 1))
    # A row for each partition.
    sizes = numbered.groupBy(part.alias("part_no")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part_no", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    numbered = numbered.withColumn("part_no", part).join(F.broadcast(sizes), "part_no")
    out = numbered.select(*columns, (within + F.col("rows_before")).alias("place"))

    passes: list[Column] = []
    for i, (key, down) in reversed(list(enumerate(keys))):
        low, high = bounds[f"low_{i}"], bounds[f"high_{i}"]
        if low is None:
            continue
        if high - low < 2**62:
            value, bits = F.lit(high) - F.col(key) if down else F.col(key) - F.lit(low), (high - low).bit_length()
        else:  # as unsigned numbers
            value, bits = F.col(key).bitwiseXOR(F.lit(-(2**63))), 64
            value = F.bitwise_not(value) if down else value
        passes += [F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(2**DIGIT - 1)) for shift in range(0, bits, DIGIT)]
        passes += [F.col(key).isNull().cast("int")] if bounds[f"nulls_{i}"] else []
    for digit in passes:
        out = _counting_pass(out, columns, digit, block)
    return out


def _counting_pass(rows: DataFrame, columns: list[str], digit: Column, block: int) -> DataFrame:
    """A stable counting sort by one digit. Rows are exchanged once, to their blocks; only counts go further."""
    rows = rows.withColumns({"digit_no": F.coalesce(digit.cast("int"), F.lit(0)), "block_no": F.floor(F.col("place") / block)})
    counts = rows.groupBy("block_no", "digit_no").agg(F.count("*").alias("rows"))
    counts = frozen(counts, "radix-counts")
    # A row for each digit value: 2**DIGIT at most.
    digits = counts.groupBy("digit_no").agg(F.sum("rows").alias("all_rows"))
    lower = F.coalesce(F.sum("all_rows").over(Window.orderBy("digit_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    digits = digits.select("digit_no", lower.alias("lower"))
    earlier = Window.partitionBy("digit_no").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.join(F.broadcast(digits), "digit_no")
    starts = starts.select("block_no", "digit_no", (F.col("lower") + F.coalesce(F.sum("rows").over(earlier), F.lit(0))).alias("starts_at"))
    # A map of at most 2**DIGIT entries for each block.
    starts = starts.groupBy("block_no").agg(F.map_from_entries(F.collect_list(F.struct("digit_no", "starts_at"))).alias("starts_at"))
    rows = rows.repartition("block_no")
    rows = rows.withColumn("in_block", F.row_number().over(Window.partitionBy("block_no", "digit_no").orderBy("place")) - 1)
    rows = rows.join(starts, "block_no")
    return frozen(rows.select(*columns, (F.col("starts_at")[F.col("digit_no")] + F.col("in_block")).alias("place")), "radix")


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """docs: (doc_id long, text string); target: (text). For every row of docs doc_id, n_features, weight, score and rank: 1, 2, ... for
    the floor(percent * N / 100) highest scores among the N documents with at least least_words words, else null.

    Null and empty texts and those without words have no features and weight 0. Of equal scores the smaller id comes first, null ids
    last; a null id draws its noise as an empty text. Rows that repeat an id are documents of their own (of equal score they follow in the order in
    which they are read). Without a target all buckets gain by the corpus alone; an empty table gives no rows. Other columns are not read.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent must lie between 0 and 100")
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = [feature_buckets(text, buckets) for text in batch["text"]]
            weight = [int(gain[h].sum()) // len(h) if len(h) else 0 for h in held]
            scores = [w + noise(i, seed) for w, i in zip(weight, batch["doc_id"], strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_features": [len(h) for h in held], "weight": weight, "score": scores})

    # Ids pass through Python as texts, because pandas makes doubles of integers beside nulls.
    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    scored = slim.mapInPandas(weigh, "doc_id string, n_features long, weight long, score long")
    scored = scored.withColumns({"doc_id": F.col("doc_id").cast("long"), "row_no": F.monotonically_increasing_id()})
    with scratch(docs.sparkSession) as out:
        return out(_drawn(frozen(scored, "scored"), percent, least_words), "drawn")


def _drawn(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    able = scored.where(F.col("n_features") >= 2 * least_words - 1).where(F.col("n_features") > 0)  # n words have 2 n - 1 features
    drawn = able.count() * percent // 100
    ranked = radix_ranked(able.select("row_no", "doc_id", "score"), [("score", True), ("doc_id", False)])
    ranks = ranked.where(F.col("place") < drawn).select("row_no", (F.col("place") + 1).alias("rank"))
    return scored.join(ranks, "row_no", "left").select("doc_id", "n_features", "weight", "score", "rank")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))


QUERIES = {"op11_importance_resampling": op11_importance_resampling}
ORACLES: dict[str, str] = {}
