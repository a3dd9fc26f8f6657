"""Vector codes: each vector is cut into parts, and each part is replaced by the number of its nearest codebook entry.

The nearest entry is found by equal-average search. Entries are sorted by the sum of their components. Of two integer vectors of d
components whose sums differ by g, the squared distance is g * g / d at least; so a part starts at the entry of the nearest sum, expands
outward on both sides, and stops where g * g / d strictly exceeds the best distance so far (strictly, because an entry of equal
distance and lower number may follow). Codebooks are learned in rounds: every part is assigned, tasks add up the parts of each entry,
and an entry moves to the floor of their mean. Codebooks are bounded by their parameters and travel to the tasks; vectors never leave
their partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frozen, table
from .topk import usable

SALTS = 16  # pieces of a label's rows when they meet the label's sum


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest entry, squared distance) of each part, ties to the lower number, by equal-average search."""
    d = parts.shape[1]
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sorted_entries, sums, k = entries[order], sums[order], len(order)
    own = parts.sum(axis=1)
    best, found = np.full(len(parts), np.iinfo(np.int64).max), np.full(len(parts), k)
    high = np.searchsorted(sums, own)
    low, open_ = high - 1, np.arange(len(parts))
    while len(open_):
        lo, hi, s = low[open_], high[open_], own[open_]
        gap_low = np.where(lo >= 0, s - sums[np.maximum(lo, 0)], -1)
        gap_high = np.where(hi < k, sums[np.minimum(hi, k - 1)] - s, -1)
        up = (gap_high >= 0) & ((gap_low < 0) | (gap_high < gap_low))
        gap = np.where(up, gap_high, gap_low)
        # gap * gap / d > best, in integers; below it best * d cannot overflow.
        on = (gap >= 0) & ((gap * gap - 1) // d < best[open_])
        open_, up = open_[on], up[on]
        at = np.where(up, hi[on], lo[on])
        away = parts[open_] - sorted_entries[at]
        away, number = (away * away).sum(axis=1), order[at]
        closer = (away < best[open_]) | ((away == best[open_]) & (number < found[open_]))
        best[open_[closer]], found[open_[closer]] = away[closer], number[closer]
        high[open_[up]] += 1
        low[open_[~up]] -= 1
    return found, best


def largest(width: int) -> int:
    """Components beyond this, in either direction, count as this, so that no squared sum of differences leaves 64 bits."""
    return 2 ** (29 - max(1, width).bit_length())


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """vectors: (vec_id long, vector array of numbers, label). A row for each vector kept: vec_id, code (two hex digits or more a part),
    error (squared distances of its parts to their entries, summed), label_error (errors of its label, summed; nulls are one label)
    and codebooks_sha256.

    Vectors that are null or hold null or non-finite components are dropped. Components become floor(scale * x); those beyond `largest`
    of a part's width count as that (x of 262,144 and more for 64 components in 16 parts). Vectors are filled up with zeros to the longest
    one's length, and that to a multiple of `parts`. The first codebooks are the vectors of the smallest ids, null ids last, rows of
    one id in the order of their bytes; with fewer vectors there are fewer entries. Rows that repeat an id are vectors of their own.
    Without vectors there are no rows. Other columns are not read.
    """
    if min(parts, entries) < 1 or rounds < 0:
        raise ValueError("parts, entries and rounds must be positive")
    # Ids and labels pass through Python as texts, because pandas makes doubles of integers beside nulls.
    names = (F.col(c).cast("string").alias(c) for c in ("vec_id", "label"))
    clean = vectors.where(usable(F.col("vector"))).select(*names, "vector")
    length = clean.agg(F.max(F.size("vector"))).first()[0]
    width = max(1, -(-(length or 1) // parts))  # of a part
    most = largest(width)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = np.zeros((len(batch), parts * width))
            for i, x in enumerate(batch["vector"]):
                v[i, : len(x)] = x
            v = np.clip(np.floor(np.clip(v, -most, most) * scale), -most, most).astype("<i4")
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "whole": [x.tobytes() for x in v]})

    whole_rows = frozen(clean.mapInPandas(whole, "vec_id string, label string, whole binary"), "whole")
    unpack = lambda raw: np.array([np.frombuffer(x, "<i4") for x in raw], np.int64).reshape(len(raw), parts, width)
    # `entries` rows; of rows that repeat an id, those of the smallest bytes.
    smallest = whole_rows.orderBy(F.col("vec_id").cast("long").asc_nulls_last(), F.hex("whole")).limit(entries)
    books = unpack([r["whole"] for r in smallest.collect()]).transpose(1, 0, 2)  # part, entry, component

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What a task's parts add to each entry: a row for each part, entry and component, and a count."""
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            if len(batch):
                x = unpack(batch["whole"])
                for p in range(parts):
                    number, _ = nearest(x[:, p], books[p])
                    np.add.at(sums[p], number, x[:, p])
                    counts[p] += np.bincount(number, minlength=books.shape[1])
        part, entry = np.nonzero(counts)
        for i in range(width):
            yield pd.DataFrame({"part": part, "entry": entry, "place": i, "total": sums[part, entry, i], "n": counts[part, entry]})

    for _ in range(rounds if books.size else 0):
        totals = whole_rows.mapInPandas(added, "part int, entry int, place int, total long, n long")
        totals = totals.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        moved = books.copy()
        for r in totals.collect():  # entries x components at most
            moved[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
        books = moved
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    digits = max(2, len(f"{max(0, entries - 1):x}"))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x, codes, error = unpack(batch["whole"]), [], np.zeros(len(batch), np.int64)
            for p in range(parts):
                number, away = nearest(x[:, p], books[p])
                codes.append(number)
                error += away
            text = ["".join(f"{c:0{digits}x}" for c in row) for row in np.array(codes).T.tolist()]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "code": text, "error": error})

    out = frozen(whole_rows.mapInPandas(coded, "vec_id string, label string, code string, error long"), "codes")
    # A label may hold a third of all rows: its sum meets them in pieces.
    totals = out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    totals = totals.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = out.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    out = out.join(totals, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("piece")))
    return out.select(F.col("vec_id").cast("long").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vector_codes(rows.select("vec_id", F.col("embedding").alias("vector"), "label"))


def _assign_sql(n: int) -> str:
    """Each part's nearest entry among those of codebook n."""
    return f"""a{n} AS (SELECT vec_id, p, arg_min(e, (far, e)) AS e, min(far) AS far FROM (
  SELECT x.vec_id, x.p, b.e, CAST(sum((x.x - b.x) * (x.x - b.x)) AS BIGINT) AS far FROM x JOIN b{n} b ON b.p = x.p AND b.i = x.i GROUP BY ALL) GROUP BY 1, 2)"""


def _moved_sql(n: int) -> str:
    """Codebook n from the assignment before."""
    return f"""b{n} AS (SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM b{n - 1} b LEFT JOIN (
  SELECT x.p, a.e, x.i, CAST(floor(sum(x.x) / count(*)) AS BIGINT) AS x FROM x JOIN a{n - 1} a ON a.vec_id = x.vec_id AND a.p = x.p GROUP BY ALL) m
  ON m.p = b.p AND m.e = b.e AND m.i = b.i)"""


OP12_SQL = f"""
WITH v AS (
  SELECT vec_id, label, [CAST(floor(256 * CAST(y AS DOUBLE)) AS BIGINT) FOR y IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0
), x AS (
  SELECT vec_id, (i - 1) // (len(v) // 16) AS p, (i - 1) % (len(v) // 16) AS i, v[i] AS x FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM v)
), b0 AS (
  SELECT x.p, n.e, x.i, x.x FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v) n ON n.vec_id = x.vec_id WHERE n.e < 64
), {_assign_sql(0)}, {_moved_sql(1)}, {_assign_sql(1)}, {_moved_sql(2)}, {_assign_sql(2)}, c AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM a2 GROUP BY 1
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
 (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM b2) AS codebooks_sha256
FROM c JOIN v USING (vec_id)
"""

QUERIES = {"op12_vector_codes": op12_vector_codes}
ORACLES = {"op12_vector_codes": OP12_SQL}
