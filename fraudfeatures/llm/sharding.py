"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

The rows lie in blocks, which are the partitions that they are read in. Each block permutes its rows where they lie. How many
rows of each block go to each shard is drawn exactly as a uniform shuffle of all rows would have it (a multivariate
hypergeometric draw with the block sizes and the shard sizes as margins), and each block deals its rows out by those counts.
Then the rows are exchanged, once, and each shard permutes what it got. Only the matrix of counts (partitions x shards) is
drawn on the driver; rows stay in DataFrame operations.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, frozen, table


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many good ones a draw without replacement has: inversion outwards from the mode, about one standard
    deviation of steps."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    ln = math.lgamma
    log_p = (
        ln(good + 1) - ln(mode + 1) - ln(good - mode + 1)
        + ln(bad + 1) - ln(draws - mode + 1) - ln(bad - draws + mode + 1)
        - ln(good + bad + 1) + ln(draws + 1) + ln(good + bad - draws + 1)
    )
    p_mode, u = math.exp(log_p), rng.random()
    u -= p_mode
    if u < 0:
        return mode
    up, down, p_up, p_down = mode, mode, p_mode, p_mode
    while up < high or down > low:
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u < 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u < 0:
                return down
    return mode  # rounding left a little probability over


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """Counts with these margins, distributed as under a uniform shuffle of all rows."""
    if sum(block_sizes) != sum(shard_sizes):
        raise ValueError("blocks and shards must hold equally many rows")
    rng, left, out = random.Random(seed), list(shard_sizes), []
    for size in block_sizes:
        row, draws, rest = [], size, sum(left)
        for room in left:
            got = hypergeometric(rng, room, rest - room, draws)
            row.append(got)
            rest -= room
            draws -= got
        left = [a - b for a, b in zip(left, row, strict=True)]
        out.append(row)
    return out


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, blocks: int = 16_384, run_rows: int = 500_000) -> DataFrame:
    """df with two columns more, `shard` (0 to shards - 1) and `slot` (gapless from 0 within the shard); if df has
    columns of these names, theirs get underscores in front.

    Shard sizes differ by one at most. Every arrangement of the rows is equally likely, given the seed's randomness.
    Repeated rows, null keys and nulls in any column are rows like others, since each row gets a number of its own,
    frozen in the shared folder before anything is drawn. An empty df gives no rows; with fewer rows than shards the
    last shards stay empty. Partitions of df are blocks, merged without an exchange if they are more than `blocks`. A shard is
    sorted in runs of about run_rows rows, so that the size of a task does not grow with the table.
    """
    if shards < 1 or blocks < 1 or run_rows < 1:
        raise ValueError("shards, blocks and run_rows must be positive")
    spark, columns = df.sparkSession, df.columns
    taken = df
    row_no, block = fresh(taken, "row_no"), fresh(taken, "block_no")
    rank, deal, run = fresh(taken, "rank_no"), fresh(taken, "deal_to"), fresh(taken, "run_no")
    shard, slot = fresh(taken, "shard"), fresh(taken, "slot")
    # First permutation, in each block: rows are sorted by a hash of their number and numbered anew, the block's number in
    # the upper bits, the place in the block in the lower 33.
    numbered = df.coalesce(blocks).withColumn(row_no, F.monotonically_increasing_id())
    numbered = numbered.sortWithinPartitions(F.xxhash64(row_no, F.lit(seed), F.lit("block")), row_no)
    numbered = frozen(numbered.withColumn(row_no, F.monotonically_increasing_id()), "shards")
    placed = numbered.withColumns({block: F.shiftright(row_no, 33), rank: F.col(row_no).bitwiseAND(F.lit(2**33 - 1)) + 1})

    # A count for each block.
    sizes = {r[0]: r[1] for r in placed.groupBy(block).count().collect()}
    numbers = sorted(sizes)
    total = sum(sizes.values())
    shard_sizes = [total // shards + (s < total % shards) for s in range(shards)]
    rows = []
    for b, counts in zip(numbers, communication_matrix([sizes[b] for b in numbers], shard_sizes, seed), strict=True):
        ends, end = [], 0
        for count in counts:
            ends.append(end := end + count)
        rows.append((b, ends))
    # blocks x shards counts: 5 MB for 40 shards.
    ends = spark.createDataFrame(rows, f"`{block}` bigint, `{deal}` array<bigint>")
    # The block's next counts[s] rows go to shard s.
    dealt = placed.join(F.broadcast(ends), block)
    dealt = dealt.withColumn(shard, F.size(F.filter(deal, lambda end: end < F.col(rank)))).drop(deal, rank)
    runs = max(8, -(-total // shards // run_rows))

    # Second permutation, in each shard, by a random number whose leading part tells the run: runs are sorted apart and
    # begin where the runs before them end.
    number = F.xxhash64(row_no, F.lit(seed), F.lit("shard"))
    dealt = dealt.withColumn(run, (F.shiftrightunsigned(number, 33) * F.lit(runs) / F.lit(2**31)).cast("int"))
    counts = dealt.groupBy(shard, run).agg(F.count("*").alias(deal))
    before = Window.partitionBy(shard).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, run, F.coalesce(F.sum(deal).over(before), F.lit(0)).alias(deal))
    own = Window.partitionBy(shard, run).orderBy(number, row_no)
    # starts has shards x runs rows at most: a row for some run_rows rows of df.
    placed = dealt.withColumn(rank, F.row_number().over(own)).join(starts, [shard, run])
    return placed.withColumn(slot, F.col(deal) + F.col(rank) - 1).select(*columns, F.col(shard), F.col(slot))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    slim = docs.select(
        "doc_id", (F.octet_length(text) + F.lit(16)).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return shuffle_into_shards(slim, 40, seed=20).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op2_sharding": op2_sharding}
ORACLES: dict[str, str] = {}
