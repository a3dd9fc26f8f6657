"""Exact quantiles of groups of any size, by selection.

The values at the ranks that the quantiles need are found by histograms: each wanted rank has an interval of values, the group's whole
range at first. A pass counts an interval's values in equal pieces and goes on with the piece that holds the rank, from its least to its greatest value,
until the interval holds one value alone or so few that they can be sorted. No task holds a group's values, and what moves between
tasks are counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudfeatures.sources.work import stored

PIECES = 4096  # of an interval in a pass
FEW = 100_000  # values of an interval that are sorted (800 KB)


def exact_quantiles(df: DataFrame, by: list[str], value: Column | str, shares: list[float], few: int = FEW, pieces: int = PIECES) -> DataFrame:
    """The columns by (none: one row), n (how many values a group has) and quantiles: an array of the values at these shares of the
    ranks, interpolated linearly between neighbours. Nulls, NaNs and infinite values don't count; a group without values gives no row.
    Null groups are groups like others."""
    if not shares or any(not 0 <= q <= 1 for q in shares):
        raise ValueError("shares must lie between 0 and 1")
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all_rows"))
    rows = df.select(group.alias("g"), value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < F.lit(float("inf"))))
    rows = stored(rows, "values")
    place = F.col("share") * (F.col("n") - 1)
    low = F.floor(place)
    wanted = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = wanted.withColumn("share", F.explode(F.array(*map(F.lit, map(float, sorted(set(shares)))))))
    asked = wanted.select("g", "n", "share", low.alias("k"), (place - low).alias("part"))
    wanted = wanted.select("g", "n", "lo", "hi", F.explode(F.array(low, F.least(low + 1, F.col("n") - 1))).alias("k")).distinct()
    # A row for each rank: it lies between lo and hi, `inside` values do, and `below` values lie below lo.
    wanted = stored(wanted.select("g", "k", "lo", "hi", F.lit(0).cast("bigint").alias("below"), F.col("n").alias("inside")), "ranks")
    wide = (F.col("lo") < F.col("hi")) & (F.col("inside") > few)
    while not (open_ := wanted.where(wide)).isEmpty():
        # Halves, so that the width of an interval is finite.
        at = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        counts = _inside(rows, open_).withColumn("piece", F.least(F.floor(at * pieces), F.lit(pieces - 1)))
        counts = counts.groupBy("g", "lo", "hi", "piece").agg(F.count("*").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        # `pieces` rows of each interval at most.
        upto = F.sum("c").over(Window.partitionBy("g", "lo", "hi").orderBy("piece"))
        counts = counts.withColumn("upto", upto).select("g", "lo", "hi", "least", "most", "c", (F.col("upto") - F.col("c")).alias("before"))
        found = open_.join(counts, ["g", "lo", "hi"]).where((F.col("below") + F.col("before") <= F.col("k")) & (F.col("k") < F.col("below") + F.col("before") + F.col("c")))
        found = found.select("g", "k", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("below") + F.col("before")).alias("below"), F.col("c").alias("inside"))
        wanted = stored(wanted.where(~wide).unionByName(found), "ranks")
    rest = wanted.where("lo < hi")
    # `few` values at most.
    sorted_ = _inside(rows, rest).groupBy("g", "lo", "hi").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    held = rest.join(sorted_, ["g", "lo", "hi"]).select("g", "k", F.get("vs", (F.col("k") - F.col("below")).cast("int")).alias("at_k"))
    values = wanted.where("lo = hi").select("g", "k", F.col("lo").alias("at_k")).unionByName(held)
    upper = values.select("g", (F.col("k") - 1).alias("k"), F.col("at_k").alias("at_next"))
    out = asked.join(values, ["g", "k"]).join(upper, ["g", "k"], "left")
    between = F.when(F.col("part") > 0, F.col("at_k") + (F.col("at_next") - F.col("at_k")) * F.col("part")).otherwise(F.col("at_k"))
    out = out.groupBy("g").agg(F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("share", between))).alias("found"))
    return out.select(*(F.col(f"g.{c}").alias(c) for c in by), "n", F.array(*(F.col("found")[F.lit(float(q))] for q in shares)).alias("quantiles"))


def _inside(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(g, lo, hi, v): the values in the intervals that are looked at, two for each share of a group at most."""
    spans = wanted.groupBy("g").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    hits = F.filter("spans", lambda s: (s["lo"] <= F.col("v")) & (F.col("v") <= s["hi"]))
    return rows.join(spans, "g").select("g", "v", F.inline(hits))
