"""Connected components by hooking, pointer jumping and contraction, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frozen


def _roots(parent: DataFrame) -> DataFrame:
    """From (hi, parent) with parent < hi: each hi with the end of its chain of parents. Chains get four times shorter
    with each table written."""
    while True:
        for _ in range(2):
            up = parent.select(F.col("hi").alias("parent"), F.col("parent").alias("next"))
            parent = parent.drop("moved").join(up, "parent", "left")
            parent = parent.select("hi", F.coalesce("next", "parent").alias("parent"), F.col("next").isNotNull().alias("moved"))
        parent = frozen(parent, "parents")
        if parent.where("moved").isEmpty():
            return parent.drop("moved")


def connected_components(links: DataFrame) -> DataFrame:
    """From links (a, b) of long ids, in any direction and with repeats: a row (node, component) for each id that has a
    link to another; the component is its smallest id. Links of a node to itself and links with nulls are left out; an
    empty table gives no rows.

    In each round every label hooks on to its smallest smaller neighbour, pointer jumping finds where these chains end,
    links are rewritten to the ends, and those inside a label vanish. A chain of n ids is gone after one round of about
    log4(n) tables; links that many ids share shrink in the first round; no neighbourhood is collected.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = frozen(edges, "edges")
    labels = edges.select(F.explode(F.array("hi", "lo")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        root = _roots(edges.groupBy("hi").agg(F.min("lo").alias("parent")))
        labels = labels.join(root.select(F.col("hi").alias("component"), "parent"), "component", "left")
        labels = labels.select("node", F.coalesce("parent", "component").alias("component"))
        high, low = (root.select(F.col("hi").alias(c), F.col("parent").alias(f"{c}_up")) for c in ("hi", "lo"))
        moved = edges.join(high, "hi").join(low, "lo", "left").select(F.col("hi_up").alias("x"), F.coalesce("lo_up", "lo").alias("y"))
        edges = moved.where("x <> y").select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct()
        edges = frozen(edges, "edges")
    return frozen(labels, "labels")
