"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on random directions, the projections are shifted and cut into steps of WIDTH, and K of them make a
bucket of one of T tables. Unit vectors of cosine c lie sqrt(2 - 2c) apart, which gives the chance that a pair shares a bucket; K follows
from a measured sample, so that a bucket holds about BLOCK vectors, and T from the wanted recall at the threshold itself. Pairs of
higher cosine are missed far less often.

Equal vectors are one class throughout. In a bucket every pair is compared by its exact cosine, and only a forest of the links leaves
the task. A bucket of more than BLOCK vectors is compared in blocks: within each block first, and then, once these links have made
components, everything outside the bucket's largest component against the whole bucket. All links lie within the components of the
forests, so that links are counted there, with each pair compared once more: vectors within half the threshold's angle of their
component's centre are linked with each other by the triangle inequality and counted without a comparison; the others are compared
with the whole component, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frozen, sampled, scratch, table
from .components import connected_components
from .topk import usable

WIDTH = 2.0  # of a step; unit vectors lie at most 2 apart
BLOCK = 1024  # vectors that are compared in one piece
SAMPLE = 1000  # vectors from which the share of pairs in one bucket is measured
MOST_DEPTH = 64
TABLES_AT_ONCE = 4  # whose vectors are exchanged together


def collision(distance: np.ndarray | float, width: float = WIDTH) -> np.ndarray:
    """The chance that one projection, cut into steps of this width, puts two vectors so far apart into one step."""
    r = np.maximum(np.asarray(distance, float), 1e-9)
    c = width / r
    tail = np.vectorize(lambda x: 0.5 * math.erfc(x / math.sqrt(2)))(c)
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * c) * (1 - np.exp(-(c**2) / 2))


def tables_for(rows: int, sample: np.ndarray, cosine: float, recall: float, block: int = BLOCK) -> tuple[int, int]:
    """(K, T): the least K for which a vector meets about `block` others in a table, by the distances within the sample of unit
    vectors; T tables reach the recall at the threshold."""
    depth = 1
    if len(sample) > 1:
        far = np.sqrt(np.maximum(2 - 2 * (sample @ sample.T)[np.triu_indices(len(sample), 1)], 0))
        far = far[far * far > 2 - 2 * cosine]  # links share buckets at any depth
        chance = collision(far)
        while depth < MOST_DEPTH and len(far) and (chance**depth).mean() * rows > block:
            depth += 1
    near = float(collision(math.sqrt(2 - 2 * cosine))) ** depth
    return depth, max(1, math.ceil(math.log(1 - recall) / math.log1p(-near)))


def unit_rows(raw: pd.Series | list, width: int, kind: str) -> np.ndarray:
    """Vectors as rows of length 1 in doubles, shorter ones filled with zeros; they are scaled by powers of two first, so that no
    square is lost."""
    out = np.zeros((len(raw), width))
    for i, x in enumerate(raw):
        v = np.frombuffer(x, kind)
        out[i, : len(v)] = v
    most = np.abs(out).max(axis=1, initial=0)
    out = np.ldexp(out, -np.frexp(most)[1][:, None])
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def stars(linked: np.ndarray) -> list[tuple[int, int]]:
    """From a symmetric matrix of links: (first member, other member) of each connected group of two or more."""
    loose = linked.copy()
    np.fill_diagonal(loose, False)
    todo, out = set(np.flatnonzero(loose.any(axis=1)).tolist()), []
    for root in sorted(todo):
        if root not in todo:
            continue
        todo.discard(root)
        edge = np.zeros(len(linked), bool)
        edge[root], seen = True, np.zeros(len(linked), bool)
        while edge.any():
            seen |= edge
            edge = loose[edge].any(axis=0) & ~seen
        group = np.flatnonzero(seen)
        todo.difference_update(group.tolist())
        out += [(root, int(x)) for x in group if x != root]
    return out


def near_vectors(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.999, seed: int = 13, block: int = BLOCK) -> DataFrame:
    """vectors: (vec_id long, vector array of float or double). A row for each of theirs: vec_id, n_links (other vectors with at least this
    cosine), component_id (smallest vec_id reachable by links, itself included), kept (vec_id = component_id).

    Null vectors, zero vectors and those with null or non-finite components link with nothing. Rows that repeat an id are vectors of
    their own; a row with a null id takes part, its own id never names a component, and it is kept only if it reaches no id at all. A
    shorter vector counts as if filled up with zeros. An empty table gives no rows; other columns are not read. recall is that of a
    pair exactly at the threshold whose vectors no other links connect; pairs within a component are always found.
    """
    if not 0 < cosine < 1 or not 0 < recall < 1:
        raise ValueError("cosine and recall must lie between 0 and 1")
    with scratch(vectors.sparkSession) as out:
        return out(_near(vectors, cosine, recall, seed, block), "near")


def _near(vectors: DataFrame, cosine: float, recall: float, seed: int, block: int) -> DataFrame:
    element = vectors.schema["vector"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = vectors.select("vec_id", "vector").withColumn("row", F.monotonically_increasing_id())

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Vectors as bytes, with a fingerprint of 128 bits; null where they link with nothing."""
        for batch in batches:
            raw = [None if v is None else np.trim_zeros(np.asarray(v, kind) + 0.0, "b").astype(kind).tobytes() or None for v in batch["vector"]]
            prints = [None if x is None else xxhash.xxh3_128_digest(x) for x in raw]
            yield pd.DataFrame({"row": batch["row"], "vec_id": batch["vec_id"], "print": prints, "raw": raw})

    # Ids pass through Python as texts, because pandas makes doubles of integers beside nulls.
    clean = rows.select("row", F.col("vec_id").cast("string").alias("vec_id"), F.when(usable(F.col("vector")), F.col("vector")).alias("vector"))
    rows = clean.mapInPandas(packed, "row long, vec_id string, print binary, raw binary")
    rows = frozen(rows.withColumn("vec_id", F.col("vec_id").cast("long")), "vectors")
    of_class = rows.where("print IS NOT NULL").groupBy("print")
    classes = of_class.agg(F.min("row").alias("rep"), F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.min_by("raw", "row").alias("raw"))
    classes = frozen(classes, "classes")
    width = (classes.agg(F.max(F.octet_length("raw"))).first()[0] or 0) // np.dtype(kind).itemsize
    n = classes.count()
    some = [r["raw"] for r in sampled(classes.select("rep", "raw"), SAMPLE, "rep").collect()]
    depth, tables = tables_for(n, unit_rows(some, width, kind), cosine, recall, block)

    links = _links(classes, width, kind, cosine, depth, tables, seed, block)
    labels = connected_components(links)
    found = _counted(classes, labels, width, kind, cosine, block)
    # Vectors that stand alone have no row here.
    names = found.groupBy("component").agg(F.min("least").alias("component_id"))
    found = frozen(found.join(names, "component").select("rep", "n_links", "component_id"), "found")
    copied = classes.where("copies > 1").select("print", "rep")
    rows = rows.select("row", "vec_id", "print").join(copied, "print", "left").withColumn("rep", F.coalesce("rep", "row"))
    out = rows.join(found, "rep", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _links(classes: DataFrame, width: int, kind: str, cosine: float, depth: int, tables: int, seed: int, block: int) -> DataFrame:
    """(a, b): forests of links, by reps."""
    bucket = ["table", "key"]

    def signed(first: int, last: int) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            hashes = []
            for t in range(first, last):
                rng = np.random.default_rng([seed, t])
                directions, shifts = rng.standard_normal((width, depth)), rng.uniform(0, WIDTH, depth)
                hashes.append((directions, shifts, rng.integers(0, 2**63, depth, np.uint64) | np.uint64(1)))
            for batch in batches:
                unit = unit_rows(batch["raw"], width, kind)
                for t, (directions, shifts, odd) in enumerate(hashes, first):
                    steps = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64).astype(np.uint64)
                    mixed = (steps * odd).sum(axis=1, dtype=np.uint64)
                    mixed ^= mixed >> np.uint64(31)
                    yield pd.DataFrame({"table": t, "key": mixed.astype(np.int64), "rep": batch["rep"], "raw": batch["raw"]})

        return classes.select("rep", "raw").mapInPandas(run, "table int, key long, rep long, raw binary")

    def within(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) < 2:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        unit, reps = unit_rows(rows["raw"], width, kind), rows["rep"].to_numpy()
        return pd.DataFrame([(reps[i], reps[j]) for i, j in stars(unit @ unit.T >= cosine)], columns=["a", "b"]).astype("int64")

    def across(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """Links between what is asked and a block, as links between their components."""
        if not len(asked) or not len(rows):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        linked = unit_rows(asked["raw"], width, kind) @ unit_rows(rows["raw"], width, kind).T >= cosine
        i, j = np.nonzero(linked)
        names, of = np.unique(np.concatenate([asked["component"].to_numpy()[i], rows["component"].to_numpy()[j]]), return_inverse=True)
        meets = np.zeros((len(names), len(names)), bool)
        meets[of[: len(i)], of[len(i) :]] = True
        return pd.DataFrame([(names[a], names[b]) for a, b in stars(meets | meets.T)], columns=["a", "b"]).astype("int64")

    parts, large = [], []
    for first in range(0, tables, TABLES_AT_ONCE):
        at = first, min(tables, first + TABLES_AT_ONCE)
        big = signed(*at).groupBy(bucket).count().where(F.col("count") > block)
        large.append(frozen(big.select(*bucket, F.ceil(F.col("count") / block).cast("int").alias("blocks")), "large"))
        dealt = signed(*at).join(large[-1], bucket, "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("rep"), "blocks"), F.lit(0)))
        parts.append(frozen(dealt.groupBy(*bucket, "block").applyInPandas(within, "a long, b long"), "links"))
    links = parts[0]
    for part in parts[1:]:
        links = links.unionByName(part)
    if all(big.isEmpty() for big in large):
        return links

    labels = connected_components(links).withColumnRenamed("node", "rep")
    for i, big in enumerate(large):
        if big.isEmpty():
            continue
        first = i * TABLES_AT_ONCE
        rows = signed(first, min(tables, first + TABLES_AT_ONCE)).join(big, bucket)
        rows = frozen(rows.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "mixed")
        shares = rows.groupBy(*bucket, "component").count()
        most = shares.groupBy(bucket).agg(F.max_by("component", F.struct("count", "component")).alias("most"), F.sum("count").alias("n"), F.max("count").alias("held"))
        most = frozen(most.where("n > held").withColumn("chunks", F.ceil((F.col("n") - F.col("held")) / block).cast("int")).drop("n", "held"), "most")
        rows = rows.join(most, bucket)
        links = links.unionByName(frozen(_compared(rows.where("component <> most"), rows, bucket, across, "a long, b long"), "links"))
    return links


def _compared(asked: DataFrame, rows: DataFrame, group: list[str], compare, schema: str) -> DataFrame:
    """What compare(asked, rows) gives for all of a group's asked rows against all of its rows, in pieces: asked rows are dealt out to
    `chunks` pieces and rows to `blocks`, and each pair of pieces meets in a task."""
    place = [*group, "chunk_no", "block_no"]
    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = lambda c: F.pmod(F.xxhash64("rep", F.lit(c)), c).cast("int")
    # Aliases give the columns numbers of their own, so that the two sides of the cogroup, made of one table, can be told apart.
    asked = asked.withColumns({"chunk_no": dealt("chunks"), "block_no": numbers("blocks")})
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))
    rows = rows.withColumns({"block_no": dealt("blocks"), "chunk_no": numbers("chunks")})
    return asked.groupBy(place).cogroup(rows.groupBy(place)).applyInPandas(compare, schema)


def _counted(classes: DataFrame, labels: DataFrame, width: int, kind: str, cosine: float, block: int) -> DataFrame:
    """(rep, component, least, n_links) of each class of several vectors or with links."""
    members = classes.select("rep", "copies", "least", "raw").join(labels.withColumnRenamed("node", "rep"), "rep")
    centres = members.where("rep = component").select("component", F.col("raw").alias("centre"))
    half = math.cos(math.acos(cosine) / 2 - 1e-6)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = (unit_rows(batch["raw"], width, kind) * unit_rows(batch["centre"], width, kind)).sum(axis=1)
            yield batch.drop(columns="centre").assign(core=near >= half)

    schema = "component long, rep long, copies long, least long, raw binary, core boolean"
    members = members.join(centres, "component").select("component", "rep", "copies", "least", "raw", "centre")
    members = frozen(members.mapInPandas(place, schema), "members")
    core_copies = F.coalesce(F.sum(F.when(F.col("core"), F.col("copies"))), F.lit(0)).alias("core_copies")
    sizes = members.groupBy("component").agg(core_copies, F.count("*").alias("n"), F.count_if(~F.col("core")).alias("asked"))
    sizes = frozen(sizes, "sizes")
    open_ = sizes.where("asked > 0").select("component", *(F.ceil(F.col(c) / block).cast("int").alias(a) for c, a in (("n", "blocks"), ("asked", "chunks"))))

    def count(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """Each asked row's links to a block; and those of the block's core, which is not asked, to the asked rows."""
        if not len(asked) or not len(rows):
            return pd.DataFrame({"rep": [], "n": []}).astype("int64")
        linked = unit_rows(asked["raw"], width, kind) @ unit_rows(rows["raw"], width, kind).T >= cosine
        linked &= asked["rep"].to_numpy()[:, None] != rows["rep"].to_numpy()
        core = rows["core"].to_numpy()
        reps = np.concatenate([asked["rep"], rows["rep"][core]])
        return pd.DataFrame({"rep": reps, "n": np.concatenate([linked @ rows["copies"].to_numpy(), asked["copies"].to_numpy() @ linked[:, core]])})

    rows = members.join(open_, "component")
    more = _compared(rows.where("NOT core"), rows, ["component"], count, "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n"))
    own = F.when(F.col("core"), F.col("core_copies")).otherwise(F.col("copies")) - 1 + F.coalesce("n", F.lit(0))
    slim = members.select("component", "rep", "copies", "least", "core").join(sizes.select("component", "core_copies"), "component")
    linked = slim.join(more, "rep", "left").select("rep", "component", "least", own.alias("n_links"))
    alone = classes.where("copies > 1").join(labels.select(F.col("node").alias("rep")), "rep", "left_anti")
    return linked.unionByName(alone.select("rep", F.col("rep").alias("component"), "least", (F.col("copies") - 1).alias("n_links")))


def op13_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")), 0.9)


OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT *, vec_id = component_id AS kept FROM (
  SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, least(vec_id, (SELECT min(b) FROM reach WHERE a = vec_id)) AS component_id
  FROM embeddings)
"""

QUERIES = {"op13_embedding_neardup": op13_embedding_neardup}
ORACLES = {"op13_embedding_neardup": OP13_SQL}
