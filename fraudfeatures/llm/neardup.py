"""Near duplicates by a MinHash LSH forest.

Every document has a signature of `trees` runs of DEPTH minima. Each tree sorts all documents by one run, so that those
with a long common prefix stand next to each other. A document's candidate is, over all the orders, its neighbour of the
longest common prefix: the depth that is looked at adapts to how crowded the documents' region is, from DEPTH minima down
to the least depth that finds a pair of the wanted similarity with near certainty. Candidates whose signatures agree well
enough are confirmed on the full shingle sets, and what hangs together is one component. In the next rounds the
neighbours are the nearest documents of other components, so that components grow together however large they are.

What neighbours have not shown is settled exactly: a region (the documents that share the least depth in a tree) that still
holds several components is compared in blocks, only across components, and only the links leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget_in_worker, frozen, per_worker, scratch, table
from .components import connected_components
from .words import WordHashes, shingle_set, word_hashes

DEPTH = 8  # minima of a tree, four bytes each
NEIGHBOUR_ROUNDS = 2  # rounds that look at neighbours; what is left is compared in blocks
BLOCK = 1024  # documents of a region that are compared with each other or with another block at a time
BLOCK_SHINGLES = 2_000_000  # shingles of a block's documents, about; 16 MB
SETS_BATCH = 500_000  # shingles that a task hands over at a time
CHUNK = 64  # documents of a block whose pairs are held at a time
KEY = ["region", "block_a", "block_b"]
MEMBER = "region long, block_a int, block_b int, tree int, node long, component long, n_shingles long, own int, signature binary"
PLACE = "a long, a_component long, b long, b_component long, prefix int, part int, last boolean, tree int, run binary"
LABEL_LIMIT = 500_000  # labels to broadcast (16 bytes each)
ID_LIMIT = 300_000  # ids to broadcast (15 MB); beyond, the join is by shuffle
PAIR = ["a", "a_component", "b", "b_component"]


def least_depth(similarity: float, trees: int, miss: float = 2e-5) -> int:
    """The longest prefix at which a pair of this similarity shares no region in any tree with probability `miss` at
    most. Similarities that the trees are too few for are refused."""
    for depth in range(DEPTH, 0, -1):
        if (1 - similarity**depth) ** trees <= miss:
            return depth
    raise ValueError(f"{trees} trees miss pairs of similarity {similarity:.2f} more often than {miss}: take more")


def _multipliers(trees: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(17)
    half = trees * DEPTH // 2
    return rng.integers(0, 2**63, half, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, half, np.uint64)


def signature(shingles: np.ndarray, factor: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Minima of 2 x len(factor) hash functions; each product gives two hashes of 32 bits."""
    least = np.full(2 * len(factor), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 1024):
        product = shingles[at : at + 1024, None] * factor + offset
        np.minimum(least, product.view(np.uint32).min(axis=0), out=least)
    return least


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of shingles."""
    mixed = (shingles ^ (shingles >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return int(shingles.sum().view(np.int64)), int((mixed ^ (mixed >> np.uint64(30))).sum().view(np.int64))


def digests(docs: DataFrame, words: int, trees: int) -> DataFrame:
    """doc_id, n_shingles, set_hi and set_lo (fingerprint of the shingle set, 128 bits), signature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, (factor, offset) = per_worker((WordHashes.__name__,), WordHashes), _multipliers(trees)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = shingle_set(word_hashes(text, cache), words)
                if not len(found):
                    rows.append((doc_id, 0, 0, 0, None))
                    continue
                rows.append((doc_id, len(found), *fingerprint(found), signature(found, factor, offset).astype(">u4").tobytes()))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_hi", "set_lo", "signature"])
            out["doc_id"] = batch["doc_id"].to_numpy()
            yield out

    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    return known.mapInPandas(run, "doc_id long, n_shingles long, set_hi long, set_lo long, signature binary")


def _prefix(depth: int) -> Column:
    return F.substr("run", F.lit(1), F.lit(4 * depth))


def _labelled(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """nodes with their component; those without a label are components of their own."""
    if labels is None:
        return nodes.withColumn("component", F.col("node"))
    return nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _orders(nodes: DataFrame, labels: DataFrame | None, trees: int, least: int) -> DataFrame:
    """A row for each document's place in each order: tree, run, node, component, n_shingles, region. Without labels each is
    a component of its own."""
    runs = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), F.substr("signature", t * (4 * DEPTH) + 1, F.lit(4 * DEPTH)).alias("run")))
    rows = _labelled(nodes, labels).select("node", "component", "n_shingles", F.inline(runs))
    return rows.withColumn("region", F.xxhash64("tree", _prefix(least)))


def _mixed(rows: DataFrame) -> DataFrame:
    """Regions that hold several components: region, n (documents), shingles (of all of them)."""
    sizes = rows.groupBy("region").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    return sizes.where("x <> y").select("region", "n", "shingles")


def _common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.cumprod(a == b, axis=1).sum(axis=1)


class _Places:
    """The rows of one order that were seen last: the last one, and before it the last one of another component."""

    def __init__(self):
        self.rows: pd.DataFrame | None = None

    def neighbours(self, batch: pd.DataFrame) -> pd.DataFrame:
        """For each row of the batch the nearest row before it of another component in the same order, with the length of
        their common prefix; none has 0."""
        kept = 0 if self.rows is None else len(self.rows)
        x = batch if self.rows is None else pd.concat([self.rows, batch], ignore_index=True)
        node, part, tree = (x[c].to_numpy() for c in ("node", "component", "tree"))
        run = np.frombuffer(b"".join(x["run"]), ">u4").reshape(len(x), DEPTH)
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (tree[1:] != tree[:-1])])
        before = np.maximum.accumulate(np.where(new, np.arange(len(x)), 0)) - 1
        at = np.maximum(before, 0)
        prefix = np.where((before >= 0) & (tree == tree[at]), _common_prefix(run, run[at]), 0)
        self.rows = x.iloc[[i for i in (before[-1], len(x) - 1) if i >= 0]]
        out = pd.DataFrame({"a": node, "a_component": part, "b": node[at], "b_component": part[at], "prefix": prefix})
        return out.iloc[kept:]


def _lcp_neighbours(rows: DataFrame, least: int) -> DataFrame:
    """For each document of rows (tree, run, node, component) with a neighbour of another component and at least this common prefix in
    any order, that of the longest: PAIR. Orders are sorted over many tasks by range; the last place of each task meets
    the first of the next one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_in_worker()
        places, part, first = _Places(), TaskContext.get().partitionId(), None
        ends = ["node", "component", "tree", "run"]
        for batch in batches:
            if len(batch):
                first = batch.iloc[:1][ends] if first is None else first
                out = places.neighbours(batch)
                yield out.assign(part=pd.NA, last=None, tree=pd.NA, run=None)
        if first is not None:
            end = pd.concat([first, places.rows.iloc[-1:][ends]]).rename(columns={"node": "a", "component": "a_component"})
            yield end.assign(b=pd.NA, b_component=pd.NA, prefix=pd.NA, part=part, last=[False, True])[PLACE.replace(",", "").split()[::2]]

    ordered = rows.select("tree", "run", "node", "component").repartitionByRange("tree", "run", "node").sortWithinPartitions("tree", "run", "node")
    places = frozen(ordered.mapInPandas(run, PLACE), "places")
    # Two rows for each task of the sort.
    ends = places.where("part IS NOT NULL").orderBy("part", "last").collect()
    borders = []
    for x, y in zip(ends[1::2], ends[2::2], strict=False):
        same = int(_common_prefix(*(np.frombuffer(r["run"], ">u4")[None] for r in (x, y)))[0])
        if x["tree"] == y["tree"] and x["a_component"] != y["a_component"] and same:
            borders.append((y["a"], y["a_component"], x["a"], x["a_component"], same))
    found = places.where("part IS NULL").select(*PAIR, "prefix")
    if borders:
        found = found.unionByName(rows.sparkSession.createDataFrame(borders, found.schema))
    # The tie is broken by a hash, so that a crowd does not choose one and the same document.
    best = F.max_by(F.struct("b", "b_component"), F.struct("prefix", F.xxhash64("a", "b"), "b"))
    best = found.groupBy("a", "a_component").agg(F.max("prefix").alias("prefix"), best.alias("best")).where(F.col("prefix") >= least)
    return best.select("a", "a_component", "best.b", "best.b_component")


def _agreement(a: pd.Series, b: pd.Series) -> np.ndarray:
    left, right = (np.frombuffer(b"".join(x), np.uint32).reshape(len(x), -1) for x in (a, b))
    return (left == right).mean(axis=1)


def _plausible(similarity: float, trees: int) -> float:
    """Agreement of signatures that a pair of this similarity falls short of by a chance of about one in a million."""
    return similarity - 4.9 * math.sqrt(similarity * (1 - similarity) / (trees * DEPTH))


def _agreeing(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Of pairs (PAIR), those whose signatures agree well enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_in_worker()
        for x in batches:
            if len(x):
                yield x.loc[_agreement(x["sig_a"], x["sig_b"]) >= least, PAIR]

    left, right = (nodes.select(F.col("node").alias(c), F.col("signature").alias(f"sig_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select(*PAIR, "sig_a", "sig_b").mapInPandas(run, pairs.select(PAIR).schema)


def _shingles(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, shingles (sorted): the full sets of these nodes (node, distinct), from the text of one of their documents; a
    text of the same doc_id that has another set is passed over."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = per_worker((WordHashes.__name__,), WordHashes)

        def made(ids: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            values = pa.array(np.concatenate([*found, np.zeros(0, np.int64)]))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(ends, values)], ["node", "shingles"])

        for batch in batches:
            ids, found, size = [], [], 0
            for node, hi, lo, text in zip(*(batch.column(c).to_pylist() for c in ("node", "set_hi", "set_lo", "text")), strict=True):
                own = shingle_set(word_hashes(text, cache), words)
                if fingerprint(own) != (hi, lo):
                    continue
                ids.append(node)
                found.append(np.sort(own.view(np.int64)))
                size += len(found[-1])
                if size >= SETS_BATCH:
                    yield made(ids, found)
                    ids, found, size = [], [], 0
            yield made(ids, found)

    one = frozen(nodes.join(wanted, "node", "left_semi").select("node", "doc_id", "set_hi", "set_lo"), "wanted")
    one = F.broadcast(one) if one.count() <= ID_LIMIT else one
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(one, "doc_id").drop("doc_id")
    return frozen(texts.mapInArrow(sets, "node long, shingles array<long>"), "sets")


def _in_common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """Links (a, b) between the components of those pairs (PAIR) whose full shingle sets have the similarity."""
    top, bottom = similarity
    pairs = frozen(pairs, "pairs")
    found = _shingles(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, nodes, words)
    left, right = (found.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    both = F.size(F.array_intersect("set_a", "set_b"))
    hold = both * bottom >= top * (F.size("set_a") + F.size("set_b") - both)
    joined = pairs.join(left, "a").join(right, "b").where(hold)
    return frozen(joined.select(F.col("a_component").alias("a"), F.col("b_component").alias("b")).distinct(), "links")


def _joined_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """labels (node, component), of nodes that have links alone, after links (a, b) between components. They are marked to be
    broadcast if they are few enough, so that the wide rows that they are joined with need not be exchanged."""
    new = connected_components(links)
    if labels is not None:
        up = new.select(F.col("node").alias("component"), F.col("component").alias("up"))
        old = labels.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        new = frozen(old.unionByName(new.join(labels, "node", "left_anti")), "labels")
    return F.broadcast(new) if new.count() <= LABEL_LIMIT else new


def _mixed_blocks(nodes: DataFrame, labels: DataFrame | None, trees: int, least: int) -> DataFrame:
    """The documents of regions with several components, each with every block pair it belongs to, those of a block pair
    one after another. A small region is one block."""
    rows = _orders(nodes, labels, trees, least).select("region", "tree", "node", "component")
    members = rows.join(_mixed(_orders(nodes, labels, trees, least)), "region")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    spread = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("own", other).alias("block_a"), F.greatest("own", other).alias("block_b")),
    )
    dealt = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("at", F.explode(spread))
    dealt = dealt.join(nodes.select("node", "n_shingles", "signature"), "node")
    dealt = dealt.select("region", "at.block_a", "at.block_b", "tree", "node", "component", "n_shingles", "own", "signature")
    return dealt.repartition(*KEY).sortWithinPartitions(*KEY, "node")


def _runs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each block pair, which follow one another."""
    forget_in_worker()
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        keys = batch[KEY].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield batch.iloc[a:b]
        rest = batch.iloc[starts[-1] :]
    if rest is not None:
        yield rest


class _Roots(dict):
    """Union and find over component ids."""

    def find(self, x: int) -> int:
        while self.get(x, x) != x:
            x = self[x] = self.get(self[x], self[x])
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self[max(x, y)] = min(x, y)
        return x != y


class _Search:
    """What tasks do with the documents of block pairs."""

    def __init__(self, trees: int, least: int, plausible: float, top: int, bottom: int):
        self.trees, self.least, self.plausible, self.top, self.bottom = trees, least, plausible, top, bottom

    def pairs(self, x: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of pairs in different components whose signatures agree well enough and that share no region in an
        earlier tree: those of CHUNK documents at a time, the likeliest first."""
        tree, across = int(x["tree"].iloc[0]), x["block_a"].iloc[0] != x["block_b"].iloc[0]
        flat = np.frombuffer(b"".join(x["signature"]), np.uint32).reshape(len(x), -1)
        heads = flat.reshape(len(x), self.trees, -1)[:, :tree, : self.least]
        size, part, own = (x[c].to_numpy() for c in ("n_shingles", "component", "own"))
        order = np.argsort(size, kind="stable")
        found = []
        for at, i in enumerate(order[:-1]):
            # Sets of too different size cannot have the similarity.
            j = order[at + 1 : np.searchsorted(size[order], size[i] * self.bottom // self.top, "right")]
            j = j[part[j] != part[i]]
            if across:
                j = j[own[j] != own[i]]
            if len(j):
                agreement = (flat[j] == flat[i]).mean(axis=1, dtype=np.float32)
                j, agreement = j[agreement >= self.plausible], agreement[agreement >= self.plausible]
            if len(j) and tree:
                new = ~(heads[j] == heads[i]).all(axis=2).any(axis=1)
                j, agreement = j[new], agreement[new]
            if len(j):
                found.append((np.full(len(j), i), j, agreement))
            if found and (at % CHUNK == CHUNK - 1 or at == len(order) - 2):
                a, b, agreement = map(np.concatenate, zip(*found, strict=True))
                likeliest = np.argsort(-agreement, kind="stable")
                yield a[likeliest], b[likeliest]
                found = []

    def candidates(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The documents that still are in such pairs."""
        for x in _runs_of(batches):
            wanted = np.zeros(len(x), bool)
            for a, b in self.pairs(x):
                wanted[a] = wanted[b] = True
            if wanted.any():
                yield x.loc[wanted]

    def links(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links (a, b) between components by pairs that hold on the full sets, without those between components that
        other links of the task have joined."""
        for x in _runs_of(batches):
            roots, part, out = _Roots(), x["component"].tolist(), []
            sets = x["shingles"].to_numpy()
            for a, b in self.pairs(x):
                for i, j in zip(a.tolist(), b.tolist(), strict=True):
                    if roots.find(part[i]) != roots.find(part[j]):
                        both = _in_common(sets[i], sets[j])
                        if both * self.bottom >= self.top * (len(sets[i]) + len(sets[j]) - both):
                            roots.join(part[i], part[j])
                            out.append((part[i], part[j]))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def near_duplicate_groups(
    docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (4, 5), trees: int = 16
) -> DataFrame:
    """For each row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of word shingles have bottom * intersection >= top * union; component_id is the
    smallest doc_id that links lead to, and kept tells whether it is the document's own. Texts without words, null and
    empty ones included, have n_shingles 0, are linked with nothing and kept. Rows with a null doc_id are linked with nothing, their
    component_id is null, their n_shingles 0, and they are kept. Rows that repeat a doc_id are linked each by its own text.
    Columns besides doc_id and text are not read. An empty table gives no rows. A pair just at the similarity is not found with
    probability 2e-5.
    """
    with scratch(docs.sparkSession) as out:
        return out(_groups(docs, words, similarity, trees), "groups")


def _groups(docs: DataFrame, words: int, similarity: tuple[int, int], trees: int) -> DataFrame:
    top, bottom = similarity
    least, plausible = least_depth(top / bottom, trees), _plausible(top / bottom, trees)
    digest = frozen(digests(docs, words, trees), "digests")
    # One node for each set of shingles; copies are members of it and need no pairs.
    classes = digest.where("n_shingles > 0").groupBy("set_hi", "set_lo", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"))
    nodes = frozen(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    labels = None
    for _ in range(NEIGHBOUR_ROUNDS):
        rows = _orders(nodes, labels, trees, least)
        if labels is not None:
            rows = rows.join(_mixed(rows).select("region"), "region", "left_semi")
        near = _agreeing(_lcp_neighbours(rows, least), nodes, plausible)
        links = _confirmed(near, docs, nodes, words, similarity)
        if links.isEmpty():
            break
        labels = _joined_labels(labels, links)

    # Pairs that no neighbour has shown: first which documents are in one, by their signatures, then their full sets.
    search = _Search(trees, least, plausible, top, bottom)
    left = frozen(_mixed_blocks(nodes, labels, trees, least).mapInPandas(search.candidates, MEMBER), "left")
    if not left.isEmpty():
        sets = _shingles(left.select("node").distinct(), docs, nodes, words)
        rows = left.join(sets, "node").select(*left.columns, "shingles").repartition(*KEY).sortWithinPartitions(*KEY, "node")
        labels = _joined_labels(labels, frozen(rows.mapInPandas(search.links, "a long, b long").distinct(), "links"))

    named = _labelled(nodes, labels).select("set_hi", "set_lo", "n_shingles", "component", "doc_id")
    first = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.drop("doc_id").join(first, "component").drop("component")
    out = digest.join(named, ["set_hi", "set_lo", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = docs.where("doc_id IS NULL").select(
        F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id")
    )
    return out.unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op1_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"), words=3, similarity=(85, 100))


OP1_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s FROM split
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS total, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY 1, 2
), links AS (SELECT a, b FROM common WHERE 100 * shared >= 85 * (total - shared)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other
), least AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.other, s.doc_id)) AS component_id, s.doc_id <= coalesce(l.other, s.doc_id) AS kept
FROM sets s LEFT JOIN least l USING (doc_id)
"""

QUERIES = {"op1_minhash_neardup": op1_minhash_neardup}
ORACLES = {"op1_minhash_neardup": OP1_SQL}
