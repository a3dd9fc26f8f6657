"""Lexical retrieval packing.

Documents are cut into windows as far as they fill them; what is left of each is packed. The rests are sorted by what they
are about: each is known by its terms of high weight, in one random order of all terms, and the lists of these are sorted
over all tasks by range, equal ones by a salt. Two documents begin alike with the chance of the overlap of their terms
(MinHash), however many others there are. A rest that begins unlike both its neighbours goes on to the next random order, where it and the
others that have found nothing are sorted anew; the last order keeps all. Shards are cut from these orders, so that a first term that
too many share is split by the next ones. Each shard builds a BM25 inverted index over its rests, with
document frequencies counted over all documents. A seed opens a window; the index returns its unused neighbours in order of their scores, and
those that fit fill the window greedily. What no whole neighbour fills is filled by the first part of the best
neighbour left; its other part is the next seed. So every window is full but for a shard's last tokens, which go
into sequences whose lengths are powers of two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from copy import copy
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget_in_worker, frozen, per_worker, scratch, table
from .tokens import WordTokenizer, places, strings

KEY_SHARE = 0.5  # a document is dealt by the terms that have this share of its highest weight
SHARD_BITS, PART_BITS = 13, 15  # a task numbers its shards with so many bits, and an order its tasks
COMMON = 16  # a term that more than a sixteenth of a shard's documents have is common
K1, B = 1.2, 0.75
CLOSE = 0.5  # a text of so much of another's own score is close to it
FULL = 2**62  # sequence ids of windows that a document fills alone begin here
GATHERED = 14_000_000  # bytes of texts that are tokenized at once
TOKENIZED = ["doc_id", "start", "doc_tokens", "sequence_id", "ids", "rest"]
COLUMNS = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """The rows, in batches of at least so many bytes but for the last."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def tokenized(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """Of each document a row for each window that it fills alone, with ids (unsigned 32 bits) and a sequence_id, and one for what is left,
    if anything is, with rest (unsigned 16 bits). start is 0 in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = per_worker((WordTokenizer.__name__, path), lambda: WordTokenizer(path))
        part, number = TaskContext.get().partitionId(), 0
        for some in gathered(batches, GATHERED):
            doc_id, text = (pa.concat_arrays(some[c].chunks) for c in ("doc_id", "text"))
            at, ids = places(tokenizer.encode(text.fill_null("")))
            counts = np.diff(at).astype(np.int64) // 2 + 1
            last = np.zeros(counts.sum(), bool)
            last[np.cumsum(counts) - 1] = True
            flat = np.full(len(last), end_id, "<u2")
            flat[~last] = ids.view("<u2")
            fills, rests = counts // window, counts % window
            alone = np.repeat(np.tile([True, False], len(counts)), np.stack([fills * window, rests], axis=1).ravel())
            of, full = np.repeat(np.arange(len(counts)), fills), flat[alone]
            start = (np.arange(len(of)) - (np.cumsum(fills) - fills)[of]) * window
            for i in range(0, len(of), 500):
                own = full[i * window : (i + 500) * window].astype("<u4").view(np.uint8)
                x, n = of[i : i + 500], len(own) // (4 * window)
                wide = strings(pa.binary(), np.arange(1, n + 1) * 4 * window, own)
                sequence = FULL + (part << 36) + number + np.arange(n)
                yield pa.RecordBatch.from_arrays([doc_id.take(pa.array(x)), pa.array(start[i : i + 500]), pa.array(counts[x]), pa.array(sequence), wide, pa.nulls(n, pa.binary())], TOKENIZED)
                number += n
            x = np.flatnonzero(rests)
            rest = strings(pa.binary(), np.cumsum(2 * rests[x]), flat[~alone].view(np.uint8))
            none = [pa.nulls(len(x), kind) for kind in (pa.int64(), pa.binary())]
            left = pa.RecordBatch.from_arrays([doc_id.take(pa.array(x)), pa.array((fills * window)[x]), pa.array(counts[x]), *none, rest], TOKENIZED)
            for i in range(0, len(x), 2000):
                yield left.slice(i, 2000)

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, start long, doc_tokens long, sequence_id long, ids binary, rest binary")


def _frequencies(rests: DataFrame) -> dict[int, int]:
    """In how many rests each id occurs; no longer than the vocabulary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_in_worker()  # the tokenizer and its words
        counts = np.zeros(2**16, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 500):
                _, terms, _ = _counted([np.frombuffer(x, "<u2") for x in batch["rest"].iloc[at : at + 500]])
                counts += np.bincount(terms, minlength=2**16)
        seen = np.flatnonzero(counts)
        yield pd.DataFrame({"term": seen, "n": counts[seen]})

    rows = rests.select("rest").mapInPandas(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {r["term"]: r["n"] for r in rows}


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and how often each occurs."""
    ids = np.sort(ids, kind="stable" if ids.itemsize == 2 else None)  # by digits, which is fast for short numbers
    starts = np.flatnonzero(np.concatenate([ids[:1] == ids[:1], ids[1:] != ids[:-1]]))
    return ids[starts], np.diff(starts, append=len(ids))


def _counted(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, term, times) for the distinct terms of each of these lists of ids, in this order."""
    of = np.repeat(np.arange(len(texts), dtype=np.int64) << 16, [len(t) for t in texts])
    pairs, times = _distinct(of | np.concatenate([*texts, np.zeros(0, np.uint16)]))
    return pairs >> 16, pairs & 0xFFFF, times


def _keys(texts: list[np.ndarray], places: list[np.ndarray], idf: np.ndarray, mean_length: float, key_terms: int) -> list[list[bytes]]:
    """For each order of the terms (places), of each list, none empty, the first places of its terms of high BM25 weight; key_terms at
    most."""
    of, terms, times = _counted(texts)
    weight = _weights(idf[terms], times, np.array([len(t) for t in texts])[of], mean_length)
    starts = np.searchsorted(of, np.arange(len(texts)))
    high = weight >= KEY_SHARE * np.maximum.reduceat(weight, starts)[of]
    of, terms = of[high], terms[high]
    starts, out = np.searchsorted(of, np.arange(len(texts) + 1)).tolist(), []
    for place in places:
        own = (np.sort(of << 16 | place[terms]) & 0xFFFF).astype(">u2")
        out.append([own[a : min(b, a + key_terms)].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)])
    return out


def _keyed(rests: DataFrame, idf: np.ndarray, mean_length: float, orders: int, key_terms: int) -> DataFrame:
    """The rests with a key for each order."""
    # The table is frozen, so that its row numbers are, too.
    row = F.monotonically_increasing_id()
    numbered = rests.select("doc_id", "doc_tokens", "rest", F.xxhash64(row).alias("salt"), row.alias("row"))
    orders_of = [np.random.default_rng(31 + i).permutation(2**16) for i in range(orders)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_in_worker()
        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch.iloc[at : at + 500]
                keys = _keys([np.frombuffer(x, "<u2") for x in some["rest"]], orders_of, idf, mean_length, key_terms)
                out = some[["doc_id", "doc_tokens", "salt", "row"]].astype({"doc_id": "Int64"})
                yield out.assign(**{f"key_{i}": k for i, k in enumerate(keys)}, rest=some["rest"])

    keys = ", ".join(f"key_{i} binary" for i in range(orders))
    return numbered.mapInPandas(run, f"doc_id long, doc_tokens long, salt long, row long, {keys}, rest binary")


def alike(a: bytes, b: bytes, least: int) -> bool:
    """Whether two keys begin with the same `least` terms, or are equal."""
    return a == b or (len(a) >= 2 * least and a[: 2 * least] == b[: 2 * least])


def told_apart(batches: Iterator[pd.DataFrame], key: str, least: int) -> Iterator[pd.DataFrame]:
    """The rows in order, with near: whether the one before or after begins alike. A task's first and last rows have one neighbour."""
    held, before = None, False
    for batch in chain(batches, [None]):
        x = held if batch is None else batch if held is None else pd.concat([held, batch], ignore_index=True)
        if x is None or not len(x):
            continue
        keys = x[key].tolist()
        after = [alike(a, b, least) for a, b in zip(keys, keys[1:], strict=False)] + [False]
        done = len(x) if batch is None else len(x) - 1
        near = np.array([p or n for p, n in zip([before, *after], after, strict=False)], bool)
        yield x.iloc[:done].assign(near=near[:done])
        before, held = after[done - 1] if done else before, x.iloc[done:]


def _weights(idf: np.ndarray, tf: np.ndarray, sizes: np.ndarray | int, mean_length: float) -> np.ndarray:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes / mean_length))


class Bm25:
    """An inverted index over lists of ids. Terms that many lists have are kept as rows of weights for all lists, others as
    postings."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n, sizes = len(texts), np.array([len(t) for t in texts])
        terms = np.concatenate([*texts, np.zeros(0, np.uint16)]).astype(np.int64)
        pairs, tf = _distinct(terms * self.n + np.repeat(np.arange(self.n), sizes))
        term, doc = pairs // max(self.n, 1), pairs % max(self.n, 1)
        weight = _weights(idf[term], tf, sizes[doc], mean_length)
        common = np.flatnonzero(np.bincount(term, minlength=len(idf)) > max(8, self.n // COMMON))
        self.row = np.full(len(idf), -1)
        self.row[common] = np.arange(len(common))
        self.rows, of = np.zeros((len(common), self.n), np.float32), self.row[term]
        self.rows[of[of >= 0], doc[of >= 0]] = weight[of >= 0]
        self.term, self.doc, self.weight = term[of < 0], doc[of < 0], weight[of < 0]
        self.starts = np.searchsorted(self.term, np.arange(len(idf) + 1))
        self.kept = np.arange(self.n)  # numbers of the lists that take part

    def own(self) -> np.ndarray:
        """The score of each list by all of its own terms."""
        return np.bincount(self.doc, self.weight, self.n) + self.rows.sum(axis=0)

    def by_common(self) -> np.ndarray:
        """Of each list (row) the part of the scores of all lists that common terms give."""
        return (self.rows > 0).astype(np.float32).T @ self.rows

    def scores(self, ids: np.ndarray, common: np.ndarray | None = None) -> np.ndarray:
        """Of each list, by all terms of ids. common: the part of common terms, if it is known."""
        terms = _distinct(ids)[0]
        of = self.row[terms]
        terms, of = terms[of < 0].astype(np.int64), of[of >= 0]
        first, count = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        found = np.bincount(self.doc[at], self.weight[at], len(self.kept))
        out = np.zeros(self.n)
        out[self.kept] = found + (np.ones(len(of), np.float32) @ self.rows[of] if common is None else common[self.kept])
        return out

    def without(self, used: np.ndarray) -> Bm25:
        """The index without the lists that are used; the others keep their numbers and scores."""
        out, keep = copy(self), ~used[self.kept]
        at, number = keep[self.doc], np.cumsum(keep) - 1
        out.term, out.doc, out.weight = self.term[at], number[self.doc[at]], self.weight[at]
        out.rows, out.kept = self.rows[:, keep], self.kept[keep]
        out.starts = np.searchsorted(out.term, np.arange(len(self.starts)))
        return out


def fill_windows(texts: list[np.ndarray], index: Bm25, window: int, twins: np.ndarray | None = None) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (text, from, to). Each is full but for those at the end, of lengths that are powers of two.

    twins: the texts that something like them lies beside. Such a text, when it fills a window whose seed it is not close to, is asked
    for its own neighbours, which then come first; so it does not part from them."""
    sizes = np.array([len(t) for t in texts], np.int64)
    used, out = sizes == 0, []
    order, at, common = iter(np.argsort(-sizes, kind="stable").tolist()), None, index.by_common()
    indexed, whole = len(used), index.own()
    while True:
        if (~used).sum() < 0.7 * indexed:
            index, indexed = index.without(used), int((~used).sum())
        if at is None:
            seed = next((i for i in order if not used[i]), None)
            if seed is None:
                return out
            at, used[seed] = (seed, 0), True
        pieces, room = [(at[0], at[1], int(sizes[at[0]]))], window - int(sizes[at[0]]) + at[1]
        score, at = index.scores(texts[at[0]], common[at[0]]), None
        free = np.flatnonzero(~used)
        near = free[np.argsort(-score[free], kind="stable")]
        fits, own = near, sizes[near]
        while room and len(fits := fits[own <= room]):
            own, i = sizes[fits], int(fits[0])
            pieces.append((i, 0, int(own[0])))
            room -= int(own[0])
            used[i] = True
            fits, own = fits[1:], own[1:]
            if room and twins is not None and twins[i] and score[i] < CLOSE * whole[i]:
                score = index.scores(texts[i], common[i])
                close = score >= CLOSE * np.minimum(whole[i], whole)
                near = near[~used[near]]
                first = near[close[near]]
                near = np.concatenate([first[np.argsort(-score[first], kind="stable")], near[~close[near]]])
                fits, own = near, sizes[near]
        if room and not used.all():
            best = next(i for i in near.tolist() if not used[i])
            pieces.append((best, 0, room))
            used[best], at, room = True, (best, room), 0
        if not room:
            out.append(pieces)
            continue
        for power in range(window.bit_length() - 1, -1, -1):
            if (window - room) >> power & 1:
                left, part = 2**power, []
                while left:
                    i, a, b = pieces[0]
                    cut = min(b, a + left)
                    part.append((i, a, cut))
                    left -= cut - a
                    pieces = pieces[1:] if cut == b else [(i, cut, b), *pieces[1:]]
                out.append(part)


def retrieval_packing(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, shard: int = 2000, orders: int = 3, key_terms: int = 8, least: int = 2) -> DataFrame:
    """Packs all rows of docs (doc_id, text) into sequences of at most `window` tokens, a power of two. A row for each
    piece: doc_id, start (ids of its document before it), length, doc_tokens, sequence_id, offset (in the sequence),
    ids (unsigned 32 bits, little-endian).

    A document is its ids and then end_id; null and empty texts are end_id alone. Each id lies in exactly one piece.
    Rows with a null or repeated doc_id are documents of their own. Other columns are not read. Every sequence is full or
    has a power of two as its length, so that none needs padding. An empty table gives no rows.

    A seed finds neighbours among the `shard` rests around it in one of `orders` orders; in all but the last it stays only beside a rest that
    begins with the same `least` of up to key_terms terms.
    """
    if not 1 <= orders <= 4:
        raise ValueError("orders must lie between 1 and 4")
    with scratch(docs.sparkSession) as out:
        return _packed(out(tokenized(docs, tokenizer_path, window, end_id), "tokens"), out, window, shard, orders, key_terms, least)


def _packed(tokens: DataFrame, kept: Callable[[DataFrame, str], DataFrame], window: int, shard: int, orders: int, key_terms: int, least: int) -> DataFrame:
    n, left = tokens.where("start = 0").agg(F.count("*"), F.sum(F.col("doc_tokens") % window)).first()
    rests = tokens.where("rest IS NOT NULL")
    counts = _frequencies(rests)
    mean_length = max(1.0, (left or 0) / max(n, 1))
    idf = np.zeros(2**16)
    for term, df in counts.items():
        idf[term] = np.log1p((n - df + 0.5) / (df + 0.5))

    def packed(order: int):
        """The sequences of a task, shard by shard; and what goes on to the next order, without a sequence."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            forget_in_worker()
            part, number, rest = TaskContext.get().partitionId(), 0, None
            if part >= 2**PART_BITS:
                raise ValueError(f"more than {2**PART_BITS} tasks")
            for batch in chain(told_apart(batches, f"key_{order}", least), [None]):
                if batch is not None and order < orders - 1:
                    left, batch = batch[~batch["near"]], batch[batch["near"]]
                    none = pd.Series(None, index=left.index, dtype="Int64")
                    out = left.assign(start=none, length=none, sequence_id=none, offset=none, ids=left["rest"])
                    yield out.astype({"doc_id": "Int64"})[[*COLUMNS, *later]]
                rest = batch if rest is None else rest if batch is None else pd.concat([rest, batch], ignore_index=True)
                while rest is not None and len(rest) and (batch is None or len(rest) >= shard):
                    if number >= 2**SHARD_BITS:
                        raise ValueError(f"a task has more than {2**SHARD_BITS} shards: raise spark.sql.shuffle.partitions")
                    own = pack(rest.iloc[:shard], ((order << PART_BITS | part) << SHARD_BITS | number) << 32)
                    yield own.assign(**{c: pd.Series(None, index=own.index, dtype="Int64" if c in ("salt", "row") else object) for c in later})
                    rest, number = rest.iloc[shard:], number + 1

        return run

    def pack(x: pd.DataFrame, base: int) -> pd.DataFrame:
        texts = [np.frombuffer(r, "<u2") for r in x["rest"]]
        ids, total = x["doc_id"].astype("Int64").tolist(), x["doc_tokens"].tolist()
        rows = []
        for number, pieces in enumerate(fill_windows(texts, Bm25(texts, idf, mean_length), window, x["near"].to_numpy(bool))):
            offset = 0
            for i, a, b in pieces:
                own = texts[i][a:b].astype("<u4").tobytes()
                rows.append((ids[i], total[i] // window * window + a, b - a, total[i], base + number, offset, own))
                offset += b - a
        return pd.DataFrame(rows, columns=COLUMNS).astype({"doc_id": "Int64"})

    full = tokens.where("sequence_id IS NOT NULL").withColumns({"length": F.lit(window).cast("bigint"), "offset": F.lit(0).cast("bigint")}).select(COLUMNS)
    shared = idf.copy()  # a term of one document alone brings it near to no other
    shared[[term for term, df in counts.items() if df < 2]] = 0
    out, rows = full, (frozen if orders > 1 else kept)(_keyed(rests, shared, mean_length, orders, key_terms), "keyed")
    for order in range(orders):
        later = ["salt", "row", *(f"key_{i}" for i in range(order + 1, orders))]
        schema = ", ".join([PIECES, "salt long, row long", *(f"{c} binary" for c in later[2:])])
        by = [f"key_{order}", "salt", "row"]
        dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInPandas(packed(order), schema)
        if order < orders - 1:
            dealt = kept(dealt, "packed")
            rows = dealt.where("sequence_id IS NULL").withColumnRenamed("ids", "rest").select("doc_id", "doc_tokens", *later, "rest")
        out = out.unionByName(dealt.where("sequence_id IS NOT NULL").select(*COLUMNS))
    return out


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_digest(retrieval_packing(table(spark, sf_dir, "documents"), tokenizer_path(), 2048, 1))


QUERIES = {"op8_packing": op8_packing}
ORACLES: dict[str, str] = {}
