"""Benchmark decontamination by edit distance, through CGK embeddings and bit-sampling LSH.

Documents are searched for windows of the size of a benchmark item within `ratio` word edits of it. The CGK embedding
walks a window three times its length long, writes the current word at each step and moves on by a random bit of that word; it
turns edits into differing places. Sampled places of embeddings are looked up among those of the items, over several
walks and samples, and what meets an item there is verified by its exact edit distance. There are as many walks as a trial
needs to reach the target recall: items with all the edits that are allowed, at random, looked up like windows.

Windows are laid where they can succeed: n words within d edits of an item leave a run of (n - d) / (d + 1) of its
words untouched, so windows start only around the document's runs of that many words that occur in an item, where the
run lies in the item and shifted by up to d words. No passage within the distance is left without a window by this; whether
a window then meets its item in a sampled place is a matter of chance.

Words are what is left between white space and ASCII punctuation, with A-Z lower-cased.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import per_worker, table
from .words import WordHashes

RATIO = 0.2
RECALL = 0.999
MOST_WALKS, SAMPLES, PLACES = 24, 6, 2
TRIALS = 2000  # edited items that the number of walks is chosen by
ITEMS = 5000  # items of an index
MOST_ITEMS = 200_000  # items of a benchmark at most; their indexes go to every task (some 3 KB an item)
LONGEST_RUN = 4
FILTER_BITS = 22
_KEEP = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))
GAP = np.zeros(LONGEST_RUN + 1, np.uint64)


def words(text: str | None, cache: WordHashes) -> np.ndarray:
    found = (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).lower().split()
    return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))


def _runs(w: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each length up to the longest, hashes of the runs of words that start at each place."""
    mixed = np.zeros(len(w), np.uint64)
    for q in range(1, min(longest, len(w)) + 1):
        last = len(w) - q + 1
        mixed = (mixed[:last] ^ w[q - 1 : q - 1 + last]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        yield q, mixed


def edits_within(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """The least number of word edits between the item and any part of the region, and where the first such part ends."""
    places = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for word in item:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (region != word))
        row = np.minimum.accumulate(new - places) + places
    end = int(row.argmin())
    return int(row[end]), end


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """words with so many random edits (words dropped, put in or changed), and where the words begin that follow the middle
    one of the edits, against where they began."""
    out, shift, at_all = list(words), 0, np.sort(rng.integers(0, len(words), edits))
    seen = 0
    for number, at in enumerate(at_all.tolist()):
        how, new = int(rng.integers(3)), int(rng.integers(2**63))
        place = min(at + shift, len(out))
        out[place : place + (how != 1)] = [] if how == 0 else [new]
        shift += (how == 1) - (how == 0)
        seen = shift if number <= edits // 2 else seen
    return np.array(out, np.uint64), seen


class Index:
    """Benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], ratio: float = RATIO, recall: float = RECALL):
        cache, rng = WordHashes(), np.random.default_rng(29)
        self.items = [(item_id, w) for item_id, w in ((i, words(t, cache)) for i, t in items) if len(w)]
        self.edits = [int(ratio * len(w)) for _, w in self.items]
        self.run = [max(1, min(LONGEST_RUN, (len(w) - d) // (d + 1))) for (_, w), d in zip(self.items, self.edits, strict=True)]
        runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for number, ((_, w), q) in enumerate(zip(self.items, self.run, strict=True)):
            for length, hashes in _runs(w, q):
                if length == q:
                    runs[q] += [(int(h), number, at) for at, h in enumerate(hashes)]
        self.runs = {}
        for q, rows in runs.items():
            rows.sort()
            hashes = np.array([r[0] for r in rows], np.uint64)
            bloom = np.zeros(2**FILTER_BITS, bool)
            bloom[hashes >> np.uint64(64 - FILTER_BITS)] = True
            self.runs[q] = (bloom, hashes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        longest = 3 * max((len(w) for _, w in self.items), default=0)
        self.bits = rng.integers(0, 2**63, (MOST_WALKS, longest), np.uint64) * np.uint64(2) + np.uint64(1)
        self.places = rng.random((MOST_WALKS, SAMPLES, PLACES))
        walks = self._walks_for(recall)
        self.bits, self.places = self.bits[:walks], self.places[:walks]
        keys: list[tuple[int, int]] = []
        by_size: dict[int, list[int]] = defaultdict(list)
        for number, (_, w) in enumerate(self.items):
            by_size[len(w)].append(number)
        for numbers in by_size.values():
            found = self.keys(np.array([self.items[i][1] for i in numbers]))
            keys += [(int(k), i) for row, i in zip(found, numbers, strict=True) for k in row]
        keys.sort()
        self.key, self.key_item = np.array([k for k, _ in keys], np.uint64), np.array([i for _, i in keys], np.int64)

    def _walks_for(self, recall: float) -> int:
        """How many walks find this share of edited items in a window laid by one of their untouched runs."""
        rng = np.random.default_rng(37)
        able = [number for number, d in enumerate(self.edits) if d]
        trials: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for number in rng.choice(able, TRIALS).tolist() if able else []:
            w, d = self.items[number][1], self.edits[number]
            text, shift = edited(w, d, rng)
            wide = np.concatenate([rng.integers(0, 2**63, 2 * d, np.uint64), text, rng.integers(0, 2**63, len(w), np.uint64)])
            trials[len(w)] += [(number, wide[2 * d + at : 2 * d + at + len(w)]) for at in (0, shift)]
        met = []
        for rows in trials.values():
            same = self.keys(np.array([x for _, x in rows])) == self.keys(np.array([self.items[number][1] for number, _ in rows]))
            same = same.reshape(-1, 2, MOST_WALKS, SAMPLES).any(axis=(1, 3))
            met.append(np.logical_or.accumulate(same, axis=1))
        if not met:
            return 1
        walks = int(np.searchsorted(np.concatenate(met).mean(axis=0), recall)) + 1
        if walks > MOST_WALKS:
            raise ValueError(f"{MOST_WALKS} walks find less than {recall} of edited items")
        return walks

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """The keys of windows of one size (a row each): walks x SAMPLES columns."""
        (count, n), walks = windows.shape, len(self.bits)
        padded = np.hstack([windows, np.full((count, 1), 0x5851F42D4C957F2D, np.uint64)]).ravel()
        first, at = np.arange(count) * (n + 1), np.zeros((walks, count), np.int64)
        places, seen = (self.places * 3 * n).astype(int), {}
        wanted = set(places.ravel().tolist())
        for j in range(max(wanted) + 1):  # all walks take a step
            word = padded[first + at]
            if j in wanted:
                seen[j] = word
            at += (word * self.bits[:, j : j + 1] >> np.uint64(63)).view(np.int64)
            np.minimum(at, n, out=at)
        out = np.empty((count, walks * SAMPLES), np.uint64)
        for walk in range(walks):
            for s in range(SAMPLES):
                key = np.full(count, ((n * MOST_WALKS + walk) * SAMPLES + s + 1) * 0xD6E8FEB86659FD93 % 2**64, np.uint64)
                for j in places[walk, s]:
                    key = (key ^ seen[int(j)][walk]) * np.uint64(0xBF58476D1CE4E5B9)
                    key ^= key >> np.uint64(31)
                out[:, walk * SAMPLES + s] = key
        return out

    def find(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, edits) for each text and item within the item's edits: the best place."""
        joined = np.concatenate([GAP, *(x for t in texts for x in (t, GAP))])
        starts = np.cumsum([len(GAP), *(len(t) + len(GAP) for t in texts)])
        laid: dict[int, set[int]] = defaultdict(set)
        for q, hashes in _runs(joined, max(self.runs, default=0)):
            if q not in self.runs:
                continue
            bloom, known, item, offset = self.runs[q]
            at = np.flatnonzero(bloom[hashes >> np.uint64(64 - FILTER_BITS)])
            low, high = np.searchsorted(known, hashes[at], "left"), np.searchsorted(known, hashes[at], "right")
            for place, a, b in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist(), strict=True):
                for number, within in zip(item[a:b].tolist(), offset[a:b].tolist(), strict=True):
                    d = self.edits[number]
                    step = max(1, d // 2)
                    # Edits before the run shift the window; shifts are rounded, so that the runs of one occurrence share them.
                    laid[len(self.items[number][1])].add(place - within)
                    laid[len(self.items[number][1])].update(range((place - within - d) // step * step, place - within + d + 1, step))
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        for n, places in laid.items():
            first = np.array(sorted(places))
            first = first[(first > -n) & (first < len(joined))]
            for part in np.array_split(first, max(1, len(first) // 4096)):
                reach = np.clip(part[:, None] + np.arange(n), 0, len(joined) - 1)
                keys = self.keys(joined[reach])
                low, high = np.searchsorted(self.key, keys, "left"), np.searchsorted(self.key, keys, "right")
                for row, column in zip(*np.nonzero(low < high), strict=True):
                    middle = int(part[row]) + n // 2
                    text = int(np.searchsorted(starts, middle, "right")) - 1
                    for number in self.key_item[low[row, column] : high[row, column]].tolist():
                        for t in {max(text - 1, 0), min(max(text, 0), len(texts) - 1), min(text + 1, len(texts) - 1)}:
                            if starts[t] - n < part[row] < starts[t] + len(texts[t]):
                                found[t, number].append(int(part[row]) - int(starts[t]))
        out = []
        for (t, number), places in found.items():
            w, d = self.items[number][1], self.edits[number]
            best, places = None, sorted(set(places))
            while places:  # windows that touch are one region
                a = b = places.pop(0)
                while places and places[0] <= b + len(w):
                    b = places.pop(0)
                a, b = max(0, a - 2 * d), min(len(texts[t]), b + len(w) + 2 * d)
                region = texts[t][a:b]
                if len(w) - np.count_nonzero((w[:, None] == region).any(axis=1)) > d:
                    continue  # each word that the region lacks is an edit
                edits, end = edits_within(w, region)
                if edits <= d and (best is None or edits < best[0]):
                    back, length = edits_within(w[::-1], region[:end][::-1])
                    best = (edits, a + end - length, length)
            if best:
                out.append((t, number, best[1], best[2], best[0]))
        return out


def indexes(benchmark: DataFrame, ratio: float = RATIO, recall: float = RECALL) -> list[Index]:
    """Indexes of ITEMS items at most, which together hold the benchmark (item_id, text). A benchmark is a small table: with
    more than MOST_ITEMS items it is refused, before any is read."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    if rows.count() > MOST_ITEMS:
        raise ValueError(f"the benchmark has more than {MOST_ITEMS} items; search it in parts")
    items = sorted((r["item_id"], r["text"]) for r in rows.toLocalIterator())
    return [Index(items[at : at + ITEMS], ratio, recall) for at in range(0, len(items), ITEMS)]


def _grouped(texts: pd.Series, cache: WordHashes) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Texts as words, some 400,000 words at a time, with the place of the first."""
    at, group, size = 0, [], 0
    for i, text in enumerate(texts):
        group.append(words(text, cache))
        size += len(group[-1])
        if size >= 400_000 or i == len(texts) - 1:
            yield at, group
            at, group, size = i + 1, [], 0


def find_leaks(docs: DataFrame, benchmark: DataFrame, ratio: float = RATIO, recall: float = RECALL) -> DataFrame:
    """doc_id, item_id, first_word, n_words, edits, similarity: for every document (doc_id, text) and benchmark item
    (item_id, text) the document's part that is nearest to the item, if it is within int(ratio * words of the item) word
    edits; of equally near parts the first. similarity is 1 - edits / words of the item. What is reported is exact; of passages
    with as many edits as are allowed about the share `recall` is found, and more of nearer ones.

    Null and empty texts and items match nothing. Rows with a null or repeated doc_id are searched like others; items of
    equal text are each reported. Texts are searched whole, in one pass. Empty tables give no rows. Other columns are not read.
    """
    schema = "doc_id long, item_id long, first_word long, n_words long, edits int, similarity double"
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text IS NOT NULL")
    parts = indexes(benchmark, ratio, recall)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = per_worker((WordHashes.__name__,), WordHashes)
        for batch in batches:
            ids, rows = batch["doc_id"].astype("Int64").tolist(), []
            for at, group in _grouped(batch["text"], cache):
                for index in parts:
                    for t, number, first, count, edits in index.find(group):
                        item_id, w = index.items[number]
                        rows.append((ids[at + t], item_id, first, count, edits, 1 - edits / len(w)))
            found = pd.DataFrame(rows, columns=["doc_id", "item_id", "first_word", "n_words", "edits", "similarity"])
            yield found.astype({"doc_id": "Int64", "item_id": "int64", "first_word": "int64", "n_words": "int64", "edits": "int32", "similarity": "float64"})

    return slim.mapInPandas(run, schema)


def leaks(text: Column, benchmark: DataFrame, ratio: float = RATIO, recall: float = RECALL) -> Column:
    """Whether a text holds a part within the edits of any item; false for a null or empty text and for an empty benchmark."""
    parts = indexes(benchmark, ratio, recall)

    @F.pandas_udf("boolean")
    def found(texts: pd.Series) -> pd.Series:
        cache, out = per_worker((WordHashes.__name__,), WordHashes), np.zeros(len(texts), bool)
        for at, group in _grouped(texts, cache):
            for index in parts:
                for t, *_ in index.find(group):
                    out[at + t] = True
        return pd.Series(out)

    return found(text)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op9_decontamination": op9_decontamination}
ORACLES: dict[str, str] = {}
