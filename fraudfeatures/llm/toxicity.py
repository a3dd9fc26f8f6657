"""Toxicity by a support vector machine on a gapped subsequence kernel, with Nyström landmarks.

Two strings are alike by the subsequences of four characters that they share, where a subsequence may leave characters
out: each counts LAMBDA to the power of the characters left out, over both strings. Inserted and dropped characters so
cost a part of the likeness, and spaced-out letters nothing, because runs of single letters are read as one word.
The machine works on the kernel's values with landmark strings, made orthonormal (Nyström). As its decision is a weighted sum
of kernel values, it is a weight for each subsequence; texts are scored by looking these up, position by position.

Labels are given for documents, but a few words make a document toxic. So the words of labelled documents' sentences are the
instances, not whole sentences: those of clean documents are negative, and of each toxic document the words that stand out
are positive; these are chosen anew after each of a few rounds. A document's score is that of its worst word, calibrated.
Digits and signs that stand for letters, spaced letters and marks within words are read as letters before the kernel sees
them; inserted, dropped and changed letters are left to the kernel.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import is_held_out, sampled, table
from .linear import fit_logistic, fit_svm, sigmoid

LENGTH, SPAN, LAMBDA = 4, 6, 0.6
PATTERNS = [(0, *rest) for rest in combinations(range(1, SPAN), LENGTH - 1)]
DECAY = np.array([LAMBDA ** (p[-1] + 1 - LENGTH) for p in PATTERNS], np.float32)
BOUNDARY, MARK, DROPPED = 0, 254, 255
REACH = sorted({p[-1] for p in PATTERNS})


def _classes() -> np.ndarray:
    """Classes of bytes: letters, with digits and signs that stand for one, accented letters by their last byte, one class
    for white space and one for other marks."""
    out = np.full(256, MARK, np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = BOUNDARY
    out[ord("a") : ord("z") + 1] = np.arange(1, 27)
    for sign, letter in zip("013457@$", "oieastas", strict=True):
        out[ord(sign)] = ord(letter) - ord("a") + 1
    out[0x80:0xC0] = 27 + np.arange(64) % 5
    out[0xC0:] = DROPPED
    return out


CLASSES = _classes()


def stream(text: str | None) -> np.ndarray:
    """The classes of a text, with one boundary between words and at both ends. Marks inside a word are left out and
    others separate; runs of single letters are joined."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    c = np.concatenate([[BOUNDARY], CLASSES[raw], [BOUNDARY]]).astype(np.uint8)
    c = c[c != DROPPED]
    marks = c == MARK
    if marks.any():
        at = np.arange(len(c))
        before = c[np.maximum.accumulate(np.where(marks, 0, at))]
        after = c[np.minimum.accumulate(np.where(marks, len(c) - 1, at)[::-1])[::-1]]
        inner = marks & (before != BOUNDARY) & (after != BOUNDARY)
        c[marks] = BOUNDARY
        c = c[~inner]
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
    if len(c) >= 5:
        alone = np.zeros(len(c), bool)
        alone[1:-1] = (c[1:-1] != 0) & (c[:-2] == 0) & (c[2:] == 0)
        between = np.zeros(len(c), bool)
        between[1:-1] = (c[1:-1] == 0) & alone[:-2] & alone[2:]
        c = c[~between]
    return c


def words_of(c: np.ndarray) -> list[bytes]:
    """The words of a stream, each with a boundary on either side."""
    return [b"\0" + w + b"\0" for w in c.tobytes().split(b"\0") if w]


def bytes_of(word: bytes) -> str:
    """A word of a stream as letters; other classes as `?`."""
    return "".join(chr(96 + c) if 1 <= c <= 26 else "?" for c in word if c)


def word_norm(length: np.ndarray) -> np.ndarray:
    """About the length of a word's own vector of subsequences, by its length with boundaries."""
    places = np.maximum(0, np.asarray(length)[:, None] - np.array([p[-1] for p in PATTERNS]))
    return np.sqrt(np.maximum(1.0, places @ (DECAY**2).astype(float)))


def beginnings(word: bytes) -> list[bytes]:
    """The word with its boundaries, and its first four to seven characters with the boundary before."""
    return [word, *(word[: 1 + n] for n in range(4, min(7, len(word) - 3) + 1))]


def subsequences(c: np.ndarray) -> list[np.ndarray]:
    """For each pattern the codes of the subsequences that start at each place."""
    wide = np.concatenate([c, np.zeros(SPAN - 1, np.uint8)]).astype(np.int32)
    n, out = len(c), []
    for p in PATTERNS:
        code = wide[:n].copy()
        for i in p[1:]:
            code <<= 5
            code |= wide[i : i + n]
        out.append(code)
    return out


@dataclass
class Machine:
    """weight: of each subsequence code; bias; slope and shift of the calibration of a document's worst word; landmarks and their
    coefficients in the decision, which the weights add up."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float
    landmarks: list[bytes]
    coefficients: np.ndarray

    def words(self, words: list[bytes]) -> np.ndarray:
        """The decision value of each of these words, which have a boundary on either side."""
        return self.each(np.frombuffer(b"".join(w[:-1] for w in words) + b"\0", np.uint8))

    def each(self, c: np.ndarray) -> np.ndarray:
        """The decision value of each word of a stream; of one without words, the bias."""
        words = np.flatnonzero(c[:-1] == 0)
        if len(c) < 3:
            return np.array([self.bias])
        ends = np.concatenate([words[1:], [len(c) - 1]])
        left = np.repeat(ends, ends - words) - np.arange(len(c) - 1)
        value, codes = np.zeros(len(c) - 1, np.float32), subsequences(c)
        for reach in REACH:  # a word's subsequences end within it
            part = np.zeros(len(c) - 1, np.float32)
            for p, decay, code in zip(PATTERNS, DECAY, codes, strict=True):
                if p[-1] == reach:
                    part += decay * self.weight[code[:-1]]
            value += part * (left >= reach)
        return np.add.reduceat(value, words) / word_norm(ends - words + 1) + self.bias

    def worst_of(self, c: np.ndarray) -> float:
        return float(self.each(c).max())

    def score(self, worst: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * worst + self.shift)


def _kernel(words: list[bytes], landmarks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kernel values of words with landmarks, each landmark of length one; the landmarks' codes, and their weights."""
    codes: dict[int, int] = {}
    rows = []
    for j, mark in enumerate(landmarks):
        found: Counter[int] = Counter()
        for p, decay, code in zip(PATTERNS, DECAY, subsequences(np.frombuffer(mark, np.uint8)), strict=True):
            for x in code[: max(0, len(mark) - p[-1])].tolist():
                found[x] += float(decay)
        norm = np.sqrt(sum(v * v for v in found.values()))
        rows += [(codes.setdefault(x, len(codes)), j, v / norm) for x, v in found.items()]
    by_code = np.zeros((len(codes) + 1, len(landmarks)))
    for i, j, v in rows:
        by_code[i, j] = v
    place = np.full(2 ** (5 * LENGTH), len(codes), np.int32)
    place[np.fromiter(codes, np.int64, len(codes))] = np.arange(len(codes))
    out = np.zeros((len(words), len(landmarks)))
    for at in range(0, len(words), 1000):
        part = words[at : at + 1000]
        sizes = np.array([len(w) + SPAN for w in part])
        joined = np.frombuffer(b"".join(w + b"\0" * SPAN for w in part), np.uint8)
        of, held = np.repeat(np.arange(len(part)), sizes), np.zeros(len(part) * len(by_code))
        left = np.repeat(np.cumsum(sizes) - SPAN, sizes) - np.arange(len(joined))
        for p, decay, code in zip(PATTERNS, DECAY, subsequences(joined), strict=True):
            inside = left > p[-1]  # a word's subsequences end within it
            held += decay * np.bincount(of[inside] * len(by_code) + place[code[inside]], minlength=len(held))
        held = held.reshape(len(part), -1)
        out[at : at + 1000] = held[:, :-1] @ by_code[:-1] / word_norm(sizes - SPAN)[:, None]
    return out, np.fromiter(codes, np.int64, len(codes)), by_code[:-1]


def train(
    documents: list[tuple[int, list[bytes]]], share: float | None = None, landmarks: int = 96, negatives: int = 8_000, rounds: int = 3
) -> Machine | None:
    """A machine from (toxic, distinct words) of documents; None unless both labels occur. share: of toxic ones among all
    documents, if not that among these."""
    toxic, clean = [w for t, w in documents if t and w], [w for t, w in documents if not t and w]
    if not toxic or not clean:
        return None
    in_toxic, in_clean = (Counter(x for words in group for x in {p for w in words for p in beginnings(w)}) for group in (toxic, clean))
    odds = {
        w: np.log((n + 0.1) / (len(toxic) + 0.2)) - np.log((in_clean[w] + 0.1) / (len(clean) + 0.2)) for w, n in in_toxic.items()
    }
    force = {w: max(0.0, o) * np.sqrt(in_toxic[w]) for w, o in odds.items()}
    power = {w: max(force[p] for p in beginnings(w)) for w in {w for words in toxic for w in words}}
    # Of beginnings that continue one another, the strongest.
    marks, taken = [], set()
    for w in sorted(force, key=lambda w: (-force[w], -len(w), w)):
        heads = {w[:n] for n in range(5, len(w) + 1)} | {w.rstrip(b"\0")}
        if len(marks) >= landmarks * 2 // 3 or force[w] <= 0:
            break
        if w not in taken and not heads & set(marks):
            marks.append(w)
            taken |= heads
    usual = sorted((w for w in in_clean if len(w) > 5 and w[-1] == 0), key=lambda w: (-in_clean[w], w))
    marks += [w for w in usual[: 4 * landmarks] if w not in marks][: landmarks - len(marks)]
    if not marks:
        return None

    # Nyström: kernel values with the landmarks times the inverse square root of the landmarks' own kernel.
    own, codes, by_code = _kernel(marks, marks)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    keep = values > values.max() * 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    bad = sorted((w for w in in_clean if w[-1] == 0), key=lambda w: (-in_clean[w], w))
    used = bad[:2000] + bad[2000 :: max(1, len(bad) // negatives)]
    candidates = []
    for words in toxic:
        top = sorted(words, key=lambda w: (-power[w], w))[:12]
        candidates.append([w for w in top if power[w] >= 0.3 * power[top[0]]])
    positions = {w: i for i, w in enumerate(sorted({w for c in candidates for w in c}))}
    good_x, bad_x = _kernel(list(positions), marks)[0] @ root, _kernel(used, marks)[0] @ root
    chosen, machine = candidates, None
    for _ in range(rounds):
        picked = Counter(positions[w] for c in chosen for w in c)
        at, times = np.array(list(picked)), np.sqrt(list(picked.values()))
        x = np.vstack([good_x[at], bad_x])
        y = np.concatenate([np.ones(len(at)), -np.ones(len(used))])
        bad_weight = np.sqrt([in_clean[w] for w in used])
        svm = fit_svm(x, y, np.concatenate([times / times.sum(), bad_weight / bad_weight.sum()]))
        value = good_x @ svm[:-1] + svm[-1]
        chosen = [[w for w in c if value[positions[w]] > 0] or [max(c, key=lambda w: value[positions[w]])] for c in candidates]
        table_ = np.zeros(2 ** (5 * LENGTH), np.float32)
        table_[codes] = by_code @ (root @ svm[:-1])
        machine = Machine(table_, float(svm[-1]), 1.0, 0.0, marks, root @ svm[:-1])
        # The clean words that are taken for toxic are learned from in the next round.
        worst = machine.words(bad)
        hard = [bad[i] for i in np.argsort(-worst, kind="stable")[: negatives // 4] if worst[i] > -1]
        known = set(used)
        hard = [w for w in hard if w not in known]
        if hard:
            used += hard
            bad_x = np.vstack([bad_x, _kernel(hard, marks)[0] @ root])
    worst = np.array([machine.words(w).max() if w else machine.bias for _, w in documents])
    label = np.array([t for t, _ in documents], float)
    share = label.mean() if share is None else share
    weight = np.where(label > 0, share / label.mean(), (1 - share) / (1 - label.mean()))
    machine.slope, machine.shift = map(float, fit_logistic(worst[:, None], label, weight, ridge=0.01))
    return machine


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1500) -> Machine | None:
    """A machine fitted on at most per_label documents of each label, those with the smallest hashes of their ids. docs:
    (doc_id, text); labels: (doc_id, toxic), null labels left out; of rows that repeat a doc_id the highest label and
    the smallest text count."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~is_held_out(F.col("doc_id")))
    totals = {r["bad"]: r["n"] for r in known.groupBy((F.col("toxic") > 0).alias("bad")).agg(F.count("*").alias("n")).collect()}
    share = totals.get(True, 0) / max(1, sum(totals.values()))
    parts = [sampled(known.where(c), per_label, "doc_id") for c in ("toxic > 0", "toxic <= 0")]
    # 2 x per_label rows at most.
    some = docs.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [b"".join(sorted(set(words_of(stream(t))))) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "words": words})

    rows = some.select("doc_id", "toxic", "text").mapInPandas(cut, "doc_id long, toxic int, words binary").collect()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    return train([(int(r["toxic"] > 0), [b"\0" + w + b"\0" for w in bytes(r["words"]).split(b"\0") if w]) for r in rows], share)


def toxicity(text: Column, machine: Machine | None) -> Column:
    """0 to 1, higher the likelier the whole text is toxic. Null, empty and wordless texts get the score of a text whose
    words have nothing of any landmark; everything gets 0 if the machine is None."""
    if machine is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(machine.score(np.array([machine.worst_of(stream(t)) for t in texts])), dtype="float64")

    return score(text)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text"), machine).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLES: dict[str, str] = {}
