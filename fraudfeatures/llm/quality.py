"""Quality by co-training of two views.

One classifier sees the text: how words repeat, what characters it is made of, and which words it has, as the evidence that
these words give (naive Bayes over hashed words). The other sees what is known about the page: source, language and length. Both start
from the labelled documents. In each round both score all other documents, and what one of them is sure about the other learns: the
text's evidence takes in the words of documents that the page view is sure of, counted by label over all documents, and the page
view the page data of documents that the text view is sure of. A view is sure beyond the decision values where labelled documents,
judged by a fit without them, bear it out. Then each view is calibrated on labelled documents that neither learned from and that took no
part in the exchange, and the calibrated views are combined into one score for every document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget_in_worker, frozen, is_held_out, per_worker, sampled, scratch, table
from .linear import fit_logistic, logit, sigmoid
from .words import WordHashes

THRESHOLD = 0.5
SOURCES, LANGUAGES, LENGTHS = 256, 32, 24
WORDS = 2**16  # buckets that words are hashed into
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
LETTER = UPPER.copy()
LETTER[ord("a") : ord("z") + 1] = True
LETTER[0x80:] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PLAIN_MARK = np.zeros(256, bool)
PLAIN_MARK[[ord(c) for c in ".,;:'\"()-"]] = True
GROUPS = np.stack([UPPER, LETTER, DIGIT, SPACE, PLAIN_MARK, ~(LETTER | DIGIT | SPACE | PLAIN_MARK)]).astype(float)
SURFACE = 16
TEXT_FEATURES = SURFACE + 1


def surface(raw: bytes, words: list[bytes]) -> np.ndarray:
    """How a whole text is made; zeros for an empty one."""
    out = np.zeros(SURFACE)
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, letter, digit, space, mark, symbol = GROUPS @ counts / len(raw)
    lines = raw.split(b"\n")
    n = max(1, len(words))
    found = Counter(words)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out[:] = (
        np.log1p(len(raw)),
        np.log1p(len(words)),
        min(len(raw) / n, 40) / 40,
        len(found) / n,
        np.log1p(len(found)) / np.log1p(n),
        max(found.values(), default=0) / n,
        same / n,
        len(set(lines)) / len(lines),
        min(len(lines) / n, 1),
        upper,
        letter,
        digit,
        space,
        mark,
        symbol,
        counts[GROUPS[1] == 0].max() / len(raw),
    )
    return out


def buckets(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """The distinct buckets of a text's words, A-Z lower-cased."""
    found = {hashes[w] % WORDS for w in {w.lower() for w in words}}
    return np.sort(np.fromiter(found, np.uint16, len(found)))


def text_view(text: str | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """surface and buckets of the whole text; a null text is like an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    return surface(raw, words), buckets(words, hashes)


def page_places(source: str | None, lang: str | None, length: float | None) -> tuple[int, int, int]:
    """What is known about the page, as three hashed places; a null has a place of its own."""
    place = lambda x, n: 0 if x is None else 1 + xxhash.xxh64_intdigest(x) % (n - 1)
    unknown = length is None or not length >= 0
    return place(source, SOURCES), place(lang, LANGUAGES), 0 if unknown else 1 + min(LENGTHS - 2, int(np.log2(1 + length)))


def page_features(places: np.ndarray) -> np.ndarray:
    """Indicators of rows of places."""
    out = np.zeros((len(places), SOURCES + LANGUAGES + LENGTHS))
    for column, shift in enumerate((0, SOURCES, SOURCES + LANGUAGES)):
        out[np.arange(len(places)), places[:, column] + shift] = 1
    return out


def word_counts(found: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """By label, in how many documents each bucket occurs."""
    counts = np.zeros((2, WORDS))
    for b, y in zip(found, label, strict=True):
        counts[int(y), b] += 1
    return counts


def evidence_of(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each bucket the logarithm of how much likelier it is in good documents than in bad ones. n: documents by label."""
    share = (counts + 1) / (n[:, None] + 2)
    return (np.log(share[1]) - np.log(share[0])).astype(np.float32)


def mean_evidence(found: np.ndarray, evidence: np.ndarray) -> float:
    return float(evidence[found].mean()) if len(found) else 0.0


@dataclass(frozen=True)
class Views:
    """evidence: of each bucket; mean and spread: of the text's features; text and page: the weights of the views."""

    evidence: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    text: np.ndarray | None = None
    page: np.ndarray | None = None
    calibration: tuple[np.ndarray, np.ndarray] | None = None
    combination: np.ndarray | None = None

    def bent(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.hstack([z, z * z])

    def raw(self, text: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decision values of the two views."""
        half = np.cumsum([0, SOURCES, LANGUAGES])
        return logit(self.bent(text), self.text), self.page[places + half].sum(axis=1) + self.page[-1]

    def calibrated(self, text: np.ndarray, places: np.ndarray) -> np.ndarray:
        raw = self.raw(text, places)
        return np.column_stack([logit(r[:, None], c) for r, c in zip(raw, self.calibration, strict=True)])

    def score(self, text: np.ndarray, places: np.ndarray) -> np.ndarray:
        return sigmoid(logit(self.calibrated(text, places), self.combination))


VIEW = "doc_id long, surface array<double>, buckets binary, places array<int>"


def viewed(docs: DataFrame) -> DataFrame:
    """VIEW of docs (doc_id, text, lang, source, n_chars)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = per_worker((WordHashes.__name__,), WordHashes)
        for x in batches:
            views = [text_view(t, hashes) for t in x["text"]]
            known = ((None if pd.isna(v) else v for v in row) for row in zip(x["source"], x["lang"], x["n_chars"], strict=True))
            places = [list(page_places(*row)) for row in known]
            yield pd.DataFrame({"doc_id": x["doc_id"], "surface": [v[0].tolist() for v in views], "buckets": [v[1].tobytes() for v in views], "places": places})

    return docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("double").alias("n_chars")).mapInPandas(run, VIEW)


def _matrix(x: pd.DataFrame, evidence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of the text, places) of rows of VIEW."""
    words = [mean_evidence(np.frombuffer(b, np.uint16), evidence) for b in x["buckets"]]
    return np.column_stack([np.stack(x["surface"].to_list()), words]), np.stack(x["places"].to_list())


def _statistics(views: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of the texts' surface over all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_in_worker()
        total, n = np.zeros((2, SURFACE)), 0
        for x in batches:
            if len(x):
                text = np.stack(x["surface"].to_list())
                total, n = total + [text.sum(axis=0), (text * text).sum(axis=0)], n + len(x)
        yield pd.DataFrame({"n": [n], "sums": [total.ravel().tolist()]})

    sums = F.array(*(F.sum(F.col("sums")[i]) for i in range(2 * SURFACE)))
    row = views.select("surface").mapInPandas(run, "n long, sums array<double>").agg(F.sum("n").alias("n"), sums.alias("sums")).first()
    first, second = np.array(row["sums"]).reshape(2, -1) / row["n"]
    return first, np.sqrt(np.maximum(second - first**2, 0)) + 1e-6


def cutoffs(decision: np.ndarray, label: np.ndarray, sure: float) -> tuple[float, float]:
    """(low, high): the widest ranges of decision values, up to low and from high on, in which at least `sure` of the labels are 0 and 1,
    of five documents or more; infinite where there is none. Equal values count together."""
    out = []
    for sign in (-1, 1):
        order = np.argsort(-sign * decision, kind="stable")
        right = np.cumsum(label[order] == (sign > 0)) / np.arange(1, len(order) + 1)
        ends = np.append(decision[order][1:] != decision[order][:-1], True)
        at = np.flatnonzero(ends & (right >= sure) & (np.arange(len(order)) >= 4))
        out.append(decision[order][at[-1]] if len(at) else sign * np.inf)
    return float(out[0]), float(out[1])


def _exchange(views: DataFrame, told: Views, by_text: tuple[float, float], by_page: tuple[float, float]) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """What the views tell each other about documents whose labels are not looked at, beyond their cutoffs: the counts of words and the
    number of documents by the page's label, and (source, language, length, label, n) by the text's."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_in_worker()
        words, n, pages = np.zeros((2, WORDS), np.int64), np.zeros(2, np.int64), Counter()
        for x in batches:
            if not len(x):
                continue
            text, places = _matrix(x, told.evidence)
            of_text, of_page = told.raw(text, places)
            for y, sure in enumerate((of_page <= by_page[0], of_page >= by_page[1])):
                held = [np.frombuffer(b, np.uint16) for b in x["buckets"][sure]]
                words[y] += np.bincount(np.concatenate([*held, np.zeros(0, np.uint16)]), minlength=WORDS)
                n[y] += sure.sum()
            for y, sure in enumerate((of_text <= by_text[0], of_text >= by_text[1])):
                pages.update(zip(*places[sure].T.tolist(), [y] * int(sure.sum()), strict=True))
        label, bucket = np.nonzero(words)
        yield pd.DataFrame({"kind": 0, "a": bucket, "b": 0, "c": 0, "label": label, "n": words[label, bucket]})
        yield pd.DataFrame({"kind": 1, "a": 0, "b": 0, "c": 0, "label": [0, 1], "n": n})
        if pages:
            yield pd.DataFrame([(2, *k, v) for k, v in pages.items()], columns=["kind", "a", "b", "c", "label", "n"])

    rows = views.mapInPandas(run, "kind int, a int, b int, c int, label int, n long")
    # 2 x WORDS counts of words, and SOURCES x LANGUAGES x LENGTHS x 2 of page data at most.
    rows = rows.groupBy("kind", "a", "b", "c", "label").agg(F.sum("n").alias("n")).toPandas()
    words, n = np.zeros((2, WORDS)), np.zeros(2)
    of = {kind: rows[rows["kind"] == kind] for kind in (0, 1, 2)}
    words[of[0]["label"], of[0]["a"]] = of[0]["n"]
    n[of[1]["label"]] = of[1]["n"]
    return words, n, of[2].rename(columns={"a": "source", "b": "lang", "c": "length"}).sort_values(["source", "lang", "length", "label"], ignore_index=True)


def co_train(views: DataFrame, labelled: pd.DataFrame, rounds: int, sure: float, trust: float) -> Views | None:
    """labelled: rows of VIEW with a label of 0 or 1, in order; every fourth is kept for calibration. views: the documents that the
    views label for each other, none of them labelled."""
    if min((labelled["label"] == 1).sum(), (labelled["label"] == 0).sum()) < 5:
        return None
    found = [np.frombuffer(b, np.uint16) for b in labelled["buckets"]]
    label, number = labelled["label"].to_numpy(float), np.arange(len(labelled))
    test, half = number % 4 == 0, number // 4 % 2
    counted = lambda at: (word_counts([found[i] for i in number[at]], label[at]), np.bincount(label[at].astype(int), minlength=2))
    parts = [counted(~test & (half == h)) for h in (0, 1)]
    surface, spread = _statistics(views.select("surface").unionByName(views.sparkSession.createDataFrame(labelled[["surface"]])))
    places = np.stack(labelled["places"].to_list())
    y, pages, own_half = label[~test], page_features(places[~test]), half[~test]

    def learned(words: np.ndarray, n: np.ndarray, counts: pd.DataFrame | None) -> tuple[Views, tuple[float, float], tuple[float, float]]:
        """Both views, and where each is sure, from the labelled documents and what the other view says of the others. A document that is
        learned from is judged by the words of the others' half."""
        evidence = [evidence_of(parts[1 - h][0] + words, parts[1 - h][1] + n) for h in (0, 1)]
        whole = evidence_of(parts[0][0] + parts[1][0] + words, parts[0][1] + parts[1][1] + n)
        text, _ = _matrix(labelled, whole)
        judged = text.copy()
        judged[~test, -1] = [mean_evidence(found[i], evidence[half[i]]) for i in number[~test]]
        told = Views(whole, np.append(surface, judged[~test, -1].mean()), np.append(spread, judged[~test, -1].std() + 1e-6))
        x = told.bent(judged[~test])
        more, weight, extra = pages[:0], np.zeros(0), np.zeros(0)
        if counts is not None and len(counts):
            more, extra = page_features(counts[["source", "lang", "length"]].to_numpy()), counts["label"].to_numpy(float)
            weight = counts["n"].to_numpy() * min(1.0, trust * len(y) / counts["n"].sum())
        page = lambda at: fit_logistic(np.vstack([pages[at], more]), np.append(y[at], extra), np.append(np.ones(at.sum()), weight), ridge=1.0)
        of_text, of_page = np.zeros(len(y)), np.zeros(len(y))
        for h in (0, 1):  # where a view is sure shows in documents that it was not fitted on
            own = own_half == h
            of_text[own], of_page[own] = logit(x[own], fit_logistic(x[~own], y[~own], ridge=1.0)), logit(pages[own], page(~own))
        told = replace(told, text=fit_logistic(x, y, ridge=1.0), page=page(np.ones(len(y), bool)))
        return told, cutoffs(of_text, y, sure), cutoffs(of_page, y, sure)

    told, by_text, by_page = learned(np.zeros((2, WORDS)), np.zeros(2), None)
    for _ in range(rounds):
        told, by_text, by_page = learned(*_exchange(views, told, by_text, by_page))
    text, _ = _matrix(labelled, told.evidence)
    raw = told.raw(text[test], places[test])
    told = replace(told, calibration=tuple(fit_logistic(r[:, None], label[test], ridge=0.1) for r in raw))
    return replace(told, combination=fit_logistic(told.calibrated(text[test], places[test]), label[test], ridge=0.1))


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = 4000, rounds: int = 3, sure: float = 0.95, trust: float = 1.0) -> Views | None:
    """The views, fitted on at most labelled_rows labelled documents, those of the smallest hashes of their ids, and on what the
    views say of all others. docs: (doc_id, text, lang, source, n_chars); labels: (doc_id, quality); of rows that repeat a
    doc_id the lowest label and the smallest row count. Documents that are held out and null ids are not learned from. sure: the share of
    labelled documents that must bear a view out where its word is taken; trust: what all words of the text view weigh at most in the
    page view, against the labelled documents. None unless each label occurs five times."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    known = known.select("doc_id", (F.col("label") > 0).cast("int").alias("label"))
    rows = docs.where("doc_id IS NOT NULL").where(~is_held_out(F.col("doc_id"))).select("doc_id", "text", "lang", "source", "n_chars")
    with scratch(docs.sparkSession):
        return _fit(frozen(viewed(rows), "views"), known, labelled_rows, rounds, sure, trust)


def _fit(views: DataFrame, known: DataFrame, labelled_rows: int, rounds: int, sure: float, trust: float) -> Views | None:
    # labelled_rows ids at most.
    chosen = frozen(sampled(frozen(views.select("doc_id").distinct().join(known, "doc_id"), "labelled"), labelled_rows, "doc_id"), "chosen")
    some = views.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("label", "surface", "buckets", "places")).alias("row"))
    labelled = some.select("doc_id", "row.*").toPandas().sort_values("doc_id", ignore_index=True)
    others = views.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")
    return co_train(others, labelled, rounds, sure, trust) if len(labelled) else None


def quality(text: Column, lang: Column, source: Column, n_chars: Column, views: Views | None) -> Column:
    """The chance that a document is good, from the whole text and the page's data. Nulls have features of their own, an
    empty text is like a null one, repeated rows score alike; everything gets 1 if there are no views."""
    if views is None:
        return F.lit(1.0)

    @F.pandas_udf("double")
    def score(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.Series:
        if not len(text):
            return pd.Series(dtype="float64")
        hashes, pages, x, y = per_worker((WordHashes.__name__,), WordHashes), {}, [], []
        for t, *row in zip(text, source, lang, n_chars, strict=True):
            made, found = text_view(t, hashes)
            x.append(np.append(made, mean_evidence(found, views.evidence)))
            row = tuple(None if pd.isna(v) else v for v in row)
            y.append(pages[row] if row in pages else pages.setdefault(row, page_places(*row)))
        return pd.Series(views.score(np.array(x), np.array(y)))

    return score(text, lang, source, n_chars.cast("double"))


def quality_of(docs: DataFrame, views: Views | None) -> Column:
    return quality(docs["text"], docs["lang"], docs["source"], docs["n_chars"], views)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    views = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), quality_of(docs, views).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES = {"op10_quality": op10_quality}
ORACLES: dict[str, str] = {}
