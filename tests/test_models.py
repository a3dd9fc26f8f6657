"""Queries on fitted models against plain versions of what they compute from the models' scores."""

import bisect
from math import log

import pytest
from pyspark.sql import functions as F

from fraudfeatures.operators import evaluation
from fraudfeatures.plans import queries


@pytest.fixture(scope="module")
def fitted(spark, small):
    """(the tables, the model's raw scores as (id, part, label, score), the model)."""
    t = queries.Tables(spark, small)
    rows, assembler, model = queries._trained(t)
    return t, [tuple(r) for r in queries._predicted(rows, assembler, model).select("transaction_id", "part", "label", "score").collect()], model


def plain_ranks(pairs):
    """(area under the ROC curve, average precision) of (score, label) by comparing all pairs and walking down the scores."""
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    average = 0.0
    for s in sorted(set(pos), reverse=True):
        tp, all_ = sum(p >= s for p in pos), sum(x >= s for x, _ in pairs)
        average += sum(p == s for p in pos) / len(pos) * tp / all_
    return auc, average


def pooled(pairs):
    """Isotonic regression of labels on scores: (scores, values), by pooling neighbours."""
    pools = []
    for score in sorted({s for s, _ in pairs}):
        own = [y for s, y in pairs if s == score]
        pools.append([sum(own), len(own), [score]])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            y, n, scores = pools.pop()
            pools[-1] = [pools[-1][0] + y, pools[-1][1] + n, pools[-1][2] + scores]
    return [s for _, _, scores in pools for s in scores], [y / n for y, n, scores in pools for _ in scores]


def line(x, y, at):
    """Linear interpolation, constant outside."""
    i = bisect.bisect_right(x, at)
    if i in (0, len(x)):
        return y[0] if i == 0 else y[-1]
    return y[i - 1] + (y[i] - y[i - 1]) * (at - x[i - 1]) / (x[i] - x[i - 1])


def test_train_classifier_metrics(spark, small, fitted):
    t, scores, _ = fitted
    got = queries.QUERIES["train_classifier"](spark, small).first()
    auc, average = plain_ranks([(s, y) for _, part, y, s in scores if part == "oot"])
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-8) and got["pr_auc"] == pytest.approx(average, abs=1e-8)


def test_top_importances(spark, small, fitted):
    _, _, model = fitted
    got = [tuple(r) for r in queries.QUERIES["top_importances"](spark, small).collect()]
    want = dict(zip(queries.MODEL_FEATURES, model.featureImportances.toArray().tolist(), strict=True))
    assert dict(got) == pytest.approx(want) and [v for _, v in got] == sorted((v for _, v in got), reverse=True) and sum(want.values()) == pytest.approx(1)


def test_score_batch_calibrates_bands_and_flags(spark, small, fitted):
    _, scores, _ = fitted
    x, y = pooled([(s, label) for _, part, label, s in scores if part == "train"])
    grid = [i / 999 for i in range(1000)]
    values = [line(x, y, g) for g in grid]
    got = {r["transaction_id"]: tuple(r)[1:] for r in queries.QUERIES["score_batch"](spark, small).collect()}
    assert set(got) == {i for i, part, *_ in scores if part == "oot"}
    for i, part, _, s in scores:
        if part == "oot":
            want = line(grid, values, s)
            score, band, flag = got[i]
            assert score == pytest.approx(want, abs=2e-6)
            assert band == ("critical" if score >= 0.8 else "high" if score >= 0.5 else "medium" if score >= 0.2 else "low") and flag == (score >= 0.5)


def test_backtest_metrics(spark, small, fitted):
    _, scores, _ = fitted
    got = {r["metric"]: r["value"] for r in queries.QUERIES["backtest"](spark, small).collect()}
    oot = [(s, y) for _, part, y, s in scores if part == "oot"]
    train = sorted(s for _, part, _, s in scores if part == "train")
    auc, average = plain_ranks(oot)
    want = {"roc_auc": auc, "pr_auc": average, "brier": sum((s - y) ** 2 for s, y in oot) / len(oot)}
    bins = [[(s, y) for s, y in oot if int(s * 10) == b] for b in range(10)]
    want["ece"] = sum(abs(sum(y for _, y in b) - sum(s for s, _ in b)) for b in bins if b) / len(oot)
    edges = []
    for q in range(1, 10):
        k, part = divmod(q / 10 * (len(train) - 1), 1)
        edges.append(train[int(k)] + (train[min(int(k) + 1, len(train) - 1)] - train[int(k)]) * part)
    edges = sorted(set(edges))
    place = lambda values: [sum(bisect.bisect_left(edges, v) == b for v in values) for b in range(len(edges) + 1)]
    r, c = place(train), place([s for s, _ in oot])
    shares = [(max(1e-6, a / len(oot)), max(1e-6, b / len(train))) for a, b in zip(c, r, strict=True) if a or b]
    want["psi"] = sum((p - q) * log(p / q) for p, q in shares)
    for least, band in evaluation.BANDS:
        for name, hit, label in (("tn", False, 0), ("fp", True, 0), ("fn", False, 1), ("tp", True, 1)):
            want[f"{name}_{band}"] = sum((s >= least) == hit and y == label for s, y in oot)
    assert set(got) == set(want)
    assert {k: v for k, v in got.items() if k != "psi"} == pytest.approx({k: v for k, v in want.items() if k != "psi"}, abs=1e-7)
    assert got["psi"] == pytest.approx(want["psi"], abs=2e-6)


def test_training_rows_are_made_once(spark, small, monkeypatch):
    """The search for the cutoff reads stored rows, not the windows that they come from."""
    plans, found = [], evaluation.time_cutoff

    def watched(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return found(df, *args)

    monkeypatch.setattr(evaluation, "time_cutoff", watched)
    queries._trained(queries.Tables(spark, small))
    assert plans and not any("Join" in p or "Window" in p for p in plans)


def test_ordinal_places_of_many_values(spark):
    """Values are numbered over several tasks; a caller's own columns stay."""
    df = spark.createDataFrame([(f"v{i * 7919 % 3000:05}", i) for i in range(3000)] + [(None, -1), ("unknown", -2)], "x string, place int")
    train = df.where("x <> 'unknown'")
    got = {r["x"]: (r["x_code"], r["place"]) for r in evaluation.categorical_encoding(df, train, "x").collect()}
    want = {x: i for i, x in enumerate(sorted(r["x"] for r in train.where("x IS NOT NULL").collect()))}
    assert {x: code for x, (code, _) in got.items()} == {**want, None: -1, "unknown": -1}
    assert got["unknown"] == (-1, -2) and all(place >= 0 for x, (_, place) in got.items() if x in want)
    assert evaluation.categorical_encoding(df, train.where(F.lit(False)), "x").where("x_code <> -1").count() == 0
