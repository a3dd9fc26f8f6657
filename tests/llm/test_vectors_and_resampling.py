"""Importance resampling, vector codes and near-duplicate vectors against plain versions, and on odd inputs."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudfeatures.llm import codes, embdup, importance
from fraudfeatures.llm.common import checkpoint_root, frozen, scratch

VECTOR = "vec_id long, vector array<double>, label int, row long, component long, code string, place long"


def vectors(spark, rows):
    """(id, vector, label) with columns that the operators use names of."""
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], VECTOR)


def by_sql(sql, rows, tmp_path, spark):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/e")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    df = con.execute(sql).fetchdf()
    return sorted(map(str, df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))), spark.read.parquet(f"{tmp_path}/e")


def rows_of(df):
    got = df.toPandas()
    return sorted(map(str, got[sorted(got.columns)].astype(object).itertuples(index=False, name=None)))


# --- importance resampling -------------------------------------------------------------------------------------------


def plain_resample(docs, target):
    """By the definition, with words from the pattern and hashes of whole strings."""

    def features(text):
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)

    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for text in texts for f in features(text)[0]) for texts in ([x for _, x in docs], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    out, able = [], []
    for doc_id, text in docs:
        found, n_words = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None])
        if n_words >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = rank
    return out


def test_importance_against_plain_version(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = sorted(map(list, importance.op11_importance_resampling(spark, small).collect()))
    assert got == sorted(plain_resample(docs, target)) and sum(r[4] is not None for r in got) > 20


def test_importance_odd_rows(spark):
    words = "one two three four five six seven eight nine ten eleven twelve a b c d e f g h"
    docs = [(i, f"{words} {i % 7} Äİ {words}") for i in range(40)] + [(None, words), (None, None), (-7, words), (2**40, words)]
    docs += [(50, None), (51, ""), (52, "!? -"), (53, words + "x"), (54, words.rsplit(" ", 1)[0]), (55, "long\x7fWord{b} " * 30_000), (3, words)]
    target = ["One two-three", None, ""]
    frame = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, place long, row_no long, score long")
    got = importance.importance_resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    key = lambda r: str(list(r))
    assert sorted(map(list, got.collect()), key=key) == sorted(plain_resample(docs, target), key=key)
    assert importance.importance_resample(frame.limit(0), frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        importance.importance_resample(frame, frame, percent=101)


def test_radix_order_is_stable_and_whole(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, *range(-4, 4)]), rng.choice([None, -(2**63), 2**63 - 1, rng.randrange(10**6)])) for i in range(1500)]
    df = spark.createDataFrame(rows, "i long, a long, b long").repartition(7, "i")
    read = {r["i"]: n for n, r in enumerate(df.collect())}
    got = importance.radix_ranked(df, [("a", True), ("b", False)], block=64).collect()
    assert sorted(r["place"] for r in got) == list(range(1500))
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or 0, read[r[0]]))
    assert [r["i"] for r in sorted(got, key=lambda r: r["place"])] == [r[0] for r in want]


# --- vector codes ----------------------------------------------------------------------------------------------------


def test_equal_average_search_against_all_entries():
    rng = np.random.default_rng(1)
    for d, k, spread in ((4, 64, 3), (4, 64, 900), (1, 5, 2), (7, 1, 50)):
        parts, entries = rng.integers(-spread, spread, (500, d)), rng.integers(-spread, spread, (k, d))
        far = ((parts[:, None] - entries) ** 2).sum(axis=2)
        number, best = codes.nearest(parts, entries)
        assert (number == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()  # argmin takes the first of ties


def test_codes_match_sql(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, 0.2, 64).round(2 if i % 3 else 1))], i % 5 if i % 4 else None) for i in range(300)]
    rows += [(300, None, 1), (301, [float("nan")] * 64, 1), (302, [0.0] * 64, 1)]
    want, df = by_sql(codes.OP12_SQL, rows, tmp_path, spark)
    assert rows_of(codes.vector_codes(df.select("vec_id", F.col("embedding").alias("vector"), "label"))) == want


def test_codes_odd_rows(spark):
    inf = float("inf")
    rows = [(1, [0.5, 1.0, -2.0], 1), (1, [0.5, 1.0, -2.0], 1), (1, [0.25], 1), (None, [1.0, 1.0], None), (2, [], None), (3, None, 1), (4, [1.0, None], 1), (5, [inf], 1), (2**62 + 1, [1e300], 2)]
    got = codes.vector_codes(vectors(spark, rows), parts=2, entries=3).collect()
    assert sorted((r["vec_id"] or 0 for r in got)) == [0, 1, 1, 1, 2, 2**62 + 1] and all(len(r["code"]) == 4 for r in got)
    labelled = Counter()
    for r in got:
        labelled[r["label_error"]] += r["error"]
    assert all(total % error == 0 if error else total == 0 for error, total in labelled.items())
    assert codes.vector_codes(vectors(spark, rows).limit(0)).count() == 0
    assert codes.vector_codes(vectors(spark, [(3, None, 1)])).count() == 0
    with pytest.raises(ValueError):
        codes.vector_codes(vectors(spark, rows), parts=0)


# --- near-duplicate vectors ------------------------------------------------------------------------------------------


def clustered(rng, groups, spread, alone, d=64):
    """Unit vectors in groups around centres, some repeated, some alone."""
    out = []
    for size in groups:
        centre = rng.normal(size=d)
        out += [centre / np.linalg.norm(centre) + spread * rng.normal(size=d) / math.sqrt(d) for _ in range(size)]
    out += list(rng.normal(size=(alone, d)))
    out += [out[0], out[0] * 1.0, out[-1]]
    order = rng.permutation(len(out))
    return [(int(i), [float(x) for x in np.float32(out[j])], None) for i, j in enumerate(order)]


def plain_links(rows, cosine):
    """(vec_id, n_links, component_id, kept) of all pairs."""
    m = np.array([v for _, v, _ in rows], float)
    m /= np.linalg.norm(m, axis=1)[:, None]
    linked = m @ m.T >= cosine
    least = np.arange(len(m))
    while True:
        lower = np.array([least[row].min() for row in linked])
        if (lower == least).all():
            return sorted((i, int(row.sum()) - 1, int(c), i == c) for i, (row, c) in enumerate(zip(linked, least, strict=True)))
        least = lower


@pytest.mark.parametrize("spread,block", [(0.15, 1024), (0.4, 48)])
def test_near_vectors_against_all_pairs(spark, spread, block):
    """Tight groups, which the triangle inequality counts, and groups at the threshold itself, in blocks."""
    rows = clustered(np.random.default_rng(5), [2, 3, 60, 90, 5], spread, 80)
    got = embdup.near_vectors(vectors(spark, rows), block=block)
    assert sorted(map(tuple, got.collect())) == plain_links(rows, 0.9)


def test_near_vectors_match_sql(spark, tmp_path):
    rows = clustered(np.random.default_rng(6), [4, 9, 2], 0.3, 60)
    rows += [(500, None, 1), (501, [0.0] * 64, 1), (502, [float("nan")] * 64, 1), (503, [float("inf")] * 64, 1), (504, [-0.0] * 64, 1)]
    want, df = by_sql(embdup.OP13_SQL, rows, tmp_path, spark)
    assert rows_of(embdup.near_vectors(df.select("vec_id", F.col("embedding").alias("vector")))) == want


def test_near_vectors_odd_rows(spark):
    rows = [
        (5, [1.0, 0.0], 1), (7, [2.0], 1), (7, [1e-300, 0.0], 1), (None, [1e300, 1e299], 1), (None, [0.0, -3.0], 1), (None, [0.0, -3.0], 1), (1, [], 1), (2, [0.0], 1),
        (3, None, 1), (4, [None, 1.0], 1), (2**62 + 1, [-1.0], 1), (9, [-1.0], 1),
    ]
    got = Counter(map(tuple, embdup.near_vectors(vectors(spark, rows)).collect()))
    want = [(5, 3, 5, True), (7, 3, 5, False), (7, 3, 5, False), (None, 3, 5, False), (None, 1, None, True), (None, 1, None, True)]
    want += [(i, 0, i, True) for i in (1, 2, 3, 4)] + [(2**62 + 1, 1, 9, False), (9, 1, 9, True)]
    assert got == Counter(want)
    assert embdup.near_vectors(vectors(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        embdup.near_vectors(vectors(spark, rows), cosine=1.0)


def test_work_tables_go_when_nothing_reads_them(spark):
    """Of what an operator writes its result stays, also when scratches lie in each other or end by an error."""
    root = checkpoint_root(spark).removeprefix("file:").replace("//", "/")
    before = set(os.listdir(root))
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            kept = inner(frozen(spark.range(3), "x").where("id > 0"), "inner")
        result = outer(kept.selectExpr("id + 1 AS id"), "outer")
    assert sorted(r["id"] for r in result.collect()) == [2, 3]
    assert {name.split("-")[0] for name in set(os.listdir(root)) - before} == {"outer"}
    before = set(os.listdir(root))
    with pytest.raises(ZeroDivisionError), scratch(spark):
        frozen(spark.range(3), "y")
        1 / 0  # noqa: B018
    assert set(os.listdir(root)) == before
    rows = clustered(np.random.default_rng(8), [3], 0.1, 10)
    assert embdup.near_vectors(vectors(spark, rows)).where("n_links > 0").count() > 0
    assert {name.split("-")[0] for name in set(os.listdir(root)) - before} == {"near"}


def test_tables_reach_the_recall_at_the_threshold():
    """The chance of a projection against draws, and of a whole table against pairs exactly at the threshold."""
    rng = np.random.default_rng(7)
    u = rng.normal(size=(4000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    side = rng.normal(size=u.shape)
    side -= (side * u).sum(axis=1)[:, None] * u
    v = 0.9 * u + math.sqrt(1 - 0.81) * side / np.linalg.norm(side, axis=1)[:, None]
    depth, tables = embdup.tables_for(10**6, u[:1000], 0.9, 0.999)
    assert depth > 3
    missed = np.ones(len(u), bool)
    for t in range(tables):
        r = np.random.default_rng([13, t])
        directions, shifts = r.standard_normal((64, depth)), r.uniform(0, embdup.WIDTH, depth)
        a, b = (np.floor((x @ directions + shifts) / embdup.WIDTH) for x in (u, v))
        missed &= (a != b).any(axis=1)
    assert missed.mean() < 0.003
    far = np.linalg.norm(u[1:] - u[:-1], axis=1)
    assert abs(embdup.collision(far).mean() - 0.486) < 0.05
