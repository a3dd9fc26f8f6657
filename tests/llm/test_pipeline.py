"""Each stage against a plain version or its operator, on odd and on empty tables, and the registry."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fraudfeatures.llm import decontam, langid, packing, quality
from fraudfeatures.llm.common import is_held_out, table

from test_llm_operators import DOC, ODD, check_packing, near_components, word_sets

STAGES = dict(corpus_pipeline.STAGES)
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DATA, "documents").cache()


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_and_their_columns(docs):
    assert list(STAGES) == ["language_id", "quality_classifier", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(docs.sparkSession, docs, DATA).columns == docs.columns, name


def test_language_stage_is_the_operators_decision(spark, docs):
    model = langid.fit(langid.training_rows(docs))
    rows = docs.select("doc_id", "text", "lang", langid.language(F.col("text"), model).alias("x"), is_held_out(F.col("doc_id")).alias("out")).collect()
    letters = [r for r in rows if re.search(r"[^\W\d_]", r["text"] or "")]
    judged = [(int(r["x"]["score"] * 100), 1 if r["x"]["lang_pred"] == r["lang"] else -1) for r in letters if r["out"] and r["lang"] is not None]
    least = max(range(102), key=lambda bound: (sum(more for at, more in judged if at >= bound), -bound)) / 100
    want = [r["doc_id"] for r in letters if r["x"]["score"] >= least]
    assert ids(STAGES["language_id"](spark, docs, DATA)) == sorted(want)
    assert len(want) >= 0.98 * sum(r["lang"] is not None for r in rows)
    nothing_to_learn = docs.withColumn("lang", F.lit(None).cast("string"))
    letters = [r["doc_id"] for r in rows if re.search(r"[^\W\d_]", r["text"] or "")]
    assert ids(STAGES["language_id"](spark, nothing_to_learn, DATA)) == sorted(letters)


def test_language_threshold_drops_what_is_mostly_wrong(spark, docs):
    """Texts in a language whose labels are drawn at random: the network is unsure of them, and mostly wrong."""
    rows = [(i, "".join(chr(97 + (i * 7 + j * j) % 26) if j % 5 else " " for j in range(30)), f"l{i * i % 100}", "s", 30) for i in range(3000)]
    noise = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    both = noise.unionByName(docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 10_000))
    kept = corpus_pipeline.language_id(spark, both, DATA)
    assert kept.where("doc_id < 10000").count() < 1000
    known = docs.where("lang IS NOT NULL AND length(text) > 200").count()
    assert kept.where("doc_id >= 10000 AND lang IS NOT NULL AND length(text) > 200").count() > 0.9 * known


def test_quality_stage_is_the_operators_decision(spark, docs):
    views = quality.fit(docs, table(spark, DATA, "labels"))
    want = [r["doc_id"] for r in docs.select("doc_id", quality.quality_of(docs, views).alias("s")).collect() if r["s"] >= 0.5]
    assert ids(STAGES["quality_classifier"](spark, docs, DATA)) == sorted(want)


def test_near_duplicates_stage_against_all_pairs(spark, docs):
    sets = word_sets([(r["doc_id"], r["text"]) for r in docs.collect()], 5)
    want = [i for i, first in near_components(sets, 4, 5).items() if i == first]
    assert ids(STAGES["near_duplicates"](spark, docs, DATA)) == sorted(want)


def test_near_duplicates_keeps_one_row_of_each_group(spark):
    one, two = (" ".join(f"{w}{i}" for i in range(40)) for w in "ab")
    rows = [(5, one), (5, one), (None, one), (None, one), (3, one), (7, one), (7, two), (None, ""), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(3, one), (7, two), (None, ""), (8, None)], key=str)


def test_decontamination_stage_against_exact_edit_distance(spark, docs):
    cache = decontam.WordHashes()
    items = [w for w in (decontam.words(r["text"], cache) for r in table(spark, DATA, "benchmark").collect()) if len(w)]
    want, near = [], 0
    for r in docs.collect():
        w = decontam.words(r["text"], cache)
        leak = any(decontam.edits_within(item, w)[0] <= int(0.2 * len(item)) for item in items)
        near += leak
        want += [] if leak else [r["doc_id"]]
    assert near and ids(STAGES["decontamination"](spark, docs, DATA)) == sorted(want)


def test_packing_stage_holds_each_id_once(spark, docs):
    pieces = STAGES["packing"](spark, docs, DATA).toPandas()
    check_packing([(r["doc_id"], r["text"]) for r in docs.collect()], pieces)


def test_odd_rows_and_empty_tables(spark):
    odd, empty = spark.createDataFrame(ODD, DOC), spark.createDataFrame([], DOC)
    kept = {
        "language_id": lambda r: re.search(r"[^\W\d_]", r[1] or ""),  # nothing else is certain of so few texts
        "near_duplicates": lambda r: r[0] != 2,
        "decontamination": lambda r: True,
    }
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0, name
        got = stage(spark, odd, DATA)
        if name == "packing":
            assert got.where("doc_id IS NULL").count() == 2 and got.where("doc_id = 3").count() == 1
            continue
        assert got.columns == odd.columns, name
        rows = [tuple(r) for r in got.collect()]
        assert all(r in ODD for r in rows), name
        if name in kept:
            want = [r for r in ODD if kept[name](r)]
            assert len(rows) <= len(want) and all(r in want for r in rows) if name == "language_id" else sorted(rows, key=str) == sorted(want, key=str), name


def test_registry():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline", "op1_minhash_neardup", "op10_quality"} <= names
    assert set(__spark_entry__.oracle_sql()) <= names and packing.K1 > 0
