"""A training corpus from documents: language ID, quality, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on everything the stage before it kept; what it decides takes effect in the
rows it returns. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudfeatures.llm import decontam, langid, neardup, packing, quality
from fraudfeatures.llm.common import fresh, frozen, is_held_out, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: texts with a letter, of a score from which on predictions are worth having among labelled
    documents that the network has not learned from (langid.least_score).

    Null and empty texts and those without a letter go, texts of any length are read whole, repeated rows fare alike, nulls
    in other columns change nothing, and an empty table stays empty. Where no document has a language to learn from, all texts with
    a letter are kept.
    """
    model = langid.fit(langid.training_rows(docs))
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    least = langid.least_score(docs.where(is_held_out(F.col("doc_id"))).select("text", "lang"), model)
    found = fresh(docs, "found")
    told = docs.withColumn(found, langid.language(F.col("text"), model))
    return told.where((F.col(found)["lang_pred"] != langid.UNDETERMINED) & (F.col(found)["score"] >= least)).drop(found)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good by the combined views.

    A null or empty text, source, language or length is judged as such; repeated rows fare alike; an empty table stays empty. Without
    labels of both kinds everything is kept.
    """
    views = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    scored = docs.withColumn(score, quality.quality_of(docs, views))
    return scored.where(F.col(score) >= quality.THRESHOLD).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest id.

    Each row is a document of its own, whether its id is null (such a row stays only where its group has no other) or repeated. Rows
    without words, null and empty texts included, are in no group and stay; an empty table stays empty.
    """
    row = fresh(docs, "row")
    rows = frozen(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = neardup.near_duplicate_groups(rows.select(F.col(row).alias("doc_id"), "text"), words=5, similarity=(4, 5))
    groups = groups.select(F.col("doc_id").alias(row), F.col("component_id").alias("group"))
    members = frozen(groups.join(rows.select(row, "doc_id"), row), "members")
    first = members.groupBy("group").agg(F.count("*").alias("n"), F.min_by(row, F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first"))
    others = members.join(first.where("n > 1"), "group").where(F.col(row) != F.col("first")).select(row)
    return rows.join(others, row, "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts hold none and stay, long texts are searched whole, repeated rows fare alike, and with an empty benchmark
    everything stays.
    """
    leak = fresh(docs, "leak")
    return docs.withColumn(leak, decontam.leaks(F.col("text"), table(spark, sf_dir, "benchmark"))).where(~F.col(leak)).drop(leak)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens.

    A null or empty text is its end token alone; rows with a null or repeated id are documents of their own; long texts are cut into
    windows and lose nothing; an empty table gives no pieces.
    """
    return packing.pieces_digest(packing.retrieval_packing(docs, packing.tokenizer_path(), 2048, 1))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]
#: Trained models decide on the rows, which SQL cannot express. The tests hold near duplicates and decontamination against all
#: pairs and exact edit distances, packing against the tokenizer's ids, and the models' stages against their operators' scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
