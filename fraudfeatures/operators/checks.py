"""Data contracts: nulls, repeated keys, allowed values, ranges, references. Each check gives a tidy row: check, table, subject, bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tidy(df: DataFrame, check: str, table: str, subject: Column, bad: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), subject.alias("subject"), bad.cast("bigint").alias("bad_rows"))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Nulls of each column, in one pass."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    stack = counted.select(F.stack(F.lit(len(columns)), *(x for c in columns for x in (F.lit(c), F.col(c)))).alias("subject", "bad"))
    return _tidy(stack, "not_null", table, F.col("subject"), F.col("bad"))


def unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Keys that occur more than once."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).count().agg(F.count_if(F.col("count") > 1).alias("bad"))
    return _tidy(repeated, "unique", table, F.lit(key), F.col("bad"))


def accepted_values(df: DataFrame, table: str, column: str, values: list[str]) -> DataFrame:
    """Rows whose value is not in the list; nulls are left to not_null."""
    return _tidy(df.agg(F.count_if(~F.col(column).isin(values)).alias("bad")), "accepted_values", table, F.lit(column), F.col("bad"))


def at_least(df: DataFrame, table: str, column: str, least: float) -> DataFrame:
    return _tidy(df.agg(F.count_if(F.col(column) < least).alias("bad")), "range", table, F.lit(column), F.col("bad"))


def references(df: DataFrame, table: str, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is in no parent row."""
    known = parents.select(F.col(parent_key).alias(key)).distinct()
    orphans = df.where(F.col(key).isNotNull()).join(known, key, "left_anti")
    return _tidy(orphans.agg(F.count("*").alias("bad")), "reference", table, F.lit(key), F.col("bad"))


def shared(df: DataFrame, table: str, key: str, by: str) -> DataFrame:
    """Keys that several others use."""
    counted = df.groupBy(key).agg(F.count_distinct(by).alias("n")).agg(F.count_if(F.col("n") > 1).alias("bad"))
    return _tidy(counted, "shared", table, F.lit(key), F.col("bad"))


def report(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("passed", F.col("bad_rows") == 0)


def request_reason() -> Column:
    """Why a score request is refused; null if it is not."""
    missing = [F.when(F.coalesce(F.trim(c), F.lit("")) == "", f"missing {c}") for c in ("transaction_id", "user_id", "device_id", "merchant_id")]
    amount = F.when(F.coalesce(F.col("amount") <= 0, F.lit(True)), "amount not positive")
    hour = F.when((F.col("local_hour") < 0) | (F.col("local_hour") > 23), "local_hour out of range")
    return F.coalesce(*missing, amount, hour)


def request_validation(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused with a reason)"""
    judged = requests.withColumn("reason", request_reason())
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")
