"""Tables of the session's catalog: feature tables bucketed by key, and logs in day partitions that end by dropping days."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def store_bucketed(df: DataFrame, table: str, path: str, key: str = "transaction_id", buckets: int = 64) -> DataFrame:
    """Stores df as a table whose rows are dealt out to buckets by key and sorted by it, a file a bucket. Tables with equally many
    buckets are joined on the key without an exchange. Replaces a table of this name."""
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def day_database(spark: SparkSession, name: str, folder: str) -> None:
    """A database whose tables lie in a shared folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")


def append_days(df: DataFrame, table: str, ts: str) -> None:
    """Appends rows to a table of day partitions (column day, the date of ts; rows without a time lie in a partition of their own)."""
    rows = df.withColumn("day", F.to_date(ts))
    if df.sparkSession.catalog.tableExists(table):
        rows.select(df.sparkSession.table(table).columns).write.insertInto(table)
    else:
        rows.write.format("parquet").partitionBy("day").saveAsTable(table)


def days_of(spark: SparkSession, table: str) -> list[date]:
    """The days that a table holds, from its metadata alone; the partition without a day is left out."""
    names = (r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return sorted(datetime.strptime(n, "%Y-%m-%d").date() for n in names if n[:1].isdigit())


def drop_days(spark: SparkSession, table: str, now: datetime, keep: int) -> list[date]:
    """Drops the days that are `keep` days old or older at now, as metadata and files; nothing is rewritten. The dropped days."""
    old = [d for d in days_of(spark, table) if (now.date() - d).days >= keep]
    if old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION (day = DATE '{d}')" for d in old))
    return old
