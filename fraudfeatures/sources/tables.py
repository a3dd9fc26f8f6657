"""Sources and sinks: raw tables, reconciled loads, partitioned and idempotent writes, outbox, topics and stream values."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: JSON values keep microseconds.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
CHANNELS = ["visa", "mastercard", "amex", "qris", "debit", "digital"]
TRANSACTION = T.StructType([
    *(T.StructField(n, T.StringType()) for n in ("transaction_id", "user_id", "device_id", "merchant_id", "channel")),
    T.StructField("amount", T.DoubleType()), *(T.StructField(n, T.StringType()) for n in ("currency", "payment_method", "country_code")),
    T.StructField("is_international", T.BooleanType()), T.StructField("txn_status", T.StringType()),
    T.StructField("local_hour", T.IntegerType()), T.StructField("event_timestamp", T.TimestampType()), T.StructField("ip_address", T.StringType()),
])


#: What is read of each raw table. Addresses are read as text.
RAW_COLUMNS = {
    "raw_users": ["user_id", "email", "phone", "country_code", "signup_date", "account_type", "is_verified", "event_timestamp", "ingestion_timestamp"],
    "raw_devices": ["device_id", "user_id", "device_fingerprint", "platform", "os_version", "ip_address", "country_code", "event_timestamp", "ingestion_timestamp"],
    "raw_merchants": ["merchant_id", "merchant_name", "merchant_category", "country_code", "is_online", "risk_tier", "event_timestamp", "ingestion_timestamp"],
    "raw_transactions": [
        "transaction_id", "user_id", "device_id", "merchant_id", "amount", "currency", "payment_method", "country_code", "ip_address",
        "is_international", "txn_status", "decline_reason", "local_hour", "event_timestamp", "ingestion_timestamp",
    ],
    "raw_login_events": ["login_event_id", "user_id", "device_id", "ip_address", "country_code", "login_status", "failure_reason", "event_timestamp", "ingestion_timestamp"],
    "fraud_labels": ["transaction_id", "is_fraud", "fraud_type", "label_source", "label_timestamp", "ingestion_timestamp"],
}


def read_raw_tables(spark: SparkSession, source: str, tables: list[str] | None = None, format: str = "parquet", key: str | None = None, partitions: int = 64, bounds: tuple[int, int] | None = None, **options: str) -> dict[str, DataFrame]:
    """The raw tables, or those named, with RAW_COLUMNS and addresses as text. format jdbc reads a table in `partitions` ranges of
    the numeric key between the bounds; others read folders under the source."""
    if unknown := set(tables or ()) - set(RAW_COLUMNS):
        raise ValueError(f"no raw tables: {', '.join(sorted(unknown))}")
    out = {}
    for name in tables or RAW_COLUMNS:
        if format == "jdbc":
            reader = spark.read.format("jdbc").option("url", source).option("dbtable", name).options(**options)
            if key and bounds:
                reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
            df = reader.load()
        else:
            df = spark.read.format(format).options(**options).load(f"{source}/{name}")
        out[name] = df.select(*(F.col(c).cast("string").alias(c) if c == "ip_address" else c for c in RAW_COLUMNS[name]))
    return out


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replaces what lies at the path; with partitions, only those that df has. The same again changes nothing."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """table_name, source_rows, target_rows, status: OK or MISMATCH."""
    parts = None
    for name, (source, target) in pairs.items():
        for side, df in (("s", source), ("t", target)):
            row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n")
            parts = row if parts is None else parts.unionByName(row)
    of = lambda side: F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0))
    counts = parts.groupBy("table_name").agg(of("s").alias("source_rows"), of("t").alias("target_rows"))
    return counts.withColumn("status", F.when(F.col("source_rows") == F.col("target_rows"), "OK").otherwise("MISMATCH"))


def write_by_month(df: DataFrame, path: str, entity: str, ts: str = "event_timestamp", id: str = "transaction_id", files: int = 8) -> None:
    """Month partitions, each row's entity in one of `files` files a month, sorted by entity, time and id, so that reads of a
    month or an entity skip the rest."""
    df = df.withColumn("event_month", F.date_format(ts, "yyyyMM")).withColumn("file_no", F.pmod(F.xxhash64(entity), F.lit(files)))
    dealt = df.repartition("event_month", "file_no").drop("file_no").sortWithinPartitions("event_month", entity, ts, id)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_month").parquet(path)


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType)})


def export_features(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        decimals_to_double(df).write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/{name}")


def time_range(tables: list[DataFrame], now: Column) -> DataFrame:
    """first_time, last_time over all tables; the last is not after now."""
    out = tables[0].select("event_timestamp")
    for df in tables[1:]:
        out = out.unionByName(df.select("event_timestamp"))
    return out.agg(F.min("event_timestamp").alias("first_time"), F.least(F.max("event_timestamp"), now).alias("last_time"))


def kafka_txn_source(spark: SparkSession, servers: str, pattern: str = r"^txn\.raw\..+$", format: str = "kafka", path: str | None = None, schema: T.StructType = TRANSACTION) -> DataFrame:
    """Streamed values: the topics' from the earliest on, or JSON lines of a folder where format is text."""
    if format == "kafka":
        reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        return reader.option("subscribePattern", pattern).option("startingOffsets", "earliest").load().select(F.col("value").cast("string").alias("value"))
    return spark.readStream.format(format).load(path)


def parsed(values: DataFrame, schema: T.StructType = TRANSACTION) -> DataFrame:
    """value and row, which is null or lacks fields where the value does not parse."""
    return values.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE", **JSON}).alias("row"))


def decode(values: DataFrame, schema: T.StructType = TRANSACTION, key: str = "transaction_id") -> tuple[DataFrame, DataFrame]:
    """(rows, bad values): JSON values decoded; those that do not parse or lack the key are kept apart, not fatal."""
    rows, good = parsed(values, schema), F.col(f"row.{key}").isNotNull()
    return rows.where(good).select("row.*"), rows.where(~F.coalesce(good, F.lit(False))).select("value")


def confluent_header(value: Column) -> tuple[Column, Column, Column]:
    """(valid, schema id, body) of a framed value: a zero byte, four bytes of schema id, most significant first, the body."""
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")
    valid = (F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")
    return valid, F.when(valid, number), F.when(valid, F.substr(value, F.lit(6)))


def routed(txns: DataFrame) -> DataFrame:
    """topic, key, value: a transaction's channel decides the topic, its user the key."""
    value = F.to_json(F.struct(*txns.columns), JSON)
    return txns.select(F.concat(F.lit("txn.raw."), "channel").alias("topic"), F.col("user_id").alias("key"), value.alias("value"))


def scored_values(scored: DataFrame) -> DataFrame:
    return scored.select(F.lit("txn.scored").alias("topic"), F.col("user_id").alias("key"), F.to_json(F.struct(*scored.columns), JSON).alias("value"))


def kafka_sink(values: DataFrame, servers: str, checkpoint: str, format: str = "kafka", path: str | None = None):
    """Publishes a stream of (topic, key, value): to the topics, or to files under the path in another format."""
    writer = values.writeStream.format(format).option("checkpointLocation", checkpoint)
    return writer.option("kafka.bootstrap.servers", servers) if format == "kafka" else writer.option("path", path)


def missing_rows(batch: DataFrame, target: DataFrame, id: str = "transaction_id") -> DataFrame:
    """Of a batch, one row of each id that the target lacks: the smallest by all columns, so that replays agree."""
    one = batch.groupBy(id).agg(F.min(F.struct(*batch.columns)).alias("row")).select("row.*")
    return one.join(target.select(id), id, "left_anti").select(batch.columns)


def append_missing(batch: DataFrame, path: str, id: str = "transaction_id", partition: str | None = None) -> None:
    """For foreachBatch: appends what the table at the path lacks; a repeated batch adds nothing. partition: a column that
    follows from the id, such as the month of its row; the table is partitioned by it, and only the batch's partitions are
    read."""
    spark, batch = batch.sparkSession, batch.persist()
    try:
        target = spark.read.schema(batch.schema).parquet(path)
        if partition is not None:
            # A value for each partition that the batch touches.
            target = target.where(F.col(partition).isin([r[0] for r in batch.select(partition).distinct().collect()]))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        target = batch.limit(0)
    writer = missing_rows(batch, target, id).write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    batch.unpersist()


def outbox_backlog(outbox: DataFrame, n: int) -> DataFrame:
    """The first n unpublished rows by id."""
    return outbox.where("published_at IS NULL").orderBy("id").limit(n)


def mark_published(outbox: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    ids = batch.select("id", F.lit(True).alias("in_batch"))
    out = outbox.join(ids, "id", "left")
    return out.withColumn("published_at", F.coalesce("published_at", F.when(F.col("in_batch"), now))).select(outbox.columns)


def outbox_status(outbox: DataFrame) -> DataFrame:
    open_ = F.col("published_at").isNull()
    return outbox.agg(F.count("*").alias("total"), F.count_if(open_).alias("unpublished"), F.count_if(~open_).alias("published"), F.max("published_at").alias("last_published"))


def outbox_retained(outbox: DataFrame, now: Column, days: int = 7) -> DataFrame:
    return outbox.where(F.col("published_at").isNull() | (F.unix_timestamp(now) - F.unix_timestamp("published_at") <= days * 86400))


def stream_status(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """table_name, n_rows, newest of each (table, time column)."""
    out = None
    for name, (df, ts) in tables.items():
        row = df.agg(F.count("*").alias("n_rows"), F.max(ts).alias("newest")).select(F.lit(name).alias("table_name"), "n_rows", "newest")
        out = row if out is None else out.unionByName(row)
    return out


def audit_rows(scores: DataFrame, first: str, last: str, most: int) -> DataFrame:
    """Audit rows of a range of dates, oldest first, `most` of them."""
    day = F.to_date("scored_at")
    return scores.where((day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date"))).orderBy("scored_at", "transaction_id").limit(most)


def audit_export(scores: DataFrame, path: str, first: str, last: str, most: int = 100_000, format: str = "csv") -> None:
    audit_rows(scores, first, last, most).write.mode("overwrite").option("header", True).format(format).save(path)
