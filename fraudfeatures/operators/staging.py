"""Staging: raw rows cleaned, cast and filtered, column by column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT = "decimal(18,4)"


def _upper(name: str) -> Column:
    return F.upper(F.trim(name)).alias(name)


def _lower(name: str) -> Column:
    return F.lower(F.trim(name)).alias(name)


def _flag(name: str) -> Column:
    return F.coalesce(name, F.lit(False)).alias(name)


def stg_transactions(raw: DataFrame) -> DataFrame:
    """One row for each transaction with an id and an amount above zero."""
    rows = raw.where(F.col("transaction_id").isNotNull() & (F.col("amount") > 0))
    hour = F.coalesce(F.col("local_hour").cast("int"), F.hour("event_timestamp"))
    return rows.select(
        "transaction_id", "user_id", "device_id", "merchant_id", F.col("amount").cast(AMOUNT).alias("amount"),
        _upper("currency"), _lower("payment_method"), _upper("country_code"),
        F.col("ip_address").cast("string").alias("ip_address"), _flag("is_international"), _lower("txn_status"),
        "decline_reason", hour.alias("local_hour"), "event_timestamp", "ingestion_timestamp",
    )


def stg_users(raw: DataFrame) -> DataFrame:
    return raw.where("user_id IS NOT NULL").select(
        "user_id", _lower("email"), "phone", _upper("country_code"), F.col("signup_date").cast("date").alias("signup_date"),
        _lower("account_type"), _flag("is_verified"), "event_timestamp", "ingestion_timestamp",
    )


def stg_devices(raw: DataFrame) -> DataFrame:
    return raw.where("device_id IS NOT NULL AND user_id IS NOT NULL").select(
        "device_id", "user_id", "device_fingerprint", "platform", "os_version",
        F.col("ip_address").cast("string").alias("ip_address"), _upper("country_code"), "event_timestamp", "ingestion_timestamp",
    )


def stg_merchants(raw: DataFrame) -> DataFrame:
    return raw.where("merchant_id IS NOT NULL").select(
        "merchant_id", "merchant_name", _lower("merchant_category"), _upper("country_code"), _flag("is_online"),
        _lower("risk_tier"), "event_timestamp", "ingestion_timestamp",
    )


def stg_login_events(raw: DataFrame) -> DataFrame:
    return raw.where("user_id IS NOT NULL").select(
        "login_event_id", "user_id", "device_id", F.col("ip_address").cast("string").alias("ip_address"),
        _upper("country_code"), _lower("login_status"), "failure_reason", "event_timestamp", "ingestion_timestamp",
    )


def stg_fraud_labels(raw: DataFrame) -> DataFrame:
    return raw.where("transaction_id IS NOT NULL").select(
        "transaction_id", _flag("is_fraud"), "fraud_type", "label_source", "label_timestamp", "ingestion_timestamp"
    )
