"""Staging models MD1-MD5: typed, renamed, de-duplicated raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import exprs as X
from ledgerlake.operators.topk import latest_per_key

TX_RAW_COLUMNS = ["user_id", "trans_num", "trans_date_trans_time", "merchant",
                  "unix_time", "original_amt", "currency", "is_fraud"]


def typed_transactions(raw: DataFrame) -> DataFrame:
    """The landed rows with names and types; extra raw columns (``category``)
    are kept, as with ``* except (...)``."""
    return raw.select(
        X.safe_cast("user_id", "string").alias("user_id"),
        X.safe_cast("trans_num", "string").alias("transaction_id"),
        X.safe_cast("trans_date_trans_time", "timestamp_ntz").alias("transaction_datetime_UTC"),
        X.strip_prefix("merchant").alias("merchant_name"),
        X.safe_cast("unix_time", "bigint").alias("unix_time_seconds"),
        X.safe_cast("original_amt", X.AMOUNT_TYPE).alias("original_amount"),
        F.upper("currency").alias("currency"),
        X.safe_cast("is_fraud", "boolean").alias("is_fraud"),
        *[c for c in raw.columns if c not in TX_RAW_COLUMNS],
    )


def stg_transactions(raw: DataFrame) -> DataFrame:
    """MD1: one row per transaction_id, the latest landing wins."""
    return latest_landing(typed_transactions(raw))


def latest_landing(typed: DataFrame) -> DataFrame:
    """The latest of a transaction's landed rows."""
    return latest_per_key(typed, ["transaction_id"],
                          [F.col("transaction_datetime_UTC").desc(), F.col("unix_time_seconds").desc()])


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    """MD2: typed FX quotes; fetch time as a zoneless UTC datetime."""
    return raw.select(
        X.safe_cast("timestamp", "timestamp").cast("timestamp_ntz").alias("datetime_fetched_UTC"),
        F.upper("base_currency").alias("base_currency"),
        F.upper("currency").alias("transaction_currency"),
        X.safe_cast("rate", X.RATE_TYPE).alias("rate"),
    )


def stg_merchants(raw: DataFrame) -> DataFrame:
    """MD3."""
    return raw.select(
        F.col("_airbyte_emitted_at").alias("raw_loaded_at"),
        X.strip_prefix("merchant").alias("merchant_name"),
        X.safe_cast("merch_lat", "double").alias("merchant_latitude"),
        X.safe_cast("merch_long", "double").alias("merchant_longitude"),
        F.nullif(X.safe_cast("merch_zipcode", "bigint"), F.lit(0)).alias("merchant_zipcode"),
    )


# Fixed value: the accepted update-time text, date 'T' time[.fraction] +HH:MM
ISO_OFFSET_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?[+-]\d{2}:\d{2}$"


def _iso_offset_timestamp(s):
    """FD12: ``safe.parse_timestamp('%Y-%m-%dT%H:%M:%E*S%Ez', s)``: only
    'T'-separated text with a +HH:MM offset parses; anything else is NULL."""
    return F.when(s.rlike(ISO_OFFSET_PATTERN), F.try_to_timestamp(s))


def stg_users_changes(raw: DataFrame, keep: tuple = ()) -> DataFrame:
    """MD4: one row per change-log entry; ``keep`` names further columns to pass on."""
    dob = F.col("dob")
    return raw.select(
        F.col("_airbyte_emitted_at").alias("raw_loaded_at"),
        _iso_offset_timestamp(F.col("_ab_cdc_updated_at").cast("string")).alias("updated_at"),
        X.safe_cast("user_id", "string").alias("user_id"),
        F.col("first_name"),
        F.col("last_name"),
        X.gender_label("gender").alias("gender"),
        F.col("street").alias("address"),
        F.col("city").alias("city_name"),
        F.nullif(X.safe_cast("zip", "bigint"), F.lit(0)).alias("zip_code"),
        X.safe_cast("lat", "double").alias("latitude"),
        X.safe_cast("long", "double").alias("longitude"),
        F.coalesce(X.safe_cast(dob.getField("member0"), "date"),
                   X.safe_cast(dob.getField("member1"), "date")).alias("date_of_birth"),
        F.col("job"),
        *keep,
    )


def stg_users_latest(changes: DataFrame) -> DataFrame:
    """MD5: latest change per user (updated_at desc, raw_loaded_at desc)."""
    return latest_per_key(changes, ["user_id"],
                          [F.col("updated_at").desc(), F.col("raw_loaded_at").desc()])
