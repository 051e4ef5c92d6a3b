"""Fraud feature table MD20 and its serving view MD21.

Point-in-time features: recency (lag per key) and rolling aggregates over
strictly earlier events (RANGE ``W preceding .. 1 preceding`` on whole
seconds), by the bucketed sweep in ``operators.rolling``, which splits every
key over time buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import rolling

BASE_COLUMNS = ["transaction_id", "user_id", "merchant_name", "transaction_datetime_UTC", "unix_time_seconds",
                "date_key", "time_key", "original_amount", "is_fraud"]
DAY = 86_400
DAYS_30 = 2_592_000

# Output columns, in order
FEATURE_COLUMNS = [
    "transaction_id", "user_id", "merchant_name", "transaction_datetime_UTC", "unix_time_seconds",
    "is_fraud", "original_amount", "amount_log1p_original",
    "year_number", "quarter_number", "month_number", "iso_week_number", "day_of_week", "day_name",
    "hour_24", "part_of_day", "is_business_hours", "is_weekend",
    "merchant_latitude", "merchant_longitude", "merchant_zipcode", "has_merchant_geo",
    "user_recency_seconds", "merchant_recency_seconds", "user_merchant_recency_seconds",
    "user_txn_count_24h", "user_txn_count_30d",
    "user_original_amount_sum_24h", "user_original_amount_avg_24h", "user_original_amount_max_24h",
    "user_original_amount_sum_30d", "user_original_amount_avg_30d", "user_original_amount_max_30d",
    "merchant_txn_count_30d", "merchant_original_amount_avg_30d",
    "user_merchant_txn_count_30d", "user_merchant_original_amount_avg_30d",
]

# Fixed values: (prefix, keys, widths, with sum/max)
ROLLING_SPECS = [
    ("user", ["user_id"], {"24h": DAY, "30d": DAYS_30}, True),
    ("merchant", ["merchant_name"], {"30d": DAYS_30}, False),
    ("user_merchant", ["user_id", "merchant_name"], {"30d": DAYS_30}, False),
]


def enrich(fct: DataFrame, dim_date: DataFrame, dim_time: DataFrame, dim_merchants: DataFrame) -> DataFrame:
    """JN4: calendar, clock and merchant attributes (three left joins)."""
    base = fct
    d = dim_date.select(F.col("date_key").alias("__dk"), "year_number", "quarter_number",
                                          "month_number", "iso_week_number", "day_of_week", "day_name")
    t = dim_time.select(F.col("time_key").alias("__tk"), "hour_24", "part_of_day",
                                          "is_business_hours")
    m = dim_merchants.select(F.col("merchant_name").alias("__mn"), "merchant_latitude", "merchant_longitude",
                             "merchant_zipcode")
    e = (base.join(d, base["date_key"] == d["__dk"], "left")
             .join(t, base["time_key"] == t["__tk"], "left")
             .join(m, base["merchant_name"] == m["__mn"], "left")
             .drop("__dk", "__tk", "__mn"))
    return (e.withColumn("is_weekend", F.col("day_of_week").isin(1, 7))
             .withColumn("has_merchant_geo", F.col("merchant_latitude").isNotNull()
                         & F.col("merchant_longitude").isNotNull())
             .withColumn("amount_log1p_original", F.ln(1 + F.col("original_amount").cast("double"))))


def fraud_features(fct: DataFrame, dim_date: DataFrame, dim_time: DataFrame, dim_merchants: DataFrame,
                   bucket_seconds: int = rolling.DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """MD20: one row per transaction, 37 columns.  The windows run on narrow
    rows; the other columns and the dimensions come last."""
    narrow = fct.select("transaction_id", "user_id", "merchant_name", "unix_time_seconds", "original_amount",
                        F.col("transaction_datetime_UTC").cast("timestamp").alias("event_ts"))
    windows = rolling.point_in_time_features(narrow, ROLLING_SPECS, bucket_seconds)
    e = rolling.join_on_keys(fct.select(*BASE_COLUMNS), windows, ["transaction_id"])
    return enrich(e, dim_date, dim_time, dim_merchants).select(*FEATURE_COLUMNS)


def fraud_features_serving(features: DataFrame) -> DataFrame:
    """MD21: label removed (ML6)."""
    return features.drop("is_fraud")
