"""Dimension models MD7-MD11."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import exprs as X
from ledgerlake.operators import scd2


def dim_date(stg_tx: DataFrame) -> DataFrame:
    """MD7: one row per calendar day between the first and last transaction day.

    The bounds are one global partial aggregate; the calendar is generated
    with ``sequence`` + ``explode``.  ``date_key`` equals
    ``row_number() over (order by day)`` because the days are contiguous, so
    no single-partition window is needed (WN4).
    """
    bounds = stg_tx.agg(F.min(F.to_date("transaction_datetime_UTC")).alias("min_date"),
                        F.max(F.to_date("transaction_datetime_UTC")).alias("max_date"))
    days = bounds.where(F.col("min_date").isNotNull()).select(
        "min_date", F.explode(F.sequence("min_date", "max_date")).alias("date_day"))
    d = F.col("date_day")
    return days.select(
        (F.datediff(d, F.col("min_date")) + 1).cast("bigint").alias("date_key"),
        d.alias("date_day"),
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("iso_week_number"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.extract(F.lit("YEAROFWEEK"), d).alias("iso_year_number"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """MD8: one row per second of the day (86,400 rows, fixed size).

    TIME is not a usable Spark type, so ``time_of_day`` is an ``HH:mm:ss``
    string; the parts come from integer arithmetic on the second number.
    """
    s = F.col("id")
    h, m, sec = (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"), (s % 60).cast("int")
    return spark.range(0, 86400, 1, numPartitions=1).select(
        (h * 10000 + m * 100 + sec).cast("bigint").alias("time_key"),
        F.format_string("%02d:%02d:%02d", h, m, sec).alias("time_of_day"),
        h.alias("hour_24"),
        m.alias("minute_number"),
        sec.alias("second_number"),
        F.format_string("%02d:00-%02d:59", h, h).alias("hour_bucket"),
        X.part_of_day(h).alias("part_of_day"),
        X.is_business_hours(h).alias("is_business_hours"),
    )


def dim_merchants(stg_merch: DataFrame) -> DataFrame:
    """MD9."""
    return stg_merch.select("merchant_name", "merchant_latitude", "merchant_longitude",
                            "merchant_zipcode", "raw_loaded_at")


USER_HISTORY_COLUMNS = ["user_version_id", "user_id", "first_name", "last_name", "full_name",
                        "gender", "address", "city_name", "zip_code", "latitude", "longitude",
                        "date_of_birth", "job", "updated_at", "raw_loaded_at", "dbt_valid_from",
                        "dbt_valid_to"]


def dim_users_history(changes: DataFrame) -> DataFrame:
    """MD10: SCD2 versions of users from the change log (FLT1, WN5, FS5, FS6, FS9)."""
    valid_from = F.coalesce(F.col("updated_at"), F.col("raw_loaded_at"))
    prepared = (changes.where(F.col("user_id").isNotNull() & valid_from.isNotNull())
                .withColumn("valid_from", valid_from))
    versioned = scd2.versions(prepared, "user_id", "valid_from",
                              [F.col("raw_loaded_at"), F.xxhash64(*[F.col(c) for c in prepared.columns])],
                              "valid_to")
    return versioned.select(
        X.surrogate_key(F.col("user_id"), F.date_format("valid_from", X.VERSION_TS_FORMAT)).alias("user_version_id"),
        "user_id", "first_name", "last_name",
        X.full_name("first_name", "last_name").alias("full_name"),
        "gender", "address", "city_name", "zip_code", "latitude", "longitude", "date_of_birth", "job",
        "updated_at", "raw_loaded_at",
        F.col("valid_from").alias("dbt_valid_from"),
        F.col("valid_to").alias("dbt_valid_to"),
    )


def dim_users_current(history: DataFrame) -> DataFrame:
    """MD11: the open version of each user (FLT2)."""
    return history.where(F.col("dbt_valid_to").isNull()).select(*USER_HISTORY_COLUMNS[:-1])
