"""
landing tables, one query per family (FS*, FD*, FM*, FJ*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import exprs as X
from ledgerlake.sources.tables import raw_transactions, raw_users


def fs_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = raw_users(spark, sf_dir)
    key = F.concat(F.lower(F.trim("first_name")), F.lit("|"), F.lower(F.trim("last_name")))
    return u.select(
        "user_id",
        F.col("_ab_cdc_updated_at").alias("updated_raw"),
        F.upper("gender").alias("gender_upper"),                                  # FS3
        X.gender_label("gender").alias("gender_label"),                           # CND1
        X.strip_prefix(F.concat(F.lit("fraud_"), F.col("last_name"))).alias("stripped"),   # FS4
        F.concat(F.col("first_name"), F.lit(" "), F.col("job")).alias("concat_nullable"),  # FS5
        X.full_name("first_name", "last_name").alias("full_name"),               # FS6
        F.nullif(X.safe_cast("zip", "bigint"), F.lit(0)).alias("zip_code"),       # FS1, FS7
        F.coalesce(F.col("job"), F.lit("n/a")).alias("job_or_na"),                # FS8
        X.surrogate_key("user_id", "job").alias("user_job_key"),                  # FS9
        X.uuid5(X.NAMESPACE_DNS, key).alias("name_uuid"),                         # FS10, FS11
    )


def fd_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw_transactions(spark, sf_dir)
    t = X.safe_cast("trans_date_trans_time", "timestamp_ntz")
    d = F.to_date(t)
    from_epoch = F.timestamp_seconds(F.col("unix_time")).cast("timestamp_ntz")
    return r.select(
        "trans_num", "unix_time",
        d.alias("day"),                                                            # FD1
        F.year(d).alias("year_number"), F.quarter(d).alias("quarter_number"),      # FD3
        F.month(d).alias("month_number"), F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("iso_week_number"),                                  # FD4
        F.extract(F.lit("YEAROFWEEK"), d).alias("iso_year_number"),
        F.dayofweek(d).alias("day_of_week"),                                       # FD5
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"),   # FD6
        X.time_key(t).alias("time_key"),                                           # FD7
        F.format_string("%02d:00-%02d:59", F.hour(t), F.hour(t)).alias("hour_bucket"),   # FD8
        (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).alias("second_of_day"),      # FD9
        X.seconds_diff(t, from_epoch).alias("seconds_vs_epoch"),                   # FD10
        X.year_boundaries(d, F.lit("1999-12-31").cast("date")).alias("years_since"),      # FD11
        F.coalesce(t, F.lit(X.FAR_FUTURE).cast("timestamp_ntz")).alias("t_or_far"),       # FD14
    )


def fm_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw_transactions(spark, sf_dir)
    amt = X.safe_cast("original_amt", X.AMOUNT_TYPE)
    divisor = (F.col("unix_time") % 7).cast(X.RATE_TYPE)
    return r.select(
        "trans_num",
        F.abs(amt - F.lit(50)).alias("abs_diff"),                                  # FM1
        F.ln(1 + amt.cast("double")).alias("log1p_amount"),                        # FM2
        X.safe_divide(F.col("is_fraud"), F.col("unix_time") % 7).alias("safe_ratio"),   # FM3
        X.to_usd(F.upper("currency"), amt, divisor).alias("guarded_division"),    # FM4
    )


def fj_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = raw_users(spark, sf_dir)
    js = F.to_json(F.col("dob"))
    return u.select(
        "user_id", "_ab_cdc_updated_at",
        F.get_json_object(js, "$.member0").alias("member0"),                       # FJ1
        F.get_json_object(js, "$.member1").alias("member1"),
        F.from_json(F.to_json(F.struct("user_id", "zip")), "user_id string, zip int")["zip"]
        .cast("bigint").alias("zip_roundtrip"),                                    # FJ2
        "job",
    )
