"""Dashboard KPI marts MD13-MD19, all built from one aggregate list.

Every mart is a single ``groupBy().agg()``: Spark aggregates partially in
each map task before the shuffle (a hot date or merchant collapses map-side)
and rewrites the exact distinct counts into an ``Expand`` + two-level
aggregate whose first level also runs before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import exprs as X

AMOUNT_SUM_TYPE = "decimal(38,9)"


def _sum_or_zero(x: Column) -> Column:
    """``sum(coalesce(x, 0))`` of a group.  NULLs cost no decimal addition, and the plain sum is one with that of an average."""
    return F.coalesce(F.sum(x), F.lit(0))


def kpi_aggs(distinct_users: bool = True, distinct_merchants: bool = True) -> list[Column]:
    """AG1-AG7 in the reference's column order."""
    fraud = F.col("is_fraud")
    usd = F.col("amount_usd")
    aggs = [
        F.count(F.lit(1)).alias("txn_count"),
        F.count_if(F.coalesce(fraud, F.lit(False))).alias("fraud_txn_count"),
        X.safe_divide(F.count_if(F.coalesce(fraud, F.lit(False))), F.count(F.lit(1))).alias("fraud_rate"),
        _sum_or_zero(usd).cast(AMOUNT_SUM_TYPE).alias("amount_usd_total"),
        X.numeric_avg(usd).alias("amount_usd_avg"),
        _sum_or_zero(F.when(fraud, usd)).cast(AMOUNT_SUM_TYPE).alias("amount_usd_fraud_total"),
    ]
    if distinct_users:
        aggs.append(F.count_distinct("user_id").alias("distinct_users"))
    if distinct_merchants:
        aggs.append(F.count_distinct("merchant_name").alias("distinct_merchants"))
    return aggs


def mart_kpi_daily(fct: DataFrame) -> DataFrame:
    """MD13."""
    return fct.groupBy("date_key").agg(*kpi_aggs())


def mart_kpi_hourly(fct: DataFrame) -> DataFrame:
    """MD14: per (date_key, time_key), i.e. per second of day (T12).

    The reference left-joins dim_time for ``hour_24`` and never reads it; a
    left join on a unique key cannot change row counts, so it is omitted.
    """
    return fct.groupBy("date_key", "time_key").agg(*kpi_aggs())


def mart_kpi_user_daily(fct: DataFrame) -> DataFrame:
    """MD15."""
    g = fct.groupBy("date_key", "user_id").agg(*kpi_aggs(distinct_users=False))
    return g.select("date_key", "user_id", X.surrogate_key("date_key", "user_id").alias("date_user_key"),
                    *[c for c in g.columns if c not in ("date_key", "user_id")])


def mart_kpi_merchant_daily(fct: DataFrame) -> DataFrame:
    """MD16."""
    g = fct.groupBy("date_key", "merchant_name").agg(*kpi_aggs(distinct_merchants=False))
    return g.select("date_key", "merchant_name",
                    X.surrogate_key("date_key", "merchant_name").alias("date_merchant_key"),
                    *[c for c in g.columns if c not in ("date_key", "merchant_name")])


def mart_kpi_merchant_overall(fct: DataFrame) -> DataFrame:
    """MD17."""
    return fct.groupBy("merchant_name").agg(
        *kpi_aggs(distinct_merchants=False),
        F.min("date_key").alias("first_date_key"),
        F.max("date_key").alias("last_date_key"))


def mart_kpi_currency_daily(fct: DataFrame) -> DataFrame:
    """MD18."""
    g = fct.groupBy("date_key", "currency").agg(*kpi_aggs())
    return g.select("date_key", "currency", X.surrogate_key("date_key", "currency").alias("date_currency_key"),
                    *[c for c in g.columns if c not in ("date_key", "currency")])


def mart_kpi_user_segments_daily(fct: DataFrame, dim_date: DataFrame, users_current: DataFrame) -> DataFrame:
    """MD19: per (date_key, gender, age_band).

    Gender and age band depend only on (user, day), so the facts are first
    reduced to one row per (date_key, user_id, merchant_name) with additive
    partial sums (pre-aggregation before the user join).  The join then moves
    distinct triples instead of transactions, and a hot user collapses to a
    handful of rows before any shuffle.  The second aggregate re-adds the
    partials; the exact distinct counts stay exact because the triples keep
    both user and merchant.
    """
    fraud = F.coalesce(F.col("is_fraud"), F.lit(False))
    usd = F.col("amount_usd")
    part = fct.groupBy("date_key", "user_id", "merchant_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(fraud).alias("n_fraud"),
        F.sum(usd).alias("usd_sum"),
        F.count(usd).alias("usd_n"),
        F.sum(F.when(fraud, usd)).alias("usd_fraud"),
    )
    dd = dim_date.select(F.col("date_key").alias("__dk"), "date_day")
    users = users_current.select(F.col("user_id").alias("__uid"), F.col("gender").alias("__g"),
                                 "date_of_birth")
    e = (part.join(dd, part["date_key"] == dd["__dk"], "left")
             .join(users, part["user_id"] == users["__uid"], "left"))
    e = e.select("date_key", "user_id", "merchant_name", "n", "n_fraud", "usd_sum", "usd_n", "usd_fraud",
                 F.coalesce(F.col("__g"), F.lit("Unknown")).alias("gender"),
                 X.age_band(F.col("date_day"), F.col("date_of_birth")).alias("age_band"))
    g = e.groupBy("date_key", "gender", "age_band").agg(
        F.sum("n").alias("txn_count"),
        F.sum("n_fraud").alias("fraud_txn_count"),
        X.safe_divide(F.sum("n_fraud"), F.sum("n")).alias("fraud_rate"),
        _sum_or_zero(F.col("usd_sum")).cast(AMOUNT_SUM_TYPE).alias("amount_usd_total"),
        X.decimal_avg(F.sum("usd_sum"), F.sum("usd_n")).alias("amount_usd_avg"),
        _sum_or_zero(F.col("usd_fraud")).cast(AMOUNT_SUM_TYPE).alias("amount_usd_fraud_total"),
        F.count_distinct("user_id").alias("distinct_users"),
        F.count_distinct("merchant_name").alias("distinct_merchants"),
    )
    return g.select("date_key", "gender", "age_band",
                    X.surrogate_key("date_key", "gender", "age_band").alias("date_user_segment_key"),
                    *[c for c in g.columns if c not in ("date_key", "gender", "age_band")])
