"""Dashboard queries RP1-RP8 over the marts.

A visual's query is a left join from the mart to the dimensions that its
relationships (``plans/filters.py``) reach, followed by a re-aggregation (code
0 = sum, 1 = average).  The calendar and clock are bounded (days, 86,400
seconds); the merchant dimension grows with the merchants, and Spark picks its
join from the sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import exprs as X
from ledgerlake.plans.filters import RELATIONSHIPS


def related(models, table: str, dim: str, use_inactive: bool = False) -> DataFrame:
    """Left join ``table`` to ``dim`` over the model's relationship between
    them (the inactive role-playing one only when asked, like USERELATIONSHIP)."""
    for r in RELATIONSHIPS:
        if {r.table, r.to_table} == {table, dim} and r.active != use_inactive:
            t_col, d_col = (r.column, r.to_column) if r.table == table else (r.to_column, r.column)
            left = getattr(models, table)
            d = getattr(models, dim)
            d = d.select(*[F.col(c).alias(f"{dim}__{c}") for c in d.columns])
            return left.join(d, left[t_col] == d[f"{dim}__{d_col}"], "left")
    raise KeyError(f"no relationship between {table} and {dim}")


def rp1_by_currency(models) -> DataFrame:
    """Sum of USD total by currency (sorted desc); tooltip: unweighted average
    of the daily fraud_rate and sum of fraud amount."""
    m = models.mart_kpi_currency_daily
    return (m.groupBy("currency").agg(
        F.sum("amount_usd_total").alias("amount_usd_total"),
        F.avg("fraud_rate").alias("fraud_rate_avg"),
        F.sum("amount_usd_fraud_total").alias("amount_usd_fraud_total"))
        .orderBy(F.col("amount_usd_total").desc()))


def rp2_merchant_map(models) -> DataFrame:
    """Sum of USD total by merchant location (map visual)."""
    j = related(models, "mart_kpi_merchant_overall", "dim_merchants")
    return j.groupBy(F.col("dim_merchants__merchant_longitude").alias("merchant_longitude"),
                     F.col("dim_merchants__merchant_latitude").alias("merchant_latitude")).agg(
        F.sum("amount_usd_total").alias("amount_usd_total"))


def rp3_by_hour(models) -> DataFrame:
    j = related(models, "mart_kpi_hourly", "dim_time")
    return (j.groupBy(F.col("dim_time__hour_24").alias("hour_24")).agg(
        F.sum("amount_usd_total").alias("amount_usd_total"),
        F.sum("amount_usd_fraud_total").alias("amount_usd_fraud_total"))
        .orderBy(F.col("amount_usd_total").desc()))


def rp4_fraud_share_by_part_of_day(models) -> DataFrame:
    j = related(models, "mart_kpi_hourly", "dim_time")
    g = j.groupBy(F.col("dim_time__part_of_day").alias("part_of_day")).agg(
        F.sum("amount_usd_fraud_total").alias("amount_usd_fraud_total"))
    # share of the total over the grouped rows (one row per part of day)
    total = F.sum("amount_usd_fraud_total").over(Window.partitionBy(F.lit(1)))
    return (g.withColumn("fraud_amount_share",
                         X.safe_divide(F.col("amount_usd_fraud_total").cast("double"), total.cast("double")))
            .orderBy(F.col("amount_usd_fraud_total").desc()))


def rp5_fraud_rate_card(models) -> DataFrame:
    """Amount-based 'Fraud Rate' measure: DIVIDE(SUM fraud amount, SUM amount)."""
    m = models.mart_kpi_daily
    return m.agg(X.safe_divide(F.sum("amount_usd_fraud_total").cast("double"),
                               F.sum("amount_usd_total").cast("double")).alias("fraud_rate_amount"))


def rp6_distinct_by_currency(models) -> DataFrame:
    """Sum of daily distinct users / merchants by currency (not additive; as the visual does)."""
    m = models.mart_kpi_currency_daily
    return (m.groupBy("currency").agg(F.sum("distinct_users").alias("distinct_users"),
                                      F.sum("distinct_merchants").alias("distinct_merchants"))
            .orderBy(F.col("distinct_users").desc()))


def rp7_daily_by_currency(models) -> DataFrame:
    j = related(models, "mart_kpi_currency_daily", "dim_date")
    return (j.groupBy(F.col("dim_date__date_day").alias("date_day"), "currency").agg(
        F.sum("amount_usd_total").alias("amount_usd_total")).orderBy("date_day", "currency"))


def rp8_fraud_rate_by_merchant(models) -> DataFrame:
    """'Fraud Rate by Merchant' measure evaluated per merchant."""
    m = models.mart_kpi_merchant_overall
    return m.groupBy("merchant_name").agg(
        X.safe_divide(F.sum("amount_usd_fraud_total").cast("double"),
                      F.sum("amount_usd_total").cast("double")).alias("fraud_rate_by_merchant"))
