"""Fact models: MD6 (FX enrichment) and MD12 (fct_transactions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import exprs as X
from ledgerlake.operators import asof, scd2

FX_COLUMNS = {"fx_rate_to_currency": "rate"}


def int_transactions_fx_enriched(stg_tx: DataFrame, stg_fx: DataFrame, bucket_seconds: int = 3_600) -> DataFrame:
    """MD6: each transaction with the nearest FX quote of its currency and USD amount."""
    j = asof.nearest_asof_join(stg_tx, stg_fx, "currency", "transaction_datetime_UTC", "transaction_currency",
                               "datetime_fetched_UTC", FX_COLUMNS, bucket_seconds=bucket_seconds)
    j = j.withColumnRenamed("__right_time", "fx_rate_timestamp_UTC")
    cols = stg_tx.columns + ["fx_rate_to_currency", "fx_rate_timestamp_UTC"]
    return j.select(*cols, X.to_usd("currency", "original_amount", "fx_rate_to_currency").alias("amount_usd"))


FCT_COLUMNS = ["transaction_id", "user_id", "user_version_id", "merchant_name", "date_key", "time_key",
               "transaction_datetime_UTC", "unix_time_seconds", "currency", "original_amount",
               "fx_rate_to_currency", "fx_rate_timestamp_UTC", "amount_usd", "is_fraud"]


def fct_transactions(enriched: DataFrame, users_history: DataFrame, dim_date: DataFrame) -> DataFrame:
    """MD12: fact table; user version valid at the transaction time (JN2) and
    the date key (JN3).

    The version join is linear per (user, time bucket); dim_date is one row
    per day of the data's span.
    """
    uh = users_history.select(F.col("user_id").alias("__uid"), "user_version_id",
                              "dbt_valid_from", "dbt_valid_to")
    j = scd2.as_of_left_join(enriched, "user_id", F.col("transaction_datetime_UTC"), uh, "__uid",
                             "dbt_valid_from", "dbt_valid_to")
    dd = dim_date.select("date_key", F.col("date_day").alias("__day"))
    j = j.join(dd, F.to_date(j["transaction_datetime_UTC"]) == dd["__day"], "left")
    return j.select(*[X.time_key("transaction_datetime_UTC").alias("time_key") if c == "time_key" else c
                      for c in FCT_COLUMNS])
