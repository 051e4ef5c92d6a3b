"""The warehouse's data tests (76 checks) as data, and the suite over the models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.operators.quality import Check, run_suite

# The currency list of the accepted_values tests and the gender
# labels, as the reference's tests declare them.
CURRENCIES = ("DKK", "NOK", "SEK", "EUR", "USD")
GENDERS = ("Male", "Female")


def _nn(model, *cols):
    return [Check(model, c, "not_null") for c in cols]


def _uq(model, *cols):
    return [Check(model, c, "unique") for c in cols]


def _rel(model, col, to_model, to_field):
    return [Check(model, col, "relationships", to_model=to_model, to_field=to_field)]


def _acc(model, col, values):
    return [Check(model, col, "accepted_values", values=values)]


CHECKS: list[Check] = [
    # staging
    *_nn("stg_transactions", "user_id", "original_amount", "currency"),
    *_acc("stg_transactions", "currency", CURRENCIES),
    *_nn("stg_transactions", "transaction_id"), *_uq("stg_transactions", "transaction_id"),
    *_nn("stg_transactions", "transaction_datetime_UTC"),
    *_nn("stg_fx_rates", "datetime_fetched_UTC", "base_currency"),
    *_acc("stg_fx_rates", "base_currency", CURRENCIES),
    *_nn("stg_fx_rates", "transaction_currency"),
    *_acc("stg_fx_rates", "transaction_currency", CURRENCIES),
    *_nn("stg_merchants", "raw_loaded_at", "merchant_name"), *_uq("stg_merchants", "merchant_name"),
    *_nn("stg_users_changes", "user_id", "first_name", "last_name"),
    *_acc("stg_users_changes", "gender", GENDERS),
    # intermediate
    *_nn("int_transactions_fx_enriched", "transaction_id"), *_uq("int_transactions_fx_enriched", "transaction_id"),
    # core
    *_nn("dim_users_history", "user_version_id"), *_uq("dim_users_history", "user_version_id"),
    *_nn("dim_users_history", "user_id", "dbt_valid_from"),
    *_nn("dim_users_current", "user_id"), *_uq("dim_users_current", "user_id"),
    *_nn("dim_merchants", "merchant_name"), *_uq("dim_merchants", "merchant_name"),
    *_nn("dim_date", "date_key"), *_uq("dim_date", "date_key"),
    *_nn("dim_date", "date_day"), *_uq("dim_date", "date_day"),
    *_nn("dim_time", "time_key"), *_uq("dim_time", "time_key"),
    *_nn("fct_transactions", "transaction_id"), *_uq("fct_transactions", "transaction_id"),
    *_nn("fct_transactions", "user_id"), *_rel("fct_transactions", "user_id", "dim_users_current", "user_id"),
    *_rel("fct_transactions", "merchant_name", "dim_merchants", "merchant_name"),
    *_nn("fct_transactions", "date_key"), *_rel("fct_transactions", "date_key", "dim_date", "date_key"),
    *_nn("fct_transactions", "time_key"), *_rel("fct_transactions", "time_key", "dim_time", "time_key"),
    # dashboard
    *_nn("mart_kpi_daily", "date_key"), *_uq("mart_kpi_daily", "date_key"),
    *_rel("mart_kpi_daily", "date_key", "dim_date", "date_key"),
    *_nn("mart_kpi_user_daily", "date_user_key"), *_uq("mart_kpi_user_daily", "date_user_key"),
    *_nn("mart_kpi_user_daily", "date_key"), *_rel("mart_kpi_user_daily", "date_key", "dim_date", "date_key"),
    *_nn("mart_kpi_user_daily", "user_id"),
    *_nn("mart_kpi_merchant_daily", "date_merchant_key"), *_uq("mart_kpi_merchant_daily", "date_merchant_key"),
    *_nn("mart_kpi_merchant_daily", "date_key"),
    *_rel("mart_kpi_merchant_daily", "date_key", "dim_date", "date_key"),
    *_nn("mart_kpi_merchant_daily", "merchant_name"),
    *_rel("mart_kpi_merchant_daily", "merchant_name", "dim_merchants", "merchant_name"),
    *_nn("mart_kpi_merchant_overall", "merchant_name"), *_uq("mart_kpi_merchant_overall", "merchant_name"),
    *_rel("mart_kpi_merchant_overall", "merchant_name", "dim_merchants", "merchant_name"),
    *_nn("mart_kpi_currency_daily", "date_currency_key"), *_uq("mart_kpi_currency_daily", "date_currency_key"),
    *_nn("mart_kpi_currency_daily", "date_key"),
    *_rel("mart_kpi_currency_daily", "date_key", "dim_date", "date_key"),
    *_nn("mart_kpi_currency_daily", "currency"),
    *_nn("mart_kpi_hourly", "date_key"), *_rel("mart_kpi_hourly", "date_key", "dim_date", "date_key"),
    *_nn("mart_kpi_hourly", "time_key"), *_rel("mart_kpi_hourly", "time_key", "dim_time", "time_key"),
    *_nn("mart_kpi_user_segments_daily", "date_user_segment_key"),
    *_uq("mart_kpi_user_segments_daily", "date_user_segment_key"),
    *_nn("mart_kpi_user_segments_daily", "date_key"),
    *_rel("mart_kpi_user_segments_daily", "date_key", "dim_date", "date_key"),
    *_nn("mart_kpi_user_segments_daily", "gender", "age_band"),
]

TESTED_MODELS = sorted({c.model for c in CHECKS} | {c.to_model for c in CHECKS if c.to_model})


def data_tests(models, known: dict | None = None) -> DataFrame:
    """Run all checks over a ``Models`` instance (materialised or not), but for those whose results the writes gave."""
    tables = {m: getattr(models, m) for m in TESTED_MODELS}
    return run_suite(models.spark, tables, CHECKS, known)


def checks_of(model: str) -> list[Check]:
    return [c for c in CHECKS if c.model == model]
