"""The model DAG as lazily built DataFrames.

``Models`` exposes every model as a property that returns its DataFrame
lineage (nothing runs until an action).  ``materialize`` writes a model to
Parquet under the shared checkpoint folder and swaps the property for a scan
of that output, which cuts lineage for the models many others read
(stg_transactions, fct_transactions) and lets a lost executor recompute from
files instead of from the raw inputs.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans import dims, facts, features, marts, staging
from ledgerlake.session import checkpoint_dir, even_tasks
from ledgerlake.sources.tables import RawInputs


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/runs/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 raw_tables: dict | None = None):
        self.spark = spark
        self.raw = RawInputs(spark, sf_dir, raw_tables)
        self._written: dict[str, DataFrame] = {}
        self.run_id = uuid.uuid4().hex[:12]

    def _get(self, name: str, build) -> DataFrame:
        return self._written.get(name) or build()

    # staging
    @classmethod
    def from_raw(cls, spark: SparkSession, transactions: DataFrame, fx_rates: DataFrame, users: DataFrame,
                 merchants: DataFrame) -> "Models":
        """Models over raw landing tables given as DataFrames."""
        return cls(spark, None, {"transactions": transactions, "fx_rates": fx_rates,
                                 "users": users, "merchants": merchants})

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return self._get("stg_transactions", lambda: staging.stg_transactions(self.raw.transactions))

    @cached_property
    def stg_fx_rates(self) -> DataFrame:
        return staging.stg_fx_rates(self.raw.fx_rates)

    @cached_property
    def stg_merchants(self) -> DataFrame:
        return staging.stg_merchants(self.raw.merchants)

    @cached_property
    def stg_users_changes(self) -> DataFrame:
        return staging.stg_users_changes(self.raw.users)

    @cached_property
    def stg_users_latest(self) -> DataFrame:
        return staging.stg_users_latest(self.stg_users_changes)

    # intermediate + dims
    @cached_property
    def int_transactions_fx_enriched(self) -> DataFrame:
        return self._get("int_transactions_fx_enriched", lambda: facts.int_transactions_fx_enriched(
            self.stg_transactions, self.stg_fx_rates))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._get("dim_date", lambda: dims.dim_date(self.stg_transactions))

    @cached_property
    def dim_time(self) -> DataFrame:
        return dims.dim_time(self.spark)

    @cached_property
    def dim_merchants(self) -> DataFrame:
        return dims.dim_merchants(self.stg_merchants)

    @cached_property
    def dim_users_history(self) -> DataFrame:
        return self._get("dim_users_history", lambda: dims.dim_users_history(self.stg_users_changes))

    @cached_property
    def dim_users_current(self) -> DataFrame:
        return dims.dim_users_current(self.dim_users_history)

    @cached_property
    def fct_transactions(self) -> DataFrame:
        return self._get("fct_transactions", lambda: facts.fct_transactions(
            self.int_transactions_fx_enriched, self.dim_users_history, self.dim_date))

    # marts
    @cached_property
    def mart_kpi_daily(self) -> DataFrame:
        return marts.mart_kpi_daily(self.fct_transactions)

    @cached_property
    def mart_kpi_hourly(self) -> DataFrame:
        return marts.mart_kpi_hourly(self.fct_transactions)

    @cached_property
    def mart_kpi_user_daily(self) -> DataFrame:
        return marts.mart_kpi_user_daily(self.fct_transactions)

    @cached_property
    def mart_kpi_merchant_daily(self) -> DataFrame:
        return marts.mart_kpi_merchant_daily(self.fct_transactions)

    @cached_property
    def mart_kpi_merchant_overall(self) -> DataFrame:
        return marts.mart_kpi_merchant_overall(self.fct_transactions)

    @cached_property
    def mart_kpi_currency_daily(self) -> DataFrame:
        return marts.mart_kpi_currency_daily(self.fct_transactions)

    @cached_property
    def mart_kpi_user_segments_daily(self) -> DataFrame:
        return marts.mart_kpi_user_segments_daily(self.fct_transactions, self.dim_date,
                                                  self.dim_users_current)

    # features
    @cached_property
    def fraud_features(self) -> DataFrame:
        return self._get("fraud_features", lambda: features.fraud_features(
            self.fct_transactions, self.dim_date, self.dim_time, self.dim_merchants))

    @cached_property
    def fraud_features_serving(self) -> DataFrame:
        return features.fraud_features_serving(self.fraud_features)

    # materialisation
    def materialize(self, name: str, root: str | None = None) -> DataFrame:
        """Write model ``name`` as Parquet under the shared folder and read it back."""
        root = root or checkpoint_dir(self.spark)
        path = f"{root.rstrip('/')}/models/{self.run_id}/{name}"
        with even_tasks(self.spark):
            getattr(self, name).write.mode("overwrite").parquet(path)
        df = self.spark.read.parquet(path)
        self._written[name] = df
        self.__dict__[name] = df
        return df

    # models read by several others, in dependency order
    SHARED = ("stg_transactions", "int_transactions_fx_enriched", "dim_date", "stg_users_changes", "dim_users_history",
              "fct_transactions")
    MARTS = ("mart_kpi_daily", "mart_kpi_hourly", "mart_kpi_user_daily", "mart_kpi_merchant_daily",
             "mart_kpi_merchant_overall", "mart_kpi_currency_daily", "mart_kpi_user_segments_daily")

    def build(self, names=None) -> "Models":
        """Materialise models in DAG order (the full-refresh build)."""
        for n in names or (*self.SHARED, *self.MARTS):
            self.materialize(n)
        return self
