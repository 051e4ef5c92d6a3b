"""

``entry(spark)`` runs the flagship query (daily KPI mart) on sf0.001;
section 2 to a callable (spark, sf_dir) -> DataFrame; ``oracle_sql()`` gives
the DuckDB SQL for the same keys (see ``oracles.py``).  Queries without an
oracle (model training, streaming, hash-sampled updates) get the rows-only
check.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles as O  # noqa: E402
from ledgerlake.plans.models import Models  # noqa: E402
from ledgerlake.session import configure  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _normalize(df: DataFrame) -> DataFrame:
    """Compare conventions: NUMERIC columns exactly, as text with 9 digits;
    doubles rounded to 6 digits; small integers -> BIGINT; timestamps ->
    zoneless UTC."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("decimal(38,9)").cast("string")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c.try_cast("decimal(38,13)"), 6).cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.StructType):
            # nested values compare field by field
            cols.extend(F.col(f"`{f.name}`").getField(s.name).alias(f"{f.name}_{s.name}") for s in t.fields)
            continue
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return _normalize(getattr(Models(spark, sf_dir), name))
    run.__name__ = name
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily KPI mart over the whole chain (dedup, nearest FX,
    SCD2 user versions, calendar, aggregation) on sf0.001."""
    return _built(lambda m: m.mart_kpi_daily, Models.SHARED)(spark, SMOKE_DIR)


# query key -> (model name, float columns for the oracle)
_MODEL_QUERIES = {
    "md01_stg_transactions": ("stg_transactions", ["original_amount"]),
    "md02_stg_fx_rates": ("stg_fx_rates", ["rate"]),
    "md03_stg_merchants": ("stg_merchants", ["merchant_latitude", "merchant_longitude"]),
    "md04_stg_users_changes": ("stg_users_changes", ["latitude", "longitude"]),
    "md05_stg_users_latest": ("stg_users_latest", ["latitude", "longitude"]),
    "md06_fx_enriched": ("int_transactions_fx_enriched", ["original_amount", "fx_rate_to_currency", "amount_usd"]),
    "md07_dim_date": ("dim_date", []),
    "md09_dim_merchants": ("dim_merchants", ["merchant_latitude", "merchant_longitude"]),
    "md10_dim_users_history": ("dim_users_history", ["latitude", "longitude"]),
    "md11_dim_users_current": ("dim_users_current", ["latitude", "longitude"]),
    "md12_fct_transactions": ("fct_transactions", ["original_amount", "fx_rate_to_currency", "amount_usd"]),
}
_KPI_FLOATS = ["fraud_rate", "amount_usd_total", "amount_usd_avg", "amount_usd_fraud_total"]
_MODEL_QUERIES.update({
    "md13_kpi_daily": ("mart_kpi_daily", _KPI_FLOATS),
    "md14_kpi_hourly": ("mart_kpi_hourly", _KPI_FLOATS),
    "md15_kpi_user_daily": ("mart_kpi_user_daily", _KPI_FLOATS),
    "md16_kpi_merchant_daily": ("mart_kpi_merchant_daily", _KPI_FLOATS),
    "md17_kpi_merchant_overall": ("mart_kpi_merchant_overall", _KPI_FLOATS),
    "md18_kpi_currency_daily": ("mart_kpi_currency_daily", _KPI_FLOATS),
    "md19_kpi_user_segments_daily": ("mart_kpi_user_segments_daily", _KPI_FLOATS),
})
_FEATURE_FLOATS = ["original_amount", "amount_log1p_original", "merchant_latitude", "merchant_longitude",
                   "user_original_amount_sum_24h", "user_original_amount_avg_24h", "user_original_amount_max_24h",
                   "user_original_amount_sum_30d", "user_original_amount_avg_30d", "user_original_amount_max_30d",
                   "merchant_original_amount_avg_30d", "user_merchant_original_amount_avg_30d"]
_MODEL_QUERIES.update({
    "md20_fraud_features": ("fraud_features", _FEATURE_FLOATS),
    "md21_fraud_features_serving": ("fraud_features_serving", _FEATURE_FLOATS),
})


def _built(fn, names=None) -> Callable[[SparkSession, str], DataFrame]:
    """A query over materialised models (written under the checkpoint folder)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return _normalize(fn(Models(spark, sf_dir).build(names)))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.plans import features
    configure(spark)
    m = Models(spark, sf_dir).build(Models.SHARED)
    return _normalize(features.fraud_features(m.fct_transactions, m.dim_date, m.dim_time, m.dim_merchants,
                                              bucket_seconds=86_400))


def _asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.plans import facts
    configure(spark)
    m = Models(spark, sf_dir).build(("stg_transactions",))
    return _normalize(facts.int_transactions_fx_enriched(m.stg_transactions, m.stg_fx_rates, bucket_seconds=86_400))


def _scd2_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.operators.scd2 import as_of_left_join
    configure(spark)
    m = Models(spark, sf_dir).build(("stg_transactions", "dim_users_history"))
    versions = m.dim_users_history.select(F.col("user_id").alias("__uid"), "user_version_id", "dbt_valid_from",
                                          "dbt_valid_to", "job")
    facts = m.stg_transactions.select("transaction_id", "user_id", "transaction_datetime_UTC")
    return _normalize(as_of_left_join(facts, "user_id", F.col("transaction_datetime_UTC"), versions, "__uid",
                                      "dbt_valid_from", "dbt_valid_to"))


def _dq_suite(models):
    from ledgerlake.plans.quality import data_tests
    return data_tests(models)


def _orphan_users(models):
    """Facts whose user is not in a user table that lacks every seventh user."""
    from ledgerlake.operators.quality import orphan_rows
    some = models.dim_users_current.where(F.col("user_id").cast("bigint") % 7 != 0)
    return orphan_rows(models.fct_transactions, "user_id", some, "user_id")


def _violations(models):
    """The generic tests over rows with planted faults: NULL users, foreign
    currencies, repeated transactions, users that are not there."""
    from ledgerlake.operators.quality import Check, run_suite
    nth, tx = F.col("transaction_id").cast("bigint"), models.stg_transactions
    t = tx.select(F.when(nth % 11 != 0, F.col("user_id")).alias("user_id"), "transaction_id",
                  F.when(nth % 17 == 0, F.concat(F.lit("X"), (nth % 3).cast("string"))).otherwise(F.col("currency"))
                  .alias("currency"))
    t = t.unionByName(tx.where(nth % 10 == 0).select("user_id", "transaction_id", "currency"))
    u = models.dim_users_current.where(F.col("user_id").cast("bigint") % 7 != 0).select("user_id")
    checks = [Check("t", "user_id", "not_null"), Check("t", "transaction_id", "unique"),
              Check("t", "currency", "accepted_values", values=("USD", "EUR", "DKK", "NOK", "SEK")),
              Check("t", "user_id", "relationships", to_model="u", to_field="user_id"), Check("u", "user_id", "unique")]
    return run_suite(models.spark, {"t": t, "u": u}, checks)


def _feature_frame(models):
    from ledgerlake.plans import ml
    return ml.feature_frame(models.fraud_features).select("transaction_id", *ml.FEATURES)


def _scaling_stats(models):
    from ledgerlake.plans import ml
    return ml.scaling_stats(models.fraud_features)


def _threshold(models):
    """ML3 / ML4 over probabilities made from the transactions' times."""
    from ledgerlake.plans import ml
    p = (F.col("unix_time_seconds") % 1000) / F.lit(1000.0)
    probs = F.array(F.struct(F.lit(False).alias("label"), (1 - p).alias("prob")),
                    F.struct(F.lit(True).alias("label"), p.alias("prob")))
    return ml.decide(models.stg_transactions.withColumn("probs", probs), F.col("probs"), 0.1)


def _ml(name):
    from ledgerlake.plans import ml
    return getattr(ml, name)


def _report(name):
    from ledgerlake.plans import reports
    return getattr(reports, name)


# report query -> (function, the mart table it scans)
_REPORT_FNS = {
    "rp01_by_currency": ("rp1_by_currency", "mart_kpi_currency_daily"),
    "rp02_merchant_map": ("rp2_merchant_map", "mart_kpi_merchant_overall"),
    "rp03_by_hour": ("rp3_by_hour", "mart_kpi_hourly"),
    "rp04_fraud_share_by_part_of_day": ("rp4_fraud_share_by_part_of_day", "mart_kpi_hourly"),
    "rp05_fraud_rate_card": ("rp5_fraud_rate_card", "mart_kpi_daily"),
    "rp06_distinct_by_currency": ("rp6_distinct_by_currency", "mart_kpi_currency_daily"),
    "rp07_daily_by_currency": ("rp7_daily_by_currency", "mart_kpi_currency_daily"),
    "rp08_fraud_rate_by_merchant": ("rp8_fraud_rate_by_merchant", "mart_kpi_merchant_overall"),
}


_REPORT_DIMS = {"rp02_merchant_map": ["dim_merchants"], "rp03_by_hour": ["dim_time"],
                "rp04_fraud_share_by_part_of_day": ["dim_time"], "rp07_daily_by_currency": ["dim_date"]}


def _llm(name: str) -> dict:
    """``queries()`` or ``oracle_sql()`` of the optional training-data operators and pipeline; empty where their
    folder or file has been taken away."""
    out: dict = {}
    for module in ("ledgerlake.llm.queries", "corpus_pipeline"):
        try:
            m = importlib.import_module(module)
        except ModuleNotFoundError as e:
            if not (e.name or "").startswith(("ledgerlake.llm", "corpus_pipeline")):
                raise
            continue
        out.update(getattr(m, name)())
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for key, (model, _) in _MODEL_QUERIES.items():
        # facts, marts and features read their parents' written tables, as in the build
        parents = ("stg_transactions",) if model.startswith("int_") else Models.SHARED[:-1] if model.startswith("fct_") \
            else Models.SHARED if model.startswith(("mart_", "fraud_")) else None
        q[key] = _built(lambda m, name=model: getattr(m, name), parents) if parents else _model(model)
    # JN1 and WN6-WN14 again with day-wide buckets: the width only moves cost
    q["jn01_asof_join"] = _asof_join
    q["jn02_scd2_join"] = _scd2_join
    q["md20_fraud_features_split"] = _split_features
    q["jn09_orphan_users"] = _built(_orphan_users, Models.SHARED)
    q["dq05_suite"] = _built(_dq_suite)
    q["dq06_violations"] = _built(_violations, ("stg_transactions", "dim_users_history"))
    q["ml05_feature_frame"] = _built(_feature_frame, (*Models.SHARED, "fraud_features"))
    q["ml01_scaling_stats"] = _built(_scaling_stats, (*Models.SHARED, "fraud_features"))
    q["ml02_predict_function"] = _built(_ml("predict_function"), (*Models.SHARED, "fraud_features"))
    q["mc01_threshold"] = _built(_ml("threshold_counts"), (*Models.SHARED, "fraud_features"))
    q["ml04_threshold"] = _built(_threshold, ("stg_transactions",))
    from ledgerlake.plans import published
    for key, (fn, mart) in _REPORT_FNS.items():
        q[key] = _built(_report(fn), (*Models.SHARED, mart))
        # SRC16: the same reports over published, bucketed tables
        q[f"src16_{key}"] = _built(published.over_published(_report(fn), [mart, *_REPORT_DIMS.get(key, [])]), Models.SHARED)
    from ledgerlake.plans import filters
    q["jn10_filter_context"] = _built(filters.filter_contexts, (*Models.SHARED, *Models.MARTS[:-1]))
    q["jn10_filtered_visuals"] = _built(filters.filtered_visuals, (*Models.SHARED, "mart_kpi_currency_daily",
                                                                   "mart_kpi_merchant_overall"))
    from ledgerlake.operators import distinct
    q["ag07_distinct_bitmaps"] = _built(distinct.distinct_levels, Models.SHARED)
    for key, fn in _ingest_fns().items():
        q[key] = _plain(fn)
    q["md22_fraud_predictions"] = _predictions
    from ledgerlake.plans import scalars
    for key in ("fs_strings", "fd_dates", "fm_math", "fj_json"):
        q[key] = _plain(getattr(scalars, key))
    q.update(_llm("queries"))
    return q


def _plain(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return _normalize(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _ingest_fns() -> dict:
    from ledgerlake.plans import ingest as I
    return {
        "src01_csv_roundtrip": I.csv_roundtrip,
        "md24_fx_landing": I.fx_landing,
        "md23_split_events": lambda s, d: I.source_split(s, d, "events"),
        "md23_split_users": lambda s, d: I.source_split(s, d, "users"),
        "md23_split_merchants": lambda s, d: I.source_split(s, d, "merchants"),
        "src10_apply_log": I.applied_log,
        "src10_log_history": I.log_history,
        "src11_published_fact": I.published_fact,
        "st05_enrich_events": I.enriched_events,
        "st08_event_preview": I.event_preview,
        "md25_stream_landing": I.stream_landing,
        "st07_staged_from_landing": I.staged_from_landing,
        "st01_group_progress": I.group_landing,
        "st07_stateful_staging": I.stateful_staging,
        "st04_quarantine": I.quarantine,
        "md26_user_updates": I.user_updates,
        "md26_user_updates_job": lambda s, d: I.user_updates(s, d, salt="run-2", fraction=0.25),
        "md26_user_updates_zip": lambda s, d: I.user_updates(s, d, salt="run-3", fraction=0.25),
    }


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD22: train on the feature table, store, score the serving view; the time it ran at is only tested for being there."""
    from ledgerlake.plans.ingest import scratch
    from ledgerlake.plans.ml import JobVars, fraud_predictions
    configure(spark)
    models = Models(spark, sf_dir).build((*Models.SHARED, "fraud_features"))
    out = fraud_predictions(models, JobVars(model_path=scratch(spark, "model") + "/fraud_lr_v1"))
    return _normalize(out.withColumn("has_time", F.col("predicted_at").isNotNull()).drop("predicted_at"))


def oracle_sql() -> dict[str, str]:
    from ledgerlake.plans.quality import CHECKS

    o: dict[str, str] = {}
    for key, (model, floats) in _MODEL_QUERIES.items():
        o[key] = O.normalized([model], f"select * from {model}", floats)
    o["jn01_asof_join"] = o["md06_fx_enriched"]
    o["jn02_scd2_join"] = O.normalized(["stg_transactions", "stg_users_changes"], O.SCD2_JOIN)
    o["md20_fraud_features_split"] = o["md20_fraud_features"]
    o["jn09_orphan_users"] = O.normalized(["fct_transactions", "dim_users_current"], O.ORPHANS)
    o["dq06_violations"] = O.normalized(["stg_transactions", "dim_users_current"], f"select * from ({O.VIOLATIONS})")
    o.update(O.ml_sql())
    o["dq05_suite"] = O.dq_suite_sql(CHECKS)
    for key, (deps, body, floats) in O.INGEST_QUERIES.items():
        o[key] = O.normalized(deps, body, floats)
    o["st07_stateful_staging"] = o["md01_stg_transactions"]
    o["src11_published_fact"] = o["md12_fct_transactions"]
    o["md26_user_updates"] = O.user_updates_sql()
    o["md26_user_updates_job"] = O.user_updates_sql(salt="run-2", fraction=0.25)
    o["md26_user_updates_zip"] = O.user_updates_sql(salt="run-3", fraction=0.25)
    for key, (deps, body, floats) in O.SCALARS.items():
        o[key] = O.normalized(deps, body, floats)
    for key, (deps, body, floats) in O.REPORTS.items():
        o[key] = o[f"src16_{key}"] = O.normalized(deps, body, floats)
    o["ag07_distinct_bitmaps"] = O.with_models(["fct_transactions"], O.DISTINCT_LEVELS)
    o.update(O.scoring_sql())
    o.update(O.change_log_sql())
    o["jn10_filter_context"] = O.filter_context_sql()
    o["jn10_filtered_visuals"] = O.filtered_visuals_sql()
    o.update(_llm("oracle_sql"))
    return o
