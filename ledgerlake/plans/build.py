"""Full-refresh build: every model in DAG order, published as routed tables,
then the data tests (the ``build`` step of the warehouse project).

    python -m ledgerlake.plans.build <sf_dir> [warehouse_root]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.quality import ObservedChecks
from ledgerlake.plans import ml
from ledgerlake.plans.models import Models
from ledgerlake.plans.quality import checks_of, data_tests
from ledgerlake.session import checkpoint_dir
from ledgerlake.sources import io

# model -> layer (schema routing); DAG order
LAYERS = [
    ("stg_transactions", "staging"), ("stg_fx_rates", "staging"), ("stg_merchants", "staging"),
    ("stg_users_changes", "staging"), ("stg_users_latest", "staging"),
    ("int_transactions_fx_enriched", "intermediate"),
    ("dim_date", "marts"), ("dim_time", "marts"), ("dim_merchants", "marts"),
    ("dim_users_history", "marts"), ("dim_users_current", "marts"),
    ("fct_transactions", "marts"),
    ("mart_kpi_daily", "marts"), ("mart_kpi_hourly", "marts"), ("mart_kpi_user_daily", "marts"),
    ("mart_kpi_merchant_daily", "marts"), ("mart_kpi_merchant_overall", "marts"),
    ("mart_kpi_currency_daily", "marts"), ("mart_kpi_user_segments_daily", "marts"),
    ("fraud_features", "features"),
]
PARTITIONS = {"fct_transactions": ["date_key"]}


def build_all(spark: SparkSession, source: str | Models, root: str | None = None,
              job: ml.JobVars | None = None) -> DataFrame:
    """Publish every model; each later model reads its parents' published
    tables, so lineage is cut at every table.  The not_null and accepted_values
    tests run inside the writes, before a table is pointed to its new version; a
    failing one stops the build (FailedChecks).  Returns the data-test results.

    ``source``: a folder of driver tables, or ``Models`` over given landing
    tables (``Models.from_raw``).  ``job``: a stored fraud model to score with;
    without one it is trained on the feature table and stored under ``root``.
    """
    root = root or f"{checkpoint_dir(spark).rstrip('/')}/warehouse"
    m = source if isinstance(source, Models) else Models(spark, source)
    known: dict = {}
    for model, layer in LAYERS:
        checks = ObservedChecks(checks_of(model))
        name = io.materialize_table(spark, getattr(m, model), model, layer, root, PARTITIONS.get(model), checks)
        known |= checks.counts()
        m.__dict__[model] = io.read_table(spark, name)
    columns = ", ".join(f"`{c}`" for c in m.fraud_features_serving.columns)
    view = io.materialize_view(spark, "fraud_features_serving", "features",
                               f"SELECT {columns} FROM {io.target_name('fraud_features', 'features')}")
    m.__dict__["fraud_features_serving"] = io.read_table(spark, view)
    if job is None:
        job = ml.JobVars(model_path=f"{root.rstrip('/')}/models/fraud_lr_v1")
        ml.train(m.fraud_features, job.model_path)
    io.materialize_table(spark, ml.score_stored(m, job), "fraud_predictions", "predictions", root)
    return data_tests(m, known)


if __name__ == "__main__":
    from ledgerlake.session import build_session
    spark = build_session()
    build_all(spark, sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None).show(100, truncate=False)
