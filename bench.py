"""Benchmark the headline models.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``.  As in the warehouse build, each model is one job
that reads its materialised parent tables (written once, untimed, under the
checkpoint folder); md01 reads the raw landing data.  Every query runs to
completion through the ``noop`` sink (full computation, no collect): one
warm-up, then the median of ``$BENCH_REPEATS`` (default 3) runs.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from ledgerlake.plans.models import Models  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

PARENTS = ("stg_transactions", "int_transactions_fx_enriched", "dim_date", "dim_users_history",
           "fct_transactions")

# id -> (model, materialised parents it reads)
QUERIES = {
    "md01_stg_transactions": ("stg_transactions", ()),
    "md06_fx_enriched": ("int_transactions_fx_enriched", ("stg_transactions",)),
    "md12_fct_transactions": ("fct_transactions",
                              ("int_transactions_fx_enriched", "dim_date", "dim_users_history")),
    "md13_kpi_daily": ("mart_kpi_daily", ("fct_transactions",)),
    "md19_kpi_user_segments_daily": ("mart_kpi_user_segments_daily",
                                     ("fct_transactions", "dim_date", "dim_users_history")),
    "md20_fraud_features": ("fraud_features", ("fct_transactions", "dim_date")),
    # skew: the fact table with a third of all rows moved onto one user
    # (derived from the given data)
    "md20_fraud_features_hot_user": ("fraud_features", ("fct_transactions", "dim_date")),
}
HOT_USER = {"md20_fraud_features_hot_user"}


def hot_user(fct):
    """A third of the transactions re-keyed to one user (skew probe)."""
    from pyspark.sql import functions as F
    return fct.withColumn("user_id", F.when(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0,
                                            F.lit("hot-user")).otherwise(F.col("user_id")))


def run_once(spark, built: Models, model: str, parents, hot=None) -> float:
    t0 = time.perf_counter()
    m = Models(spark, SF_DIR)
    for p in parents:
        m.__dict__[p] = getattr(built, p)
    if hot is not None:
        m.__dict__["fct_transactions"] = hot
    getattr(m, model).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = build_session(f"local[{CPUS}]", app="ledgerlake-bench", shuffle_partitions=CPUS * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    spark.sparkContext.setLogLevel("ERROR")
    only = [a for a in sys.argv[1:]]
    built = Models(spark, SF_DIR).build(PARENTS)
    hot = None
    results = {}
    for key, (model, parents) in QUERIES.items():
        if only and not any(o in key for o in only):
            continue
        if key in HOT_USER and hot is None:
            hot = hot_user(built.fct_transactions).checkpoint()
        h = hot if key in HOT_USER else None
        run_once(spark, built, model, parents, h)                   # warm-up
        times = [run_once(spark, built, model, parents, h) for _ in range(REPEATS)]
        results[key] = round(statistics.median(times), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    headline = {k: v for k, v in results.items() if not k.endswith("_hot_user")}
    print(json.dumps({"metric": "median_seconds_per_query_total", "value": round(sum(headline.values()), 3),
                      "unit": "sec", "queries": results, "sf": float(sf) if sf else None,
                      "cpus": CPUS, "repeats": REPEATS}))
    spark.stop()


if __name__ == "__main__":
    main()
