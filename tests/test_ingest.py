
import os
import tempfile

from pyspark.sql import functions as F

from helpers import SF001
from ledgerlake.operators import quality, topk
from ledgerlake.plans import ingest, ml
from ledgerlake.plans.models import Models
from ledgerlake.plans.quality import CHECKS, data_tests
from ledgerlake.streaming import landing


def _write_messages(path, lines, name):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_landing_restart_and_quarantine(spark):
    root = tempfile.mkdtemp(prefix="ll-stream-", dir="/tmp")
    msgs = ingest.enriched_events(spark, SF001).limit(50)   # test fixture size, not a query
    lines = [r[0] for r in landing.to_messages(msgs).collect()]
    _write_messages(root + "/topic", lines[:30], "a.txt")
    _write_messages(root + "/topic", ["not json", "", "[]"], "bad.txt")

    def run():
        src = landing.read_messages(spark, "files", root + "/topic")
        landing.start_consumer(spark, src, root + "/landing", root + "/ckpt", available_now=True).awaitTermination()

    run()
    assert landing.read_landing(spark, root + "/landing").count() == 30
    run()                                                   # restart, nothing new: no duplicates
    assert landing.read_landing(spark, root + "/landing").count() == 30
    _write_messages(root + "/topic", lines[30:], "b.txt")
    run()                                                   # restart with new data: no loss
    landed = landing.read_landing(spark, root + "/landing")
    assert landed.count() == 50 and landed.select("trans_num").distinct().count() == 50
    q = landing.read_quarantine(spark, root + "/landing").collect()
    assert sorted(r["value"] for r in q) == ["", "[]", "not json"]
    nothing = spark.createDataFrame([("k1", None), ("k2", "")], "key string, value string")
    assert [(r["key"], r["status"]) for r in landing.decode_messages(nothing).collect()] == [
        ("k1", "quarantine"), ("k2", "quarantine")]     # a tombstone keeps its key
    assert "ingest_date" in landed.columns


def test_stream_landing_matches_batch_enrichment(spark):
    got = ingest.stream_landing(spark, SF001)
    want = ingest.enriched_events(spark, SF001)
    cols = sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def test_sample_top_n_exact_and_reproducible(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("k"))
    a = topk.sample_top_n(df, "k", 0.01, "s1")
    b = topk.sample_top_n(df, "k", 0.01, "s1")
    assert a.count() == 50 and sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    brute = (df.withColumn("h", topk.sample_hash(F.col("k"), "s1")).orderBy("h", "k").limit(50))
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in brute.collect())
    assert topk.sample_top_n(df.limit(0), "k", 0.01, "s1").count() == 0
    assert topk.sample_top_n(df.limit(10), "k", 0.01, "s1").count() == 1      # max(1, int(n * pct))


def test_user_updates_shape(spark):
    ch = ingest.user_updates(spark, SF001)
    n_users = ingest.raw_users(spark, SF001).select("user_id").distinct().count()
    assert ch.count() == max(1, int(n_users * 0.01))
    assert ch.columns[:2] == ["_airbyte_emitted_at", "_ab_cdc_updated_at"]


def test_data_tests_catch_violations(spark):
    m = Models(spark, SF001).build()
    res = {(r["model"], r["column_name"], r["test_name"]): r for r in data_tests(m).collect()}
    assert len(res) == len(CHECKS) == 76
    assert res[("stg_transactions", "transaction_id", "unique")]["passed"]
    assert res[("stg_users_changes", "gender", "accepted_values")]["failing_rows"] == 0   # X became NULL
    bad = spark.createDataFrame([("a", "EUR"), ("a", "XYZ"), (None, None), ("c", "XYZ"), ("d", "ABC")],
                                "k string, c string")
    parent = spark.createDataFrame([("b",)], "k string")
    checks = [quality.Check("t", "k", "not_null"), quality.Check("t", "k", "unique"),
              quality.Check("t", "c", "accepted_values", values=("EUR",)),
              quality.Check("t", "k", "relationships", to_model="p", to_field="k")]
    out = {r["test_name"]: r["failing_rows"] for r in quality.run_suite(spark, {"t": bad, "p": parent}, checks).collect()}
    # accepted_values counts distinct bad values (XYZ twice, ABC once -> 2)
    assert out == {"not_null": 1, "unique": 1, "accepted_values": 2, "relationships": 4}


def test_model_train_and_score(spark):
    m = Models(spark, SF001).build((*Models.SHARED, "fraud_features"))
    path = tempfile.mkdtemp(prefix="ll-model-", dir="/tmp") + "/m"
    pred = ml.fraud_predictions(m, ml.JobVars(model_path=path, fraud_probability_threshold=0.1))
    rows = pred.collect()
    assert len(rows) == m.fct_transactions.count()
    assert all(0.0 <= r["fraud_probability"] <= 1.0 for r in rows)
    assert all(r["predicted_fraud"] == (r["fraud_probability"] >= 0.1) for r in rows)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 30
    assert set(E.queries()) >= set(E.oracle_sql())


def test_full_build_publishes_routed_tables(spark):
    from ledgerlake.plans.build import build_all
    root = tempfile.mkdtemp(prefix="ll-wh-", dir="/tmp")
    from ledgerlake.sources import tables as T
    given = Models.from_raw(spark, T.raw_transactions(spark, SF001), T.raw_fx_rates(spark, SF001),
                            T.raw_users(spark, SF001), T.raw_merchants(spark, SF001))
    res = build_all(spark, given, root)
    assert res.count() == 76
    assert spark.table("analytics.fct_transactions").count() == 1000
    assert spark.table("feature_store.fraud_features_v1").count() == 1000
    assert os.path.isdir(f"{root}/analytics/fct_transactions")
    other = spark.newSession()                      # the view is a catalog object under its routed name
    assert "is_fraud" not in other.table("feature_store.fraud_features_v1_serving").columns
    assert spark.table("analytics_ml.fraud_predictions_v1").count() == 1000
    _overwrite_keeps_old_version_until_done(spark, root)


def _overwrite_keeps_old_version_until_done(spark, root):
    from ledgerlake.sources import io
    old = spark.table("analytics.dim_merchants").count()
    broken = spark.table("analytics.dim_merchants").withColumn("merchant_name", F.raise_error(F.lit("boom")).cast("string"))
    try:
        io.materialize_table(spark, broken, "dim_merchants", "marts", root)
    except Exception:
        pass
    assert spark.table("analytics.dim_merchants").count() == old > 0
    half = spark.table("analytics.dim_merchants").limit(3)
    io.materialize_table(spark, half, "dim_merchants", "marts", root)       # reads the version it replaces
    assert spark.table("analytics.dim_merchants").count() == 3


def test_delimited_dialect_round_trip(spark):
    from ledgerlake.sources import io
    values = ['x "y;z" w', "", None, "line\nbreak", "crlf\r\nx", "\\", '"', '""', '\\"', " lead", "tail ", ";", "a,b", "#c", "'q'"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    for sep in ";,":
        path = tempfile.mkdtemp(prefix="ll-csv-", dir="/tmp") + "/x"
        io.write_delimited(df, path, sep=sep)
        back = io.read_delimited(spark, path, df.schema, sep=sep, multi_line=True)
        assert {r["i"]: r["v"] for r in back.collect()} == dict(enumerate(values))


def test_delimited_reads_pandas_files(spark):
    import pandas as pd
    from ledgerlake.sources import io
    path = tempfile.mkdtemp(prefix="ll-csv-", dir="/tmp") + "/x.csv"
    pd.DataFrame({"a": ['say "hi"; you', None, "two\nlines"], "b": [1, 2, 3]}).to_csv(path, sep=";", index=False)
    got = io.read_delimited(spark, path, spark.createDataFrame([], "a string, b int").schema, multi_line=True).collect()
    assert [(r["a"], r["b"]) for r in got] == [('say "hi"; you', 1), (None, 2), ("two\nlines", 3)]


def test_monitor_and_pruned_landing_read(spark):
    root = tempfile.mkdtemp(prefix="ll-mon-", dir="/tmp")
    msgs = ingest.enriched_events(spark, SF001)
    lines = [r[0] for r in landing.to_messages(msgs).collect()]
    _write_messages(root + "/topic", lines, "a.txt")
    src = landing.read_messages(spark, "files", root + "/topic")
    q = landing.start_monitor(spark, src, root + "/monitor", root + "/ckpt-mon", available_now=True)
    q.awaitTermination()
    mon = spark.read.parquet(root + "/monitor")
    assert mon.agg(F.sum("events")).first()[0] == len(lines)
    landing.start_consumer(spark, landing.read_messages(spark, "files", root + "/topic"), root + "/landing",
                           root + "/ckpt", available_now=True).awaitTermination()
    df = landing.read_landing(spark, root + "/landing", since="2000-01-01")
    assert df.count() == len(lines)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(ingest_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PartitionFilters: [isnotnull(" in plan
    assert landing.read_landing(spark, root + "/landing", until="2000-01-01").count() == 0


def test_processing_time_trigger_and_stop(spark):
    # ST2: the service form (processing-time trigger); stopping after the
    # available data is processed leaves every event landed exactly once
    root = tempfile.mkdtemp(prefix="ll-svc-", dir="/tmp")
    lines = [r[0] for r in landing.to_messages(ingest.enriched_events(spark, SF001)).collect()]
    _write_messages(root + "/topic", lines, "a.txt")
    q = landing.start_consumer(spark, landing.read_messages(spark, "files", root + "/topic"), root + "/landing",
                               root + "/ckpt", available_now=False, flush_seconds=1)
    q.processAllAvailable()
    q.stop()
    assert landing.read_landing(spark, root + "/landing").count() == len(lines)


def test_unique_ignores_nulls_and_counts_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), (None,), (None,), ("c",)], "k string")
    r = quality.unique_failures("t", df, "k").first()
    assert r["failing_rows"] == 2            # 'a' and 'b' are duplicated; NULLs are ignored
    nn = quality.run_suite(spark, {"t": df}, [quality.Check("t", "k", "not_null")]).first()
    assert nn["failing_rows"] == 2 and nn["passed"] is False


def test_failed_batch_is_retried_once(spark, monkeypatch):
    # ST3: a micro-batch that fails is not committed; the restart replays it,
    # and the per-batch-id overwrite keeps exactly one copy of its output
    root = tempfile.mkdtemp(prefix="ll-retry-", dir="/tmp")
    lines = [r[0] for r in landing.to_messages(ingest.enriched_events(spark, SF001)).collect()]
    _write_messages(root + "/topic", lines, "a.txt")
    real = landing.batch_summary
    calls = {"n": 0}

    def flaky(batch):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("simulated failure")
        return real(batch)

    monkeypatch.setattr(landing, "batch_summary", flaky)
    q = landing.start_monitor(spark, landing.read_messages(spark, "files", root + "/topic"),
                              root + "/monitor", root + "/ckpt", available_now=True)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None
    q = landing.start_monitor(spark, landing.read_messages(spark, "files", root + "/topic"),
                              root + "/monitor", root + "/ckpt", available_now=True)
    q.awaitTermination()
    mon = spark.read.parquet(root + "/monitor")
    assert mon.agg(F.sum("events")).first()[0] == len(lines)
    assert mon.select("batch_id").distinct().count() == 1
