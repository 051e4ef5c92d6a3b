"""Data tests inside the write (DQ1, DQ3): counted on the way, enforced before the table is pointed to."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.quality import Check, FailedChecks, ObservedChecks, run_suite
from ledgerlake.sources import io

CHECKS = [Check("dim_merchants", "k", "not_null"), Check("dim_merchants", "c", "accepted_values", values=("EUR", "USD")),
          Check("dim_merchants", "c", "not_null"), Check("dim_merchants", "k", "unique")]
SCHEMA = "k string, c string"


def publish(spark, rows, root):
    checks = ObservedChecks(CHECKS)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return checks, lambda: io.materialize_table(spark, df, "dim_merchants", "marts", root, checks=checks)


@pytest.fixture
def root(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS analytics.dim_merchants")
    spark.sql("DROP DATABASE IF EXISTS analytics CASCADE")
    yield str(tmp_path)
    spark.sql("DROP DATABASE IF EXISTS analytics CASCADE")


def test_good_table_is_published_with_its_counts(spark, root):
    checks, run = publish(spark, [("a", "EUR"), ("b", "USD")], root)
    run()
    assert spark.table("analytics.dim_merchants").count() == 2
    assert {(c.column, c.test): n for c, n in checks.counts().items()} == {
        ("k", "not_null"): 0, ("c", "accepted_values"): 0, ("c", "not_null"): 0}     # unique needs a scan


def test_planted_fault_leaves_the_old_table(spark, root):
    publish(spark, [("a", "EUR")], root)[1]()
    _, run = publish(spark, [("a", "EUR"), (None, "XYZ"), ("c", "XYZ"), ("d", None)], root)
    with pytest.raises(FailedChecks, match="dim_merchants.k not_null: 1 rows") as e:
        run()
    assert {(c.column, c.test): n for c, n in e.value.counts.items()} == {
        ("k", "not_null"): 1, ("c", "accepted_values"): 2, ("c", "not_null"): 1}
    assert [tuple(r) for r in spark.table("analytics.dim_merchants").collect()] == [("a", "EUR")]
    assert len(os.listdir(f"{root}/analytics/dim_merchants")) == 1      # the refused version is gone


def test_empty_table_passes(spark, root):
    publish(spark, [], root)[1]()
    assert spark.table("analytics.dim_merchants").count() == 0


def test_known_results_need_no_scan(spark):
    def never():
        return spark.range(4).select(F.raise_error(F.lit("scanned")).cast("string").alias("k"),
                                     F.raise_error(F.lit("scanned")).cast("string").alias("c"))
    known = {c: 0 for c in CHECKS[:3]}
    out = run_suite(spark, {"dim_merchants": never()}, CHECKS[:3], known).collect()
    assert [(r["column_name"], r["failing_rows"], r["passed"]) for r in out] == [("k", 0, True), ("c", 0, True), ("c", 0, True)]
    good = spark.createDataFrame([("a", "EUR")], SCHEMA)
    whole = {tuple(r) for r in run_suite(spark, {"dim_merchants": good}, CHECKS).collect()}
    assert {tuple(r) for r in run_suite(spark, {"dim_merchants": good}, CHECKS, known).collect()} == whole
