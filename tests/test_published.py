"""SRC16: bucketed published tables; report joins without an exchange; replacement by one catalog update."""

import pytest
from helpers import SF001
from pyspark.sql import functions as F

from ledgerlake.plans import reports
from ledgerlake.plans.filters import FilterContext
from ledgerlake.plans.models import Models
from ledgerlake.plans.published import publish, publish_report_tables


@pytest.fixture(scope="module")
def built(spark):
    return Models(spark, SF001).build(Models.SHARED)


@pytest.fixture
def tables(spark, built, tmp_path):
    yield publish_report_tables(built, str(tmp_path), "report_test", buckets=4)
    spark.sql("DROP DATABASE report_test CASCADE")


@pytest.mark.parametrize("table,dim", [("mart_kpi_merchant_overall", "dim_merchants"), ("mart_kpi_hourly", "dim_time"),
                                       ("mart_kpi_currency_daily", "dim_date")])
def test_report_joins_need_no_exchange(spark, tables, table, dim):
    key = "spark.sql.autoBroadcastJoinThreshold"
    kept = {k: spark.conf.get(k) for k in (key, "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in kept:
            spark.conf.set(k, "-1")     # as for marts of any size
        j = reports.related(tables, table, dim)
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == getattr(tables, table).count()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_reports_and_filters_read_the_published_tables(built, tables):
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(reports.rp2_merchant_map(tables), reports.rp2_merchant_map(built))
    assert same(reports.rp7_daily_by_currency(tables), reports.rp7_daily_by_currency(built))
    late = F.col("day_of_month") > 20
    assert same(*(FilterContext(t).where("dim_date", late).table("dim_merchants") for t in (tables, built)))


def test_a_failed_version_leaves_the_old_one(spark, tables, tmp_path):
    before = tables.dim_merchants.count()
    broken = tables.dim_merchants.withColumn("merchant_name", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        publish(spark, broken, "report_test", "dim_merchants", str(tmp_path), "merchant_name", 4)
    assert tables.dim_merchants.count() == before > 2
    publish(spark, tables.dim_merchants.limit(2), "report_test", "dim_merchants", str(tmp_path), "merchant_name", 4)
    assert tables.dim_merchants.count() == 2
