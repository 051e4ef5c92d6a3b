"""the marts' sums over groups with missing amounts, and what they cost."""

import datetime as dt
from decimal import Decimal

from helpers import rows

from ledgerlake.plans import marts
from ledgerlake.session import MIN_PARTITIONS, even_tasks

FCT = ("date_key long, time_key long, user_id string, merchant_name string, currency string, is_fraud boolean, "
       "amount_usd decimal(38,9)")


def facts(spark):
    d = Decimal
    return spark.createDataFrame([
        (1, 1, "a", "m", "USD", True, d("1.5")), (1, 1, "a", "m", "USD", False, d("2")), (1, 2, "b", "m", "USD", None, d("4")),
        (2, 1, "a", "n", "SEK", True, None), (2, 1, None, None, "SEK", None, None),
        (3, 1, "a", "n", "SEK", True, None), (3, 1, "a", "n", "EUR", False, d("-7")),
    ], FCT)


def test_missing_amounts_count_as_zero(spark):
    want = {1: (Decimal("7.5"), Decimal("2.5"), Decimal("1.5")), 2: (0, None, 0), 3: (-7, -7, 0)}
    days = spark.createDataFrame([(i, dt.date(2024, 1, i)) for i in (1, 2, 3)], "date_key long, date_day date")
    users = spark.createDataFrame([], "user_id string, gender string, date_of_birth date")
    for mart in (marts.mart_kpi_daily(facts(spark)), marts.mart_kpi_user_segments_daily(facts(spark), days, users)):
        got = {r["date_key"]: (r["amount_usd_total"], r["amount_usd_avg"], r["amount_usd_fraud_total"]) for r in mart.collect()}
        assert got == want
    assert len(rows(marts.mart_kpi_hourly(facts(spark)))) == 4


def test_two_decimal_sums_a_row(spark):
    """One over all amounts, shared by the total and the average, and one over those of frauds."""
    plan = marts.mart_kpi_merchant_overall(facts(spark))._jdf.queryExecution().sparkPlan().toString()
    partial = [line for line in plan.splitlines() if "partial_sum" in line]
    assert partial and all(line.count("partial_sum") <= 2 for line in partial), partial


def test_even_tasks_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(MIN_PARTITIONS, None)
    with even_tasks(spark):
        assert int(spark.conf.get(MIN_PARTITIONS)) >= 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(MIN_PARTITIONS, None) == before
    spark.conf.set(MIN_PARTITIONS, "3")
    try:
        with even_tasks(spark):
            assert spark.conf.get(MIN_PARTITIONS) == "3"
        assert spark.conf.get(MIN_PARTITIONS) == "3"
    finally:
        spark.conf.unset(MIN_PARTITIONS)
