"""Model semantics on hand-written edge frames (FIXTURES.md section C)."""

import datetime as dt
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import SF001
from ledgerlake.functions import exprs as X
from ledgerlake.plans import dims, marts, staging
from ledgerlake.plans.models import Models

D = dt.datetime


def test_bad_casts_do_not_fail(spark):
    raw = spark.createDataFrame(
        [("1", "u", "2024-13-01 00:00:00", "fraud_m", "x", "abc", "dkk", "1", "food")],
        "trans_num string, user_id string, trans_date_trans_time string, merchant string, unix_time string, "
        "original_amt string, currency string, is_fraud string, category string")
    r = staging.stg_transactions(raw).first()
    assert r["transaction_datetime_UTC"] is None and r["unix_time_seconds"] is None
    assert r["original_amount"] is None and r["merchant_name"] == "m" and r["currency"] == "DKK"
    assert r["is_fraud"] is True and r["category"] == "food"


def test_dedup_keeps_latest_and_collapses_null_ids(spark):
    raw = spark.createDataFrame(
        [("1", "u", "2024-01-01 00:00:00", "m", 10, 1.0, "EUR", 0),
         ("1", "u", "2024-01-01 00:00:01", "m", 11, 2.0, "EUR", 0),
         (None, "u", "2024-01-01 00:00:00", "m", 10, 3.0, "EUR", 0),
         (None, "u", "2024-01-01 00:00:05", "m", 15, 4.0, "EUR", 0)],
        "trans_num string, user_id string, trans_date_trans_time string, merchant string, unix_time long, "
        "original_amt double, currency string, is_fraud int")
    got = {r["transaction_id"]: r["original_amount"] for r in staging.stg_transactions(raw).collect()}
    assert got == {"1": Decimal("2"), None: Decimal("4")}


def test_gender_and_dob(spark):
    raw = spark.createDataFrame(
        [(D(2024, 1, 1), None, "1", "a", "b", "m", "s", "c", 0, 1.0, 2.0, ("1990-05-01", None), "j"),
         (D(2024, 1, 1), "2024-01-01T00:00:00.5+00:00", "2", "a", "b", "F", "s", "c", 123, 1.0, 2.0, (None, "1980-01-01"), "j"),
         (D(2024, 1, 1), "garbage", "3", "a", "b", "X", "s", "c", 1, 1.0, 2.0, (None, None), "j"),
         (D(2024, 1, 1), None, "4", "a", "b", None, "s", "c", 1, 1.0, 2.0, None, "j")],
        "_airbyte_emitted_at timestamp, _ab_cdc_updated_at string, user_id string, first_name string, "
        "last_name string, gender string, street string, city string, zip int, lat double, long double, "
        "dob struct<member0:string,member1:string>, job string")
    got = {r["user_id"]: r for r in staging.stg_users_changes(raw).collect()}
    assert [got[k]["gender"] for k in "1234"] == ["Male", "Female", None, None]
    assert got["1"]["zip_code"] is None and got["2"]["zip_code"] == 123
    assert got["1"]["date_of_birth"] == dt.date(1990, 5, 1) and got["2"]["date_of_birth"] == dt.date(1980, 1, 1)
    assert got["3"]["date_of_birth"] is None and got["3"]["updated_at"] is None
    assert got["2"]["updated_at"] == D(2024, 1, 1, 0, 0, 0, 500000)


def test_dim_date_iso(spark):
    stg = spark.createDataFrame([(D(2024, 12, 29),), (D(2024, 12, 31),)], "transaction_datetime_UTC timestamp_ntz")
    d = {r["date_day"]: r for r in dims.dim_date(stg).collect()}
    assert d[dt.date(2024, 12, 29)]["day_of_week"] == 1 and d[dt.date(2024, 12, 29)]["day_name"] == "Sunday"
    assert d[dt.date(2024, 12, 30)]["iso_week_number"] == 1 and d[dt.date(2024, 12, 30)]["iso_year_number"] == 2025
    assert [d[k]["date_key"] for k in sorted(d)] == [1, 2, 3]
    assert d[dt.date(2024, 12, 30)]["month_name"] == "December"


def test_dim_time(spark):
    t = {r["time_key"]: r for r in dims.dim_time(spark).where(F.col("time_key").isin(0, 90507, 235959, 165959, 170000)).collect()}
    assert t[0]["part_of_day"] == "Night" and t[90507]["part_of_day"] == "Morning" and t[235959]["part_of_day"] == "Evening"
    assert t[90507]["time_of_day"] == "09:05:07" and t[90507]["hour_bucket"] == "09:00-09:59"
    assert t[165959]["is_business_hours"] is True and t[170000]["is_business_hours"] is False
    assert dims.dim_time(spark).count() == 86400


def test_scd2_boundaries(spark):
    ch = spark.createDataFrame(
        [("u", D(2024, 1, 1, 10), D(2024, 1, 1, 10), "v1"), ("u", D(2024, 1, 2, 10), D(2024, 1, 2, 10), "v2"),
         ("w", D(2024, 1, 3), D(2024, 1, 3), "a"), ("w", D(2024, 1, 3), D(2024, 1, 3), "b"),
         ("w", D(2024, 1, 3), D(2024, 1, 3), "b"), ("u", D(2024, 1, 2, 10), D(2024, 1, 2, 10), "v2")],
        "user_id string, updated_at timestamp, raw_loaded_at timestamp, job string")
    for c in ["first_name", "last_name", "gender", "address", "city_name", "date_of_birth"]:
        ch = ch.withColumn(c, F.lit(None).cast("date" if c == "date_of_birth" else "string"))
    ch = ch.withColumn("zip_code", F.lit(None).cast("bigint")).withColumn("latitude", F.lit(1.0)).withColumn("longitude", F.lit(1.0))
    hist = dims.dim_users_history(ch)
    from ledgerlake.plans.facts import fct_transactions
    tx = spark.createDataFrame(
        [("t1", "u", D(2024, 1, 2, 10)), ("t0", "u", D(2024, 1, 1, 9)), ("t2", "w", D(2024, 1, 4))],
        "transaction_id string, user_id string, transaction_datetime_UTC timestamp_ntz")
    for c, typ in [("merchant_name", "string"), ("unix_time_seconds", "bigint"), ("currency", "string"),
                   ("original_amount", "decimal(28,9)"), ("fx_rate_to_currency", "decimal(18,9)"),
                   ("fx_rate_timestamp_UTC", "timestamp_ntz"), ("amount_usd", "decimal(38,9)"), ("is_fraud", "boolean")]:
        tx = tx.withColumn(c, F.lit(None).cast(typ))
    dd = dims.dim_date(tx)
    out = fct_transactions(tx, hist, dd).collect()
    f = {r["transaction_id"]: r for r in out}
    v = {(r["user_id"], r["job"]): r["user_version_id"] for r in hist.collect()}
    assert sorted(r["user_id"] for r in dims.dim_users_current(hist).collect()) == ["u", "w"]
    assert f["t1"]["user_version_id"] == v[("u", "v2")]       # at valid_to: next version
    assert f["t0"]["user_version_id"] is None                 # before the first version
    assert len(out) == 3                                        # equal valid_from: no fan-out


def test_age_band(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(1999, 12, 31)), (dt.date(2024, 1, 1), None),
                                (None, dt.date(1990, 1, 1))], "d date, b date")
    assert [r[0] for r in df.select(X.age_band("d", "b")).collect()] == ["25-34", "Unknown", "55+"]


def test_kpi_null_usd(spark):
    fct = spark.createDataFrame([(1, "u", "m", Decimal("10"), True), (1, "u", "m", None, False)],
                                "date_key long, user_id string, merchant_name string, amount_usd decimal(38,9), is_fraud boolean")
    r = marts.mart_kpi_daily(fct).first()
    assert r["amount_usd_total"] == Decimal("10") and r["amount_usd_avg"] == Decimal("10") and r["txn_count"] == 2
    assert r["fraud_txn_count"] == 1 and r["fraud_rate"] == 0.5 and r["amount_usd_fraud_total"] == Decimal("10")


def test_uuid5_matches_python(spark):
    names = ["jane|doe", "customer|#00000001", "åsa|öberg", ""]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string")
           .select(X.uuid5(X.NAMESPACE_DNS, "n")).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]
    assert got[0] == "aed774fb-0ad4-5288-a887-7da351daaab9"


def test_segments_pre_aggregation_equals_direct(spark):
    m = Models(spark, SF001)
    fct, dd, uc = m.fct_transactions, m.dim_date, m.dim_users_current
    got = marts.mart_kpi_user_segments_daily(fct, dd, uc)
    e = (fct.join(dd.select("date_key", "date_day"), "date_key", "left")
            .join(uc.select("user_id", F.col("gender").alias("g"), "date_of_birth"), "user_id", "left")
            .withColumn("gender", F.coalesce("g", F.lit("Unknown")))
            .withColumn("age_band", X.age_band("date_day", "date_of_birth")))
    want = e.groupBy("date_key", "gender", "age_band").agg(*marts.kpi_aggs())
    cols = [c for c in want.columns]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in want.select(*cols).collect())
    assert a == b


def test_views_and_report_relationships(spark):
    from ledgerlake.plans import reports
    from ledgerlake.sources import io
    m = Models(spark, SF001)
    assert io.target_name("fraud_features", "features") == "feature_store.fraud_features_v1"
    active = reports.related(m, "mart_kpi_merchant_overall", "dim_date")
    inactive = reports.related(m, "mart_kpi_merchant_overall", "dim_date", use_inactive=True)
    a = {r["merchant_name"]: r["dim_date__date_key"] for r in active.collect()}
    b = {r["merchant_name"]: r["dim_date__date_key"] for r in inactive.collect()}
    first = {r["merchant_name"]: (r["first_date_key"], r["last_date_key"]) for r in m.mart_kpi_merchant_overall.collect()}
    assert all(a[k] == first[k][0] and b[k] == first[k][1] for k in first)


def test_numeric_division_rounds_once_half_away(spark):
    # T1: NUMERIC / NUMERIC rounded once to 9 digits, half away from zero
    df = spark.createDataFrame(
        [(Decimal("10"), Decimal("3")), (Decimal("2"), Decimal("3")), (Decimal("0.000000001"), Decimal("2")),
         (Decimal("-0.000000001"), Decimal("2")), (Decimal("0.000000001"), Decimal("3")),
         (Decimal("0.000000015"), Decimal("10"))],
        "a decimal(28,9), r decimal(18,9)")
    got = [r[0] for r in df.select(X.numeric_divide("a", "r")).collect()]
    assert got == [Decimal("3.333333333"), Decimal("0.666666667"), Decimal("1E-9"), Decimal("-1E-9"),
                   Decimal("0E-9"), Decimal("2E-9")]


def test_null_time_rate_is_ignored(spark):
    # T4: a rate without a fetch time never wins
    from ledgerlake.plans import facts
    tx = spark.createDataFrame([("t", "EUR", D(2024, 1, 1, 12), Decimal("1"))],
                               "transaction_id string, currency string, transaction_datetime_UTC timestamp_ntz, "
                               "original_amount decimal(28,9)")
    fx = spark.createDataFrame([(None, "EUR", Decimal("9")), (D(2024, 1, 1), "EUR", Decimal("2"))],
                               "datetime_fetched_UTC timestamp_ntz, transaction_currency string, rate decimal(18,9)")
    import spec
    for form in (facts.int_transactions_fx_enriched, spec.nearest_rate):
        r = form(tx, fx).first()
        assert r["fx_rate_to_currency"] == Decimal("2")


def test_version_key_text_and_null_parts(spark):
    # T10: md5 of 'user|yyyy-MM-dd HH:mm:ss.SSSSSS'; T16: a NULL part makes the key NULL
    import hashlib
    df = spark.createDataFrame([("u", D(2024, 1, 1, 10, 0, 0, 5))], "user_id string, v timestamp")
    got = df.select(X.surrogate_key("user_id", F.date_format("v", X.VERSION_TS_FORMAT))).first()[0]
    assert got == hashlib.md5(b"u|2024-01-01 10:00:00.000005").hexdigest()
    assert df.select(X.surrogate_key("user_id", F.lit(None).cast("string"))).first()[0] is None


def test_is_weekend_null_without_date(spark):
    # T13: no calendar row -> is_weekend NULL, not false
    from ledgerlake.plans import features
    m = Models(spark, SF001)
    fct = m.fct_transactions.limit(3).withColumn("date_key", F.lit(None).cast("bigint"))
    e = features.enrich(fct, m.dim_date, m.dim_time, m.dim_merchants)
    assert all(r["is_weekend"] is None for r in e.collect())


def test_models_from_given_raw_tables(spark):
    from ledgerlake.sources import tables as T
    a = Models(spark, SF001)
    b = Models.from_raw(spark, T.raw_transactions(spark, SF001), T.raw_fx_rates(spark, SF001),
                        T.raw_users(spark, SF001), T.raw_merchants(spark, SF001))
    cols = a.mart_kpi_daily.columns
    assert sorted(tuple(r) for r in a.mart_kpi_daily.select(*cols).collect()) == \
        sorted(tuple(r) for r in b.mart_kpi_daily.select(*cols).collect())


def test_update_time_needs_t_and_offset(spark):
    raw = spark.createDataFrame(
        [("2024-01-01T10:00:00.5+00:00",), ("2024-01-01T10:00:00+02:00",), ("2024-01-01 10:00:00+00:00",),
         ("2024-01-01T10:00:00",), ("2024-01-01T10:00:00Z",), ("junk",)], "s string")
    got = [r[0] for r in raw.select(staging._iso_offset_timestamp(F.col("s"))).collect()]
    assert got[0] == D(2024, 1, 1, 10, 0, 0, 500000) and got[1] == D(2024, 1, 1, 8)
    assert got[2:] == [None, None, None, None]


def test_fixture_sanity_counts(spark):
    # the sanity numbers FIXTURES.md reports from an independent run (sf0.001)
    m = Models(spark, SF001)
    fct = m.fct_transactions
    assert m.stg_transactions.count() == 1000
    assert m.int_transactions_fx_enriched.where("fx_rate_to_currency is not null").count() == 800
    assert m.stg_transactions.where("is_fraud").count() == 201
    assert fct.where("user_version_id is not null").count() == 952
    assert m.dim_users_current.count() == 15 and m.dim_date.count() == 30
    assert fct.groupBy("merchant_name").count().agg(F.max("count")).first()[0] == 117
