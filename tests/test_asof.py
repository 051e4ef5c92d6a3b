"""JN1 nearest as-of join: edge cases and linear form == ranked join."""

import datetime as dt
import random
from decimal import Decimal

import pytest

import spec
from helpers import rows
from ledgerlake.plans import facts

TX = "transaction_id string, currency string, transaction_datetime_UTC timestamp_ntz, original_amount decimal(28,9)"
FX = "datetime_fetched_UTC timestamp_ntz, transaction_currency string, rate decimal(18,9)"
D = dt.datetime


def enrich(spark, tx, fx, linear, bucket=86400):
    txd, fxd = spark.createDataFrame(tx, TX), spark.createDataFrame(fx, FX)
    return facts.int_transactions_fx_enriched(txd, fxd, bucket_seconds=bucket) if linear else spec.nearest_rate(txd, fxd)


@pytest.mark.parametrize("linear", [True, False])
def test_edge_cases(spark, linear):
    tx = [("tie", "EUR", D(2024, 1, 1, 12, 0, 10), Decimal("10")),
          ("sub", "SEK", D(2024, 1, 1, 12, 0, 10), Decimal("10")),
          ("nomatch", "JPY", D(2024, 1, 1, 12, 0, 10), Decimal("10")),
          ("zero", "NOK", D(2024, 1, 1, 12, 0, 10), Decimal("10")),
          ("usd", "USD", D(2024, 1, 1, 12, 0, 10), Decimal("5"))]
    fx = [(D(2024, 1, 1, 12, 0, 5), "EUR", Decimal("2")), (D(2024, 1, 1, 12, 0, 15), "EUR", Decimal("4")),
          (D(2024, 1, 1, 12, 0, 15, 100000), "SEK", Decimal("2")),
          (D(2024, 1, 1, 12, 0, 15, 900000), "SEK", Decimal("8")),
          (D(2024, 1, 1, 12, 0, 0), "NOK", Decimal("0"))]
    got = {r["transaction_id"]: r for r in enrich(spark, tx, fx, linear).collect()}
    assert got["tie"]["fx_rate_timestamp_UTC"] == D(2024, 1, 1, 12, 0, 15)      # later wins a tie
    assert got["sub"]["fx_rate_to_currency"] == Decimal("8")                    # sub-second tie: later
    assert got["nomatch"]["fx_rate_to_currency"] is None and got["nomatch"]["amount_usd"] is None
    assert got["zero"]["fx_rate_to_currency"] == 0 and got["zero"]["amount_usd"] is None
    assert got["usd"]["amount_usd"] == Decimal("5") and got["usd"]["fx_rate_to_currency"] is None
    assert len(got) == 5


@pytest.mark.parametrize("seed,bucket", [(1, 86400), (2, 3600), (3, 600)])
def test_linear_equals_ranked_join(spark, seed, bucket):
    rnd = random.Random(seed)
    t0 = D(2024, 1, 1)
    fx = []
    for c in ["EUR", "SEK", "NOK"]:
        for _ in range(rnd.randint(1, 60)):
            fx.append((t0 + dt.timedelta(seconds=rnd.randint(0, 5 * 86400), microseconds=rnd.choice([0, 0, 1, 500000, 999999])),
                       c, Decimal(rnd.randint(1, 1000)) / 100))
    fx.append((t0 + dt.timedelta(seconds=100), "EUR", Decimal("1.5")))   # exact-second duplicate times
    fx.append((t0 + dt.timedelta(seconds=100), "EUR", Decimal("1.7")))
    tx = [(str(i), rnd.choice(["EUR", "SEK", "NOK", "USD", "DKK"]),
           (t0 + dt.timedelta(seconds=rnd.randint(-86400, 6 * 86400))) if rnd.random() > 0.02 else None,
           Decimal(rnd.randint(1, 100000)) / 100) for i in range(1500)]
    a = enrich(spark, tx, fx, True, bucket).select("transaction_id", "fx_rate_timestamp_UTC")
    b = enrich(spark, tx, fx, False).select("transaction_id", "fx_rate_timestamp_UTC")
    assert rows(a) == rows(b)


def test_single_rate_and_null_time(spark):
    tx = [("a", "EUR", None, Decimal("1")), ("b", "EUR", D(2030, 1, 1), Decimal("1"))]
    fx = [(D(2024, 1, 1), "EUR", Decimal("2"))]
    for linear in (True, False):
        got = {r["transaction_id"]: r["fx_rate_to_currency"] for r in enrich(spark, tx, fx, linear).collect()}
        assert got == {"a": Decimal("2"), "b": Decimal("2")}


def test_fractional_left_times_stay_exact(spark):
    rnd = random.Random(21)
    t0 = D(2024, 1, 1)
    fx = [(t0 + dt.timedelta(seconds=rnd.randint(0, 3000), microseconds=rnd.choice([0, 250000, 999999])),
           "EUR", Decimal(rnd.randint(1, 500)) / 100) for _ in range(60)]
    tx = [(str(i), "EUR", t0 + dt.timedelta(seconds=rnd.randint(0, 3200),
                                            microseconds=rnd.choice([0, 0, 100000, 500000, 900000])),
           Decimal("1")) for i in range(600)]
    a = enrich(spark, tx, fx, True, 600).select("transaction_id", "fx_rate_timestamp_UTC")
    b = enrich(spark, tx, fx, False).select("transaction_id", "fx_rate_timestamp_UTC")
    assert rows(a) == rows(b)


def test_a_third_of_the_facts_without_time_or_currency(spark):
    """They take the currency's last quote, or none, and do not meet in one partition."""
    from pyspark.sql import functions as F

    from ledgerlake.operators import asof
    rnd, t0 = random.Random(5), D(2024, 1, 1)
    fx = [(t0 + dt.timedelta(seconds=rnd.randint(0, 90_000), microseconds=rnd.choice([0, 400000])), c, Decimal(rnd.randint(1, 900)) / 100)
          for c in ("EUR", "SEK") for _ in range(40)]
    tx = [(str(i), None if i % 3 == 1 else rnd.choice(["EUR", "SEK", "JPY"]),
           None if i % 3 == 0 else t0 + dt.timedelta(seconds=rnd.randint(-900, 99_000)), Decimal("1")) for i in range(900)]
    a = enrich(spark, tx, fx, True, 3600).select("transaction_id", "fx_rate_timestamp_UTC")
    assert rows(a) == rows(enrich(spark, tx, fx, False).select("transaction_id", "fx_rate_timestamp_UTC"))
    left = spark.createDataFrame(tx, TX)
    points = asof._last_of_seconds(spark.createDataFrame(fx, FX), "transaction_currency", "datetime_fetched_UTC", {"rate": "rate"})
    plan = asof._whole_seconds(left, points, "currency", "transaction_datetime_UTC", {"rate": "rate"}, 3600)
    assert plan.count() == 900
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(asof.SPREAD))
    assert left.where("transaction_datetime_UTC is null").select(salt.alias("s")).distinct().count() > asof.SPREAD // 2
