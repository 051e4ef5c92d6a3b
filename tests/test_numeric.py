"""NUMERIC division against Python decimals: 9 digits, rounded once, half away from zero."""

import random
from decimal import ROUND_HALF_UP, Decimal, getcontext

from pyspark.sql import functions as F

from ledgerlake.functions import exprs as X

NANO = Decimal("0.000000001")


def expected(a, b):
    getcontext().prec = 80
    return (a / b).quantize(NANO, rounding=ROUND_HALF_UP)   # half away from zero: the sign is kept apart


def test_numeric_divide_random(spark):
    rng = random.Random(0)
    pairs = [("3.874224135", "8.765432101"), ("9.999999994", "9.999999999"), ("114427251100.405694147", "1.144272511"),
             ("0", "5"), ("-1", "3"), ("1", "-3"), ("-2", "-3"), ("0.000000001", "2"), ("-0.000000001", "2"),
             ("9999999999999999999.999999999", "0.000000001"), ("1", "999999999.999999999")]
    for _ in range(400):
        a = rng.randint(-10 ** rng.randint(1, 28), 10 ** rng.randint(1, 28))
        b = rng.randint(1, 10 ** rng.randint(1, 18) - 1) * rng.choice([1, -1])
        pairs.append((str(Decimal(a) * NANO), str(Decimal(b) * NANO)))
    rows = [(Decimal(a), Decimal(b)) for a, b in pairs]
    rows = [(a, b) for a, b in rows if abs(a) < Decimal(10) ** 19 and abs(a / b) < Decimal(10) ** 28]
    df = spark.createDataFrame(rows, "a decimal(28,9), b decimal(18,9)")
    got = df.select("a", "b", X.numeric_divide("a", "b").alias("q")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["q"] == expected(r["a"], r["b"]), r
    one = spark.sql("select cast(null as decimal(28,9)) a, cast(2 as decimal(18,9)) b")
    assert one.select(X.numeric_divide("a", "b")).first()[0] is None


def test_decimal_avg_random(spark):
    rng = random.Random(1)
    rows = [(Decimal(rng.randint(-10 ** 20, 10 ** 20)) * NANO, rng.randint(1, 10 ** 6)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s decimal(38,9), n long")
    for r in df.select("s", "n", X.decimal_avg("s", "n").alias("q")).collect():
        assert r["q"] == expected(r["s"], Decimal(r["n"])), r
    assert df.limit(1).select(X.decimal_avg(F.col("s"), F.lit(0))).first()[0] is None


def test_numeric_divide_beside_a_boundary(spark):
    """Quotients as near as they come to half a unit of the ninth digit, on both sides of it, of small and large numbers."""
    rng, rows = random.Random(2), []
    for _ in range(300):
        b = rng.randrange(1, 10 ** rng.randint(1, 14), 2)
        if b % 5 == 0:
            continue
        for r in (-1, 0, 1):                     # 2 * 10^9 * a = r (mod b)
            a = r * pow(2 * 10 ** 9, -1, b) % b + b * rng.choice([0, 1, 999, 10 ** 6, 10 ** 11])
            rows += [(Decimal(s * a).scaleb(-9), Decimal(b).scaleb(-9)) for s in (1, -1)]
    df = spark.createDataFrame(rows, "a decimal(28,9), b decimal(18,9)")
    for r in df.select("a", "b", X.numeric_divide("a", "b").alias("q")).collect():
        assert r["q"] == expected(r["a"], r["b"]), r


def test_usd_amounts_are_compiled(spark):
    """the rows' code stays under the JVM's limit (8,000 bytes a method), beyond which it is interpreted for good."""
    import re

    from ledgerlake.plans.facts import int_transactions_fx_enriched
    tx = spark.createDataFrame([], "transaction_id string, currency string, original_amount decimal(28,9), "
                               "transaction_datetime_UTC timestamp_ntz")
    fx = spark.createDataFrame([], "transaction_currency string, datetime_fetched_UTC timestamp_ntz, rate decimal(18,9)")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = int_transactions_fx_enriched(tx, fx)
        text = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8_000, sizes
