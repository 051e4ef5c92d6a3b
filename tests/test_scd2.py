import random
import time

from pyspark.sql import functions as F

from ledgerlake.operators.scd2 import as_of_left_join, versions

CH = "k string, t timestamp, loaded timestamp, v string"


def at(x):
    import datetime as dt
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=x)


def history(spark, changes, bucket=86_400):
    df = spark.createDataFrame(changes, CH)
    return versions(df, "k", "t", ["loaded", F.xxhash64("v")], "until", bucket)


def test_repeated_change_rows(spark):
    """A row landed three times: two empty versions and one that lasts; one open version, one row per fact."""
    hist = history(spark, [("u", at(1), at(2), "a")] * 3 + [("u", at(30), at(31), "b")] * 2 + [("w", at(5), at(5), "c")])
    got = sorted((r["k"], r["v"], r["t"], r["until"]) for r in hist.where("until is not null").collect())
    assert got == [("u", "a", at(1), at(1)), ("u", "a", at(1), at(1)), ("u", "a", at(1), at(30)),
                   ("u", "b", at(30), at(30))]
    assert sorted((r["k"], r["v"]) for r in hist.where("until is null").collect()) == [("u", "b"), ("w", "c")]
    facts = spark.createDataFrame([(1, "u", at(0)), (2, "u", at(1)), (3, "u", at(29)), (4, "u", at(30)), (5, "u", at(900)),
                                   (6, None, at(3)), (7, "w", None), (8, "x", at(3)), (9, "w", at(900))],
                                  "id long, key string, at timestamp")
    dim = hist.select(F.col("k").alias("kk"), "t", "until", "v")
    out = as_of_left_join(facts, "key", F.col("at"), dim, "kk", "t", "until", 86_400).collect()
    assert sorted((r["id"], r["v"]) for r in out) == [(1, None), (2, "a"), (3, "a"), (4, "b"), (5, "b"), (6, None),
                                                      (7, None), (8, None), (9, "c")]


def test_equals_interval_join(spark):
    rng = random.Random(3)
    changes = [(rng.choice("abc"), at(rng.randint(0, 3000)), at(rng.randint(0, 9)), str(i)) for i in range(200)]
    changes += rng.choices(changes, k=60)
    hist = history(spark, changes, 40_000).cache()
    facts = spark.createDataFrame([(i, rng.choice("abcd"), at(rng.randint(-10, 3300))) for i in range(500)],
                                  "id long, key string, at timestamp")
    dim = hist.select(F.col("k").alias("kk"), "t", "until", "v")
    got = as_of_left_join(facts, "key", F.col("at"), dim, "kk", "t", "until", 100_000).collect()
    want = facts.join(dim, (facts["key"] == dim["kk"]) & (F.col("at") >= F.col("t"))
                      & (F.col("until").isNull() | (F.col("at") < F.col("until"))), "left").collect()
    key = lambda rows: sorted((r["id"], str(r["v"])) for r in rows)
    assert key(got) == key(want) and len(got) == 500


def test_one_hot_entity_is_linear(spark):
    """One user with n changes and n facts: twice as many rows take about twice as long, not four times."""
    def run(n):
        ch = spark.range(n).select(F.lit("u").alias("k"), F.timestamp_seconds(F.col("id") * 600).alias("t"),
                                   F.timestamp_seconds(F.col("id") * 600).alias("loaded"), F.col("id").cast("string").alias("v"))
        hist = versions(ch, "k", "t", ["loaded"], "until")
        facts = spark.range(n).select("id", F.lit("u").alias("key"), F.timestamp_seconds(F.col("id") * 600 + 5).alias("at"))
        dim = hist.select(F.col("k").alias("kk"), "t", "until", "v")
        t0 = time.time()
        bad = as_of_left_join(facts, "key", F.col("at"), dim, "kk", "t", "until").where(
            "v is null or v <> cast(id as string)").count()
        assert bad == 0
        return time.time() - t0
    run(1_000)
    small, large = run(20_000), run(80_000)
    assert large < 20 and large < 8 * max(small, 0.5)
