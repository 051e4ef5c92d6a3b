"""Split (key, time bucket) window operators against Spark's frame windows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import spec
from helpers import SF001, rows
from ledgerlake.operators import rolling
from ledgerlake.plans import features
from ledgerlake.plans.models import Models


def _frames(df, keys, widths):
    out = df
    for lab, w in widths.items():
        win = Window.partitionBy(*keys).orderBy("t").rangeBetween(-w, -1)
        out = (out.withColumn(f"c_{lab}", F.count(F.lit(1)).over(win))
                  .withColumn(f"s_{lab}", F.sum("v").over(win))
                  .withColumn(f"m_{lab}", F.max("v").over(win)))
    return out


def _split(df, keys, widths, bucket):
    out = rolling.prior_window_aggs(df, keys, "t", "v", widths, bucket_seconds=bucket, prefix="p")
    for lab in widths:
        out = (out.withColumnRenamed(f"p_cnt_{lab}", f"c_{lab}").withColumnRenamed(f"p_sum_{lab}", f"s_{lab}")
                  .withColumnRenamed(f"p_max_{lab}", f"m_{lab}").drop(f"p_nn_{lab}"))
    return out


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.StringType()),
                       T.StructField("t", T.LongType()), T.StructField("v", T.DecimalType(28, 9))])


def test_edges(spark):
    # same second, frame edge (t + W counts, t + W + 1 not), first event, NULL time and value
    W = 100
    data = [(1, "a", 1000, Decimal("1")), (2, "a", 1000, Decimal("2")), (3, "a", 1100, Decimal("4")),
            (4, "a", 1101, None), (5, "a", 1201, Decimal("8")), (6, "a", None, Decimal("16")),
            (7, "a", None, Decimal("32")), (8, None, 5, Decimal("1")), (9, None, 50, Decimal("1")),
            (10, "b", 0, Decimal("3"))]
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["id"]: r for r in _split(df, ["k"], {"w": W}, 50).collect()}
    want = {r["id"]: r for r in _frames(df, ["k"], {"w": W}).collect()}
    for i in want:
        assert (got[i]["c_w"], got[i]["s_w"], got[i]["m_w"]) == (want[i]["c_w"], want[i]["s_w"], want[i]["m_w"]), i
    assert got[1]["c_w"] == 0 and got[1]["s_w"] is None          # same second excluded, first event
    assert got[3]["c_w"] == 2                                       # t + W includes the events at t
    assert got[5]["c_w"] == 1                                       # t + W + 1 excludes them


@pytest.mark.parametrize("bucket", [10, 25, 50, 100])
def test_random_against_frames(spark, bucket):
    import random
    rnd = random.Random(bucket)
    data = []
    for i in range(3000):
        k = rnd.choice(["hot"] * 6 + ["x", "y", None])
        t = rnd.randint(0, 2000) if rnd.random() > 0.01 else None
        v = None if rnd.random() < 0.05 else Decimal(rnd.randint(0, 10000)) / 100
        data.append((i, k, t, v))
    df = spark.createDataFrame(data, SCHEMA)
    widths = {"a": 100, "b": 400}
    cols = ["id", "c_a", "s_a", "m_a", "c_b", "s_b", "m_b"]
    assert rows(_split(df, ["k"], widths, bucket).select(*cols)) == rows(_frames(df, ["k"], widths).select(*cols))


def test_prior_event_time_matches_lag(spark):
    import random
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = [(str(i), rnd.choice(["u1", "u2", "u3", None]),
             None if rnd.random() < 0.02 else base + dt.timedelta(seconds=rnd.randint(0, 30000)))
            for i in range(2000)]
    df = spark.createDataFrame(data, "id string, k string, ts timestamp")
    got = rolling.prior_event_time(df, ["k"], "ts", "id", "prev", bucket_seconds=600)
    want = df.withColumn("prev", F.lag("ts").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("bucket", [600, 3600, 86400])
def test_fraud_features_equal_frames(spark, bucket):
    m = Models(spark, SF001).build(Models.SHARED)
    got = features.fraud_features(m.fct_transactions, m.dim_date, m.dim_time, m.dim_merchants, bucket)
    assert rows(got) == rows(spec.fraud_features(m.fct_transactions, m.dim_date, m.dim_time, m.dim_merchants))


def test_neighbour_next_matches_lead(spark):
    import random
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    data = [(str(i), rnd.choice(["u1", "u2", None]), rnd.randint(0, 3),
             None if rnd.random() < 0.02 else base + dt.timedelta(seconds=rnd.randint(0, 5000)))
            for i in range(1500)]
    df = spark.createDataFrame(data, "id string, k string, r int, ts timestamp")
    got = rolling.neighbour_time(df, ["k"], "ts", ["r", "id"], "nxt", "next", bucket_seconds=300)
    want = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "r", "id")))
    assert rows(got) == rows(want)


def test_fraud_features_one_hot_user(spark):
    # a third of the rows on one user
    m = Models(spark, SF001).build(Models.SHARED)
    fct = m.fct_transactions.withColumn(
        "user_id", F.when(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0, F.lit("hot-user"))
        .otherwise(F.col("user_id")))
    split = features.fraud_features(fct, m.dim_date, m.dim_time, m.dim_merchants)
    frames = spec.fraud_features(fct, m.dim_date, m.dim_time, m.dim_merchants)
    assert rows(split) == rows(frames)


def test_fraud_features_hot_user_and_merchant_sf001(spark):
    # sf0.01 with a third of the rows on one user and a quarter on one
    # merchant; split == frames
    from helpers import SF01
    m = Models(spark, SF01).build(Models.SHARED)
    fct = (m.fct_transactions
           .withColumn("user_id", F.when(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0, F.lit("hot-user"))
                       .otherwise(F.col("user_id")))
           .withColumn("merchant_name", F.when(F.pmod(F.xxhash64("transaction_id", F.lit(1)), F.lit(4)) == 0,
                                               F.lit("hot-merchant")).otherwise(F.col("merchant_name"))))
    split = features.fraud_features(fct, m.dim_date, m.dim_time, m.dim_merchants)
    frames = spec.fraud_features(fct, m.dim_date, m.dim_time, m.dim_merchants)
    assert rows(split) == rows(frames)


def test_rows_are_dealt_once_for_window_and_summary(spark):
    """The join with the buckets' summary keeps the windows' exchange, though keys may be NULL and nothing is broadcast."""
    df = spark.createDataFrame([(1, None, 1000, Decimal("1")), (2, "a", 1100, None)], SCHEMA)
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        aggs = rolling.prior_window_aggs(df, ["k"], "t", "v", {"w": 100}, 50)
        last = rolling.prior_event_time(df.withColumn("ts", F.timestamp_seconds("t")), ["k"], "ts", "id", "prev")
        # rows; the summary by bucket, by key, and to the rows
        assert [q._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for q in (aggs, last)] == [4, 4]
        assert {r["id"]: r["__pw_cnt_w"] for r in aggs.collect()} == {1: 0, 2: 0}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_scores_are_made_once(spark, monkeypatch):
    """MC1: both thresholds read one written table of scores."""
    from types import SimpleNamespace

    from ledgerlake.plans import ml
    made = spark.sql("SELECT concat('t', id) transaction_id, true predicted_is_fraud, "
                     "array(struct(true AS label, id / 10D AS prob)) predicted_is_fraud_probs FROM range(10)")
    monkeypatch.setattr(ml, "scored", lambda rows, model: made)
    out = ml.threshold_counts(SimpleNamespace(spark=spark, fraud_features_serving=None))
    assert {(r["threshold"], r["predicted_fraud"]): r["row_count"] for r in out.collect()} == {
        (0.1, True): 9, (0.1, False): 1, (0.45, True): 5, (0.45, False): 5}
    assert len({f for f in out.inputFiles() if "fraud_scores" in f}) > 0
