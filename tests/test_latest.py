"""ST7: staging by keyed state equals staging by batch, over restarts, late copies and timeouts."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.ingest import RAW_TX_SCHEMA
from ledgerlake.plans.staging import stg_transactions, typed_transactions
from ledgerlake.streaming import latest


def landed(n=120, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        key = rng.choice([f"t{rng.randrange(30)}", f"t{rng.randrange(30)}", "hot", None])
        when = rng.choice([None, f"2024-01-0{rng.randint(1, 9)} 00:00:0{rng.randint(0, 9)}"])
        rows.append((key, "7", when, "fraud_m", rng.choice(["a", "b"]), rng.choice([None, rng.randint(1, 5)]),
                     rng.choice([None, 0.1, 2.25]), rng.choice(["eur", None]), rng.choice([0, 1, None])))
    return rows + rows[::9]


def run(spark, root, rows, ttl=86_400, order=None):
    """Land the rows as further files, and let the stream catch up (a restart each time)."""
    spark.createDataFrame(rows, RAW_TX_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/landed")
    stream = spark.readStream.schema(RAW_TX_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
    latest.start_latest(spark, stream, f"{root}/changes", f"{root}/ckpt", ttl, available_now=True).awaitTermination()
    like = typed_transactions(spark.createDataFrame([], RAW_TX_SCHEMA))
    return latest.current_rows(spark, f"{root}/changes", like)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_restarts_and_any_order(spark, tmp_path):
    rows = landed()
    random.Random(1).shuffle(rows)
    for part in (rows[:50], rows[50:100], rows[100:]):
        got = run(spark, tmp_path, part)
    assert rows_of(got) == rows_of(stg_transactions(spark.createDataFrame(rows, RAW_TX_SCHEMA)))


def test_only_changes_are_emitted(spark, tmp_path):
    first = [("a", "7", "2024-01-02 00:00:00", "m", "c", 5, 1.0, "eur", 0), ("b", "7", "2024-01-01 00:00:00", "m", "c", 5, 1.0, "eur", 0)]
    older = [("a", "7", "2024-01-01 00:00:00", "m", "c", 9, 1.0, "eur", 0), first[1]]
    newer = [("a", "7", "2024-01-03 00:00:00", "m", "c", 1, 3.0, "eur", 1)]
    for part in (first, older, newer):
        got = run(spark, tmp_path, part)
    changes = latest.read_changes(spark, f"{tmp_path}/changes")
    assert Counter(r["transaction_id"] for r in changes.collect()) == {"a": 2, "b": 1}
    assert {r["transaction_id"]: float(r["original_amount"]) for r in got.collect()} == {"a": 3.0, "b": 1.0}


def test_late_copy_after_the_timer(spark, tmp_path):
    row = ("a", "7", "2024-01-02 00:00:00", "m", "c", 5, 1.0, "eur", 0)
    run(spark, tmp_path, [row], ttl=1)
    time.sleep(2)
    run(spark, tmp_path, [("z", *row[1:])], ttl=1)      # the timer of "a" runs in this batch
    got = run(spark, tmp_path, [("a", "7", "2024-01-01 00:00:00", "m", "c", 5, 9.0, "eur", 0)], ttl=1)
    changes = latest.read_changes(spark, f"{tmp_path}/changes")
    assert changes.where("transaction_id = 'a'").count() == 2      # emitted again, as its state was gone
    assert got.where("transaction_id = 'a'").select(F.col("original_amount").cast("double")).first()[0] == 1.0


def test_state_is_kept_by_bucket(spark, tmp_path):
    """3,000 transactions, each with a better and a worse copy: few calls into Python, many pieces, every timer on its own."""
    rows = [(f"t{i}", "7", f"2024-01-0{d} 00:00:00", "m", "c", d, 1.5, "eur", 0) for i in range(3000) for d in (2, 3, 1)]
    spark.createDataFrame(rows, RAW_TX_SCHEMA).write.parquet(f"{tmp_path}/landed")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        query = latest.start_latest(spark, spark.readStream.schema(RAW_TX_SCHEMA).parquet(f"{tmp_path}/landed"),
                                    f"{tmp_path}/changes", f"{tmp_path}/ckpt", available_now=True)
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= latest.BUCKETS
    changes = latest.read_changes(spark, f"{tmp_path}/changes")
    assert Counter(r["unix_time_seconds"] for r in changes.collect()) == {"3": 3000}


def test_timer_of_each_transaction_in_one_bucket(spark, tmp_path):
    """A silent transaction is forgotten though its bucket is not; one that is seen again is not."""
    def land(*rows):
        spark.createDataFrame([(k, "7", f"2024-01-0{d} 00:00:00", "m", "c", 5, 1.0, "eur", 0) for k, d in rows],
                              RAW_TX_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
        stream = spark.readStream.schema(RAW_TX_SCHEMA).parquet(f"{tmp_path}/landed")
        latest.start_latest(spark, stream, f"{tmp_path}/changes", f"{tmp_path}/ckpt", 30, available_now=True,
                            buckets=1).awaitTermination()
    land(("a", 5), (None, 5))
    time.sleep(31)
    land((None, 4), ("z", 5))
    land((None, 4), ("a", 4), ("z", 4))
    changes = latest.read_changes(spark, f"{tmp_path}/changes")
    assert Counter(r["transaction_id"] for r in changes.collect()) == {"a": 2, None: 1, "z": 1}
