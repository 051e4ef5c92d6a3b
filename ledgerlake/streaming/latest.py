"""ST7: the latest row of each transaction, kept as the rows arrive.

Staging keeps, of all landed copies of a transaction, the one with the latest
time.  As a stream, keyed state holds only the order key of the best row so far;
a row that beats it is emitted as a change, any other one is not.  State of a
transaction that has been silent for ``ttl_seconds`` is dropped by a timer, so it
grows with the copies in flight, not with all transactions ever seen.

Transactions are dealt into hash buckets, and a bucket's order keys and times of
last sight are one state value: Python is called once per bucket and micro-batch,
on whole columns, not once per transaction.  A micro-batch rewrites the state of
the buckets it touches.

Changes are written by micro-batch, and a batch that is replayed after a failure
overwrites its own folder.  Readers take the best change of each transaction, so
a copy that comes after its state was dropped does no harm either: the result is
that of the batch model (MD1), whatever the order of arrival and the restarts.

Rows travel through the state function as text, which gives every value back as it was (NULLs and exact decimals too).

Defined cases: a NULL transaction id is one key, as in the batch model; NULL times come last; equal rows emit once; an empty
landing emits nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.plans.staging import latest_landing, typed_transactions

LOWEST = -(1 << 63)
BUCKETS = 1024


def _ordered(typed: DataFrame) -> DataFrame:
    """The columns as text, with the order key of the batch model as three numbers."""
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in typed.columns])
    low = F.lit(LOWEST).cast("bigint")
    return typed.select(
        *[F.col(c).cast("string").alias(c) for c in typed.columns],
        F.coalesce(F.unix_micros(F.col("transaction_datetime_UTC").cast("timestamp")), low).alias("__time"),
        F.coalesce("unix_time_seconds", low).alias("__unix"), tie.alias("__tie"))


def _keep_latest(ttl_ms: int, columns: list[str]):
    order = ["__time", "__unix", "__tie"]

    def newest(rows):
        """One row per transaction, the best one."""
        return rows.sort_values(order, kind="stable").drop_duplicates("transaction_id", keep="last")

    def run(key, batches, state):
        now = state.getCurrentProcessingTimeMs()
        if state.exists:
            known = pa.ipc.open_stream(state.get[0]).read_all()
            ids, best = known.column(0).to_pandas().astype(object), np.column_stack([c.to_numpy() for c in known.columns[1:]])
        else:
            ids, best = pd.Series([], dtype=object), np.zeros((0, 4), np.int64)
        if not state.hasTimedOut:
            rows, waiting = None, []
            for pdf in batches:     # in pieces: a hot key is never one frame
                waiting.append(pdf)
                if sum(map(len, waiting)) > max(50_000, 0 if rows is None else len(rows)):
                    rows, waiting = newest(pd.concat(([] if rows is None else [rows]) + waiting)), []
            rows = newest(pd.concat(([] if rows is None else [rows]) + waiting))
            code, _ = pd.factorize(pd.concat([ids, rows["transaction_id"].astype(object)]), use_na_sentinel=False)
            place = np.full(code.max() + 1, -1)
            place[code[:len(ids)]] = np.arange(len(ids))
            at, mine = place[code[len(ids):]], rows[order].to_numpy(np.int64)
            better, equal = at < 0, at >= 0
            for i in range(3):
                old = best[at[equal], i]
                better[equal] = mine[equal, i] > old
                equal[equal] = mine[equal, i] == old
            gone = np.ones(len(ids), bool)      # silent in this batch
            gone[at[at >= 0]] = False
            gone &= best[:, 3] + ttl_ms <= now
            best[at[at >= 0], 3] = now
            best[at[better & (at >= 0)], :3] = mine[better & (at >= 0)]
            new = at < 0
            ids = pd.concat([ids[~gone], rows["transaction_id"][new]])
            best = np.concatenate([best[~gone], np.column_stack([mine[new], np.full(new.sum(), now)])])
            if better.any():
                yield rows[better][columns]
        else:
            gone = best[:, 3] + ttl_ms <= now
            ids, best = ids[~gone], best[~gone]
        if not len(ids):
            state.remove()
            return
        table = pa.table([pa.array(ids, pa.string(), from_pandas=True), *[pa.array(best[:, i]) for i in range(4)]], names=list("ituhs"))
        blob = pa.BufferOutputStream()
        with pa.ipc.new_stream(blob, table.schema) as writer:
            writer.write_table(table)
        state.update((blob.getvalue().to_pybytes(),))
        state.setTimeoutDuration(int(max(1, best[:, 3].min() + ttl_ms - now)))
    return run


def start_latest(spark: SparkSession, raw: DataFrame, sink: str, checkpoint: str, ttl_seconds: int = 86_400,
                 available_now: bool = False, flush_seconds: int = 600, buckets: int = BUCKETS) -> StreamingQuery:
    """Stage the landed stream ``raw``; changes go to ``sink/batch=N``.  ``buckets`` is fixed for a checkpoint's life."""
    rows = _ordered(typed_transactions(raw))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    bucket = F.pmod(F.xxhash64("transaction_id"), F.lit(buckets))
    changes = rows.withColumn("__bucket", bucket).groupBy("__bucket").applyInPandasWithState(
        _keep_latest(ttl_seconds * 1000, rows.columns), schema, "known binary", "update", "ProcessingTimeTimeout")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={number}")

    w = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{flush_seconds} seconds")
    # timers run with the next rows; a drain would otherwise wait for ever for timers of empty batches
    empty_batches = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(empty_batches)
    spark.conf.set(empty_batches, "false")
    try:
        return w.start()
    finally:
        spark.conf.set(empty_batches, before)


def read_changes(spark: SparkSession, sink: str) -> DataFrame:
    """All changes, with their micro-batch."""
    return spark.read.parquet(sink)


def current_rows(spark: SparkSession, sink: str, like: DataFrame) -> DataFrame:
    """The best change of each transaction, with the columns and types of ``like`` (the typed rows)."""
    typed = read_changes(spark, sink).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])
    return latest_landing(typed)
