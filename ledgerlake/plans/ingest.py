"""Ingest-side jobs over the driver tables: file round trips, FX landing,
source split, event replay and landing, user updates.

Each function takes (spark, sf_dir, scratch) and returns the DataFrame the
job produced, read back from what it wrote, so the whole write path is
exercised.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import checkpoint_dir
from ledgerlake.sources import changelog, io, prep
from ledgerlake.sources.tables import FX_CURRENCIES, raw_fx_rates, raw_transactions, raw_users, raw_users_log
from ledgerlake.streaming import landing

RAW_TX_SCHEMA = T.StructType([
    T.StructField("trans_num", T.StringType()), T.StructField("user_id", T.StringType()),
    T.StructField("trans_date_trans_time", T.StringType()), T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("unix_time", T.LongType()),
    T.StructField("original_amt", T.DoubleType()), T.StructField("currency", T.StringType()),
    T.StructField("is_fraud", T.IntegerType()),
])


def scratch(spark: SparkSession, job: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/runs/{job}-{uuid.uuid4().hex[:10]}"


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2 then SRC1: raw transactions to ';' files and back with a schema.
    Some categories hold quotes, delimiters, line breaks or backslashes, some
    are empty, some NULL."""
    path = scratch(spark, "csv") + "/transactions"
    nth, text = F.col("trans_num").cast("bigint") % 20, F.col("category")
    odd = (F.when(nth == 0, F.concat(F.lit('say "hi"; '), text, F.lit('\n"second"; line')))
           .when(nth == 1, "").when(nth == 2, F.concat(F.lit('\\ back\\"slash '), text, F.lit("\\")))
           .when(nth == 3, F.concat(F.lit(" ;"), text, F.lit(" "))).when(nth == 4, None).otherwise(text))
    io.write_delimited(raw_transactions(spark, sf_dir).withColumn("category", odd), path, sep=";")
    return io.read_delimited(spark, path, RAW_TX_SCHEMA, sep=";", multi_line=True)


def fx_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The FX client's responses as landed text: one JSON ``{currency: rate}``
    map with the four quoted currencies per fetch."""
    r = raw_fx_rates(spark, sf_dir)
    quotes = [x for i, c in enumerate(FX_CURRENCIES) for x in (F.lit(c), F.col("rate") + i)]
    return r.select("timestamp", F.to_json(F.create_map(*quotes)).alias("payload"))


def fx_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD24: payload to rows (SRC7), appended under year/month/day (SRC6)."""
    path = scratch(spark, "fx") + "/fx_rates"
    io.write_dated_snapshot(io.fx_payload_rows(fx_payloads(spark, sf_dir)), path)
    return spark.read.parquet(path)


def source_split(spark: SparkSession, sf_dir: str, part: str) -> DataFrame:
    """MD23: wide export (',' CSV) split into events / users / merchants (';' CSV)."""
    root = scratch(spark, "split")
    io.write_delimited(prep.wide_export(spark, sf_dir), root + "/wide", sep=",")
    outs = prep.run_split(spark, root + "/wide", root + "/out")
    schema = {"events": prep_schema(prep.EVENT_COLUMNS), "users": prep_schema(prep.USER_COLUMNS),
              "merchants": prep_schema(prep.MERCHANT_COLUMNS)}[part]
    return io.read_delimited(spark, outs[part], schema, sep=";", multi_line=True)


_SPLIT_TYPES = {"amt": T.DoubleType(), "unix_time": T.LongType(), "is_fraud": T.LongType(), "zip": T.LongType(),
                "lat": T.DoubleType(), "long": T.DoubleType(), "merch_lat": T.DoubleType(),
                "merch_long": T.DoubleType(), "merch_zipcode": T.LongType()}


def prep_schema(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _SPLIT_TYPES.get(c, T.StringType())) for c in cols])


def prepared_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file the replay reads (MD23's events output)."""
    return prep.split_events(prep.keyed(prep.wide_export(spark, sf_dir)))


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5 on the prepared events (batch form of the producer's transform)."""
    return landing.enrich_event(prepared_events(spark, sf_dir))


def event_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8."""
    return landing.preview(enriched_events(spark, sf_dir))


def run_stream(spark: SparkSession, sf_dir: str, again: bool = False) -> str:
    """MD25 end to end: replay (ST6) -> messages -> landing (ST1-ST4, SRC5), both
    as checkpointed streams drained with availableNow; returns the landing
    folder.  Bad messages are sent along: broken JSON and empty ones.  With
    ``again`` every tenth event is replayed a second time, a minute later."""
    root = scratch(spark, "stream")
    events = prepared_events(spark, sf_dir)
    nth = F.col("trans_num").cast("bigint")
    if again:
        events = events.unionByName(events.where(nth % 10 == 0).withColumn("unix_time", F.col("unix_time") + 60))
    io.write_delimited(events, root + "/events_csv", sep=";")
    prod = landing.start_producer(spark, root + "/events_csv", root + "/topic", root + "/ckpt/producer",
                                  available_now=True)
    prod.awaitTermination()
    bad = prepared_events(spark, sf_dir).where(nth % 25 < 2).select(
        F.when(nth % 25 == 0, F.concat(F.lit("{broken "), "trans_num")).otherwise("").alias("value"))
    bad.write.text(root + "/other_producer")   # the topic folder is the sink of the replay stream alone
    messages = landing.read_messages(spark, "files", root + "/topic").unionAll(
        landing.read_messages(spark, "files", root + "/other_producer"))
    landing.start_consumer(spark, messages, root + "/landing", root + "/ckpt/consumer",
                           available_now=True).awaitTermination()
    return root + "/landing"


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD25: the landed events without the processing-date column."""
    return landing.read_landing(spark, run_stream(spark, sf_dir)).drop("ingest_date")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4: the messages that could not be decoded."""
    return landing.read_quarantine(spark, run_stream(spark, sf_dir)).select("value")


def user_updates(spark: SparkSession, sf_dir: str, run_ts: str = "2024-02-01T00:00:00",
                 salt: str = "run-1", fraction: float = 0.01) -> DataFrame:
    """MD26: one update run's change rows."""
    from ledgerlake.plans.updates import user_update_changes
    return user_update_changes(raw_users(spark, sf_dir), run_ts, salt, fraction)


def published_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC11/SRC13 then SRC16: the fact table written as a routed warehouse
    table (partitioned by date_key) and scanned back by name."""
    from ledgerlake.plans.models import Models
    m = Models(spark, sf_dir)
    name = io.materialize_table(spark, m.fct_transactions, "fct_transactions", "marts",
                                root=scratch(spark, "warehouse"), partition_by=["date_key"])
    return io.read_table(spark, name)


def staged_from_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 end to end: events replayed and landed by the stream (MD25), then
    staged by MD1 straight from the landing folder, as the warehouse reads
    its landed batches."""
    from ledgerlake.plans.staging import stg_transactions
    return stg_transactions(landing.read_landing(spark, run_stream(spark, sf_dir, again=True)).drop("ingest_date"))


def stateful_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 as a stream: transactions land in two parts, in no order; the stream keeps the latest of each, is stopped in
    between and goes on from its checkpoint."""
    from ledgerlake.plans.staging import typed_transactions
    from ledgerlake.streaming import latest
    root, raw = scratch(spark, "latest"), raw_transactions(spark, sf_dir)
    part = F.pmod(F.xxhash64(*raw.columns), F.lit(2))
    for n in range(2):
        raw.where(part == n).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(raw.schema).parquet(f"{root}/landed")
        latest.start_latest(spark, stream, f"{root}/changes", f"{root}/checkpoint", available_now=True).awaitTermination()
    return latest.current_rows(spark, f"{root}/changes", typed_transactions(raw))


def group_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: two consumer groups over one topic folder that arrives in two parts; group ``late`` has read the first only."""
    root = scratch(spark, "groups")
    events, even = enriched_events(spark, sf_dir), F.col("trans_num").cast("bigint") % 2 == 0
    for part, groups in ((even, ("all", "late")), (~even, ("all",))):
        landing.to_messages(events.where(part)).write.mode("append").text(f"{root}/topic")
        for g in groups:
            landing.start_consumer(spark, landing.read_messages(spark, path=f"{root}/topic"), f"{root}/landed/{g}",
                                   landing.group_checkpoint(f"{root}/checkpoints", g), available_now=True).awaitTermination()
    counts = None
    for g in ("all", "late"):
        one = landing.read_landing(spark, f"{root}/landed/{g}").agg(
            F.count("*").alias("events"), F.sum("is_fraud").cast("bigint").alias("fraud_events")).withColumn("group", F.lit(g))
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(landing.group_progress(spark, f"{root}/checkpoints").drop("offsets"), "group").withColumnRenamed(
        "group", "consumer_group")


def applied_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10: the users left by the change log, landed as three batches that each hold every third position (so the second
    and third come late) and applied one by one onto the stored state."""
    root, log = scratch(spark, "change-log"), raw_users_log(spark, sf_dir)
    log.withColumn("batch", (2 - F.col("lsn") % 3).cast("int")).write.partitionBy("batch").parquet(f"{root}/landed")
    landed, state = spark.read.parquet(f"{root}/landed"), None
    for batch in range(3):
        part = landed.where(F.col("batch") == batch).select(*log.columns)
        changelog.replay(part, "user_id", state).write.parquet(f"{root}/state-{batch}")
        state = spark.read.parquet(f"{root}/state-{batch}")
    return changelog.open_rows(state).select("user_id", "lsn", "first_name", "last_name", "gender", "street", "city", "zip", "lat",
                                             "long", "job")


def log_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10 / MD10: user versions from the change log, ended by changes, deletes and moves."""
    return changelog.user_history(raw_users_log(spark, sf_dir)).drop("raw_loaded_at", "updated_at")
