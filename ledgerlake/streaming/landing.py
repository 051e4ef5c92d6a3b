"""Transaction stream: replay producer and landing consumer (ST1-ST8, MD25).

Producer (ST5, ST6): the prepared events file is replayed as a stream; each
event gets a currency and its amount in that currency, and is published as a
JSON message (a Kafka topic, or a folder of text files where Kafka is not
available).  Progress is the streaming checkpoint, so a restart resumes
exactly where it stopped.

Consumer (ST1-ST4, SRC5): messages are decoded with an explicit schema in
PERMISSIVE mode; those that are no events go to a quarantine partition instead of
ending the stream.  Events land as Parquet under ``status=landed/ingest_date=``
(the UTC processing date).  Spark's file sink commits each micro-batch atomically
through its metadata log, so a failed batch is replayed and nothing is lost
or written twice.  ``trigger`` is a processing-time interval (600 s by
default) or ``availableNow`` to drain and stop (the final flush).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.sources.io import READ_DIALECT

# The replay's static USD value of one unit of each currency.
EXCHANGE_RATES = {"EUR": 1.17, "DKK": 0.16, "SEK": 0.11, "NOK": 0.10}
FLUSH_SECONDS = 600
CORRUPT = "_corrupt_record"

EVENT_SCHEMA = T.StructType([
    T.StructField("trans_date_trans_time", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("is_fraud", T.LongType()),
])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("trans_date_trans_time", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("is_fraud", T.LongType()),
    T.StructField("original_amt", T.DoubleType()),
    T.StructField("currency", T.StringType()),
])


def pick_currency(key: Column) -> Column:
    """FR1, reproducibly: a hash of the transaction number picks one of the
    quoted currencies (in the map's order)."""
    codes = list(EXCHANGE_RATES)
    idx = F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(len(codes)))
    return F.element_at(F.array(*[F.lit(c) for c in codes]), (idx + 1).cast("int"))


def enrich_event(events: DataFrame) -> DataFrame:
    """ST5: add currency and original_amt = usd_amt / rate[currency] (JN11,
    FM5), drop the USD amount.  A stateless projection: runs the same on a
    stream or a batch."""
    rates = F.create_map(*[x for k, v in EXCHANGE_RATES.items() for x in (F.lit(k), F.lit(v))])
    with_ccy = events.withColumn("currency", pick_currency(F.col("trans_num")))
    return with_ccy.select(
        *[c for c in events.columns if c != "amt"],
        (F.col("amt") / F.element_at(rates, F.col("currency"))).alias("original_amt"),
        "currency")


def to_messages(df: DataFrame) -> DataFrame:
    """FJ2 / SRC4: one JSON object per row in a ``value`` column."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def publish_batch(df: DataFrame, servers: str, topic: str = "transactions") -> None:
    """SRC4 for a batch: rows as JSON messages to a Kafka topic (needs the
    Kafka connector on the cluster; not available in the test container)."""
    to_messages(df).write.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).save()


def decode_messages(raw: DataFrame) -> DataFrame:
    """ST4: explicit-schema decode.  The event's columns, the message's ``key`` and
    ``value``, and ``status``: 'quarantine' for a payload that is no event
    (broken JSON, an empty message, a NULL one), else 'landed'."""
    schema = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    key = F.col("key") if "key" in raw.columns else F.lit(None)
    parsed = raw.select(F.from_json(F.col("value"), schema,
                                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("m"),
                        key.cast("string").alias("key"), "value")
    empty = F.col("value").isNull() | (F.trim("value") == "")
    bad = empty | F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()
    return parsed.select("m.*", "key", "value", F.when(bad, "quarantine").otherwise("landed").alias("status")) \
        .drop(CORRUPT)


def read_event_files(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """ST6: the prepared ';' events file(s) as a stream, up to ``max_files`` per micro-batch."""
    return (spark.readStream.schema(EVENT_SCHEMA).options(**READ_DIALECT).option("sep", ";").option("header", True)
            .option("maxFilesPerTrigger", max_files).csv(path))


def read_messages(spark: SparkSession, source: str = "files", path: str | None = None,
                  servers: str | None = None, topic: str = "transactions", group: str | None = None) -> DataFrame:
    """SRC3 / ST1: the message stream from Kafka (earliest offsets, optionally
    under a consumer group's name) or a folder."""
    if source == "kafka":
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("subscribe", topic).option("startingOffsets", "earliest"))
        r = r.option("kafka.group.id", group) if group else r
        return r.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    return spark.readStream.format("text").load(path)


def _trigger(w, available_now: bool, seconds: int):
    return w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{seconds} seconds")


def start_producer(spark: SparkSession, events_path: str, sink: str, checkpoint: str,
                   available_now: bool = True, servers: str | None = None,
                   topic: str = "transactions", max_files: int = 1_000) -> StreamingQuery:
    """Replay events to the topic (Kafka) or to a text folder."""
    msgs = to_messages(enrich_event(read_event_files(spark, events_path, max_files)))
    w = msgs.writeStream.option("checkpointLocation", checkpoint)
    if servers:
        w = w.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
        return _trigger(w, available_now, 1).start()
    return _trigger(w.format("text"), available_now, 1).start(sink)


def start_consumer(spark: SparkSession, messages: DataFrame, sink: str, checkpoint: str, available_now: bool = False,
                   flush_seconds: int = FLUSH_SECONDS) -> StreamingQuery:
    """ST1-ST3 + SRC5: events by UTC processing date under ``sink/status=landed``,
    the rest, with key and text, under ``sink/status=quarantine``: one read, one
    sink and one commit per micro-batch for both."""
    landed = F.col("status") == "landed"
    out = decode_messages(messages).withColumns({
        "key": F.when(~landed, F.col("key")), "value": F.when(~landed, F.col("value")),
        "ingest_date": F.to_date(F.current_timestamp())})
    w = out.writeStream.format("parquet").partitionBy("status", "ingest_date").option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, flush_seconds).start(sink)


def group_checkpoint(root: str, group: str) -> str:
    """ST1: each consumer group reads the whole stream at its own pace, from a checkpoint of its own."""
    return f"{root.rstrip('/')}/group={group}"


def group_progress(spark: SparkSession, root: str) -> DataFrame:
    """ST1: (group, batches, offsets): the committed micro-batches of each group under a checkpoint root, and the source
    offsets (JSON) up to which the last of them has read.  A batch that was planned but not committed does not count."""
    def log(kind: str) -> DataFrame:
        name = F.regexp_extract(F.col("_metadata.file_path"), rf"group=([^/]*)/{kind}/(\d+)$", 0)
        text = spark.read.text(f"{root.rstrip('/')}/group=*/{kind}/[0-9]*", wholetext=True).withColumn("__name", name)
        return text.where("__name <> ''").select(
            F.regexp_extract("__name", rf"group=([^/]*)/", 1).alias("group"),
            F.regexp_extract("__name", r"(\d+)$", 1).cast("bigint").alias("batch"), F.col("value"))
    done = log("commits").groupBy("group").agg(F.max("batch").alias("batch"), F.count("*").alias("batches"))
    planned = log("offsets").withColumn("offsets", F.array_join(F.slice(F.split("value", "\n"), 3, 100), "\n"))
    return done.join(planned, ["group", "batch"]).select("group", "batches", "offsets")


def serve(spark: SparkSession, messages, sink: str, checkpoint: str, stop, flush_seconds: int = FLUSH_SECONDS,
          poll_seconds: float = 1.0) -> None:
    """ST2: land until ``stop`` (a ``threading.Event``) is set, then flush: what has arrived by then is landed as a last
    drain from the same checkpoint, so nothing that was there is left unread.  ``messages``: a function that gives the
    stream.  An error of the query is raised here."""
    query = start_consumer(spark, messages(), sink, checkpoint, flush_seconds=flush_seconds)
    try:
        while not stop.wait(poll_seconds):
            if not query.isActive:
                break
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    start_consumer(spark, messages(), sink, checkpoint, available_now=True).awaitTermination()


def preview(events: DataFrame) -> DataFrame:
    """ST8: the monitoring fields, currency defaulting to USD."""
    return events.select("trans_date_trans_time", "user_id", "merchant", "category",
                         F.col("original_amt").alias("amount"),
                         F.coalesce(F.col("currency"), F.lit("USD")).alias("currency"), "is_fraud")


def batch_summary(batch: DataFrame) -> DataFrame:
    """Per micro-batch monitoring figures (ST8): events, fraud flags and
    amount by currency (currency defaulting to USD)."""
    return (batch.groupBy(F.coalesce(F.col("currency"), F.lit("USD")).alias("currency"))
            .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("is_fraud")).alias("fraud_events"),
                 F.sum("original_amt").alias("original_amount")))


def start_monitor(spark: SparkSession, messages: DataFrame, path: str, checkpoint: str,
                  available_now: bool = False, flush_seconds: int = FLUSH_SECONDS) -> StreamingQuery:
    """ST8 as a stream: each micro-batch's summary goes to ``path/batch_id=N``.
    Writing by batch id with overwrite makes a replayed batch idempotent."""
    decoded = decode_messages(messages).where("status = 'landed'")

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch_summary(batch).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}"))

    w = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, flush_seconds).start()


def read_landing(spark: SparkSession, path: str, since: str | None = None,
                 until: str | None = None) -> DataFrame:
    """Landed events for a range of processing dates; the status and the bounds
    prune folders before any file is opened."""
    df = spark.read.parquet(path).where("status = 'landed'").drop("status", "key", "value")
    if since:
        df = df.where(F.col("ingest_date") >= F.lit(since).cast("date"))
    if until:
        df = df.where(F.col("ingest_date") <= F.lit(until).cast("date"))
    return df


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Messages that are no events: (key, value, ingest_date)."""
    return spark.read.parquet(path).where("status = 'quarantine'").select("key", "value", "ingest_date")


def main(argv: list[str] | None = None) -> None:
    """Run the landing consumer as a long-lived service.

    python -m ledgerlake.streaming.landing --source files --path <topic dir> \\
        --landing <dir> --checkpoint <dir> [--flush-seconds 600] [--drain]
    (``--source kafka --servers host:9092 --topic transactions [--group name]``
    with the Kafka connector on the cluster.)
    """
    import argparse
    import signal
    import threading

    from ledgerlake.session import build_session

    p = argparse.ArgumentParser(prog="ledgerlake.streaming.landing")
    p.add_argument("--source", choices=["files", "kafka"], default="files")
    p.add_argument("--path")
    p.add_argument("--servers")
    p.add_argument("--topic", default="transactions")
    p.add_argument("--group")
    p.add_argument("--landing", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--flush-seconds", type=int, default=FLUSH_SECONDS)
    p.add_argument("--drain", action="store_true", help="process what is there and stop (availableNow)")
    a = p.parse_args(argv)
    spark = build_session(app="ledgerlake-landing")
    checkpoint = group_checkpoint(a.checkpoint, a.group) if a.group else a.checkpoint

    def messages() -> DataFrame:
        return read_messages(spark, a.source, a.path, a.servers, a.topic, a.group)
    if a.drain:
        start_consumer(spark, messages(), a.landing, checkpoint, available_now=True).awaitTermination()
        return
    stop = threading.Event()
    for s in (signal.SIGTERM, signal.SIGINT):
        signal.signal(s, lambda *_: stop.set())
    serve(spark, messages, a.landing, checkpoint, stop, a.flush_seconds)


if __name__ == "__main__":
    main()
