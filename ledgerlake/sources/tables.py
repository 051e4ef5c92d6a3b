"""Driver tables and the raw landing frames derived from them.

The reference lands four raw tables (transactions, fx_rates, users change
log, merchants).  The test environment provides generic tables instead; the
rules below map those onto the raw schemas (see FIXTURES.md section B).  Each
raw frame is a plain projection/join of the driver tables, so its size grows
with the scale factor and Catalyst prunes unused columns down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Fixed values of the fixture mapping (FIXTURES.md section B).
TX_CURRENCIES = ["dkk", "NOK", "SEK", "eur", "USD"]      # by event_id % 5
FX_CURRENCIES = ["DKK", "nok", "SEK", "EUR"]             # by event_id % 4
USER_GENDERS = ["M", "f", "X"]                           # by user_id % 3
REINGEST_EVERY = 10      # every 10th event is landed twice, one second later
RELAND_EVERY = 9         # the change log delivers every 9th row (by event_id) twice, unchanged


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card events as the stream consumer lands them (one row per message).

    10 % of the events are landed a second time one second later, which is
    what the staging de-duplication has to resolve.
    """
    events = read_table(spark, sf_dir, "events")
    supplier = read_table(spark, sf_dir, "supplier")
    landed = events.withColumn("dup", F.lit(0)).unionByName(
        events.where(F.col("event_id") % REINGEST_EVERY == 0).withColumn("dup", F.lit(1)))
    n_suppliers = supplier.select(F.count(F.lit(1))).scalar()
    sup = supplier.select(F.col("s_suppkey"), F.col("s_name"))
    joined = landed.join(
        sup, sup["s_suppkey"] == (F.col("event_id") * 7 + F.col("user_id")) % n_suppliers)
    ts = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("dup"))
    return joined.select(
        F.col("event_id").cast("string").alias("trans_num"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("trans_date_trans_time"),
        F.concat(F.lit("fraud_"), F.col("s_name")).alias("merchant"),
        F.col("event_type").alias("category"),
        (F.unix_timestamp(F.col("ts").cast("timestamp")) + F.col("dup")).alias("unix_time"),
        F.col("value").alias("original_amt"),
        _pick(TX_CURRENCIES, F.col("event_id") % 5).alias("currency"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_fraud"),
    )


def raw_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX snapshots: one row per (fetch time, quoted currency), units per USD; every event is a quote."""
    return read_table(spark, sf_dir, "events").select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("timestamp"),
        F.lit("usd").alias("base_currency"),
        _pick(FX_CURRENCIES, F.col("event_id") % 4).alias("currency"),
        (F.lit(0.5) + F.col("value") / 100).alias("rate"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User change log (CDC rows), several versions per user; some rows are delivered twice."""
    return _user_changes(spark, sf_dir).drop("event_id", "ts")


def _user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``raw_users`` with the event they come from."""
    events = read_table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    events = events.unionByName(events.where(F.col("event_id") % RELAND_EVERY == 0))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    e = events.join(customer, customer["c_custkey"] == events["user_id"]).join(
        nation, nation["n_nationkey"] == customer["c_nationkey"])
    dob_day = F.date_add(F.lit("1950-01-01").cast("date"),
                         ((F.col("user_id") * 37) % 20000).cast("int")).cast("string")
    null_s = F.lit(None).cast("string")
    dob = (F.when(F.col("user_id") % 11 == 0, F.struct(null_s.alias("member0"), null_s.alias("member1")))
           .when(F.col("user_id") % 2 == 0, F.struct(dob_day.alias("member0"), null_s.alias("member1")))
           .otherwise(F.struct(null_s.alias("member0"), dob_day.alias("member1"))))
    return e.select(
        "event_id", "ts",
        (F.col("ts").cast("timestamp") + F.expr("INTERVAL 1 MINUTE")).alias("_airbyte_emitted_at"),
        F.when(F.col("event_id") % 17 == 0, null_s).otherwise(
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
        ).alias("_ab_cdc_updated_at"),
        F.col("user_id").cast("string").alias("user_id"),
        F.lit("Customer").alias("first_name"),
        F.right(F.col("c_name"), F.lit(9)).alias("last_name"),
        _pick(USER_GENDERS, F.col("user_id") % 3).alias("gender"),
        F.concat(F.lit("Street "), F.col("user_id").cast("string")).alias("street"),
        F.col("n_name").alias("city"),
        F.when(F.col("event_id") % 7 == 0, F.lit(0)).otherwise(10000 + F.col("event_id") % 90000).alias("zip"),
        (F.col("c_acctbal") / 1000).alias("lat"),
        (-F.col("c_acctbal") / 500).alias("long"),
        dob.alias("dob"),
        F.get_json_object("props", "$.k").alias("job"),
    )


def raw_users_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user changes as log entries (SRC10): the rows of ``raw_users`` with a position, an operation and old keys.  Every
    13th change is a delete (no row, only the old key), every 29th gives its user a new id, and some are delivered twice."""
    e, n, uid = _user_changes(spark, sf_dir), F.col("event_id"), F.col("user_id")
    op = F.when(n % 13 == 0, "D").when(n % 29 == 0, "U").when(n % 4 == 0, "I").otherwise("U")
    gone, moved = op == "D", (n % 13 != 0) & (n % 29 == 0)
    row = [c for c in e.columns if c not in ("event_id", "ts", "user_id")]
    return e.select(n.alias("lsn"), op.alias("op"), F.col("ts").cast("timestamp").alias("committed_at"),
                    F.when(gone | moved, uid).alias("old_key"),
                    F.when(moved, F.concat(F.lit("9"), uid)).when(~gone, uid).alias("user_id"),
                    *[F.when(~gone, F.col(c)).alias(c) for c in row])


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier")
    return supplier.select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("_airbyte_emitted_at"),
        F.concat(F.lit("fraud_"), F.col("s_name")).alias("merchant"),
        (F.col("s_acctbal") / 200).alias("merch_lat"),
        F.when(F.col("s_suppkey") % 9 == 0, F.lit(None).cast("double"))
        .otherwise(-F.col("s_acctbal") / 100).alias("merch_long"),
        F.when(F.col("s_suppkey") % 8 == 0, F.lit(0)).otherwise(10000 + F.col("s_suppkey")).alias("merch_zipcode"),
    )


class RawInputs:
    """The four raw landing tables: derived from a driver-table folder, or
    given directly (``tables``: transactions / fx_rates / users / merchants
    DataFrames, e.g. the landed stream and snapshot folders)."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, tables: dict | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables = tables or {}

    def _get(self, name: str, derive) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        return derive(self.spark, self.sf_dir)

    @property
    def transactions(self) -> DataFrame:
        return self._get("transactions", raw_transactions)

    @property
    def fx_rates(self) -> DataFrame:
        return self._get("fx_rates", raw_fx_rates)

    @property
    def users(self) -> DataFrame:
        return self._get("users", raw_users)

    @property
    def merchants(self) -> DataFrame:
        return self._get("merchants", raw_merchants)
