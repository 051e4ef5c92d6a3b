"""MD23: split a wide transaction export into events, users and merchants.

The export has one row per transaction with the card holder's and the
merchant's attributes repeated.  The user key is a version-5 UUID of
``lower(strip(first)) | lower(strip(last))``; users and merchants keep the
first row per key in export order (``row_number`` over the explicit order,
planned as a partial group limit before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.exprs import NAMESPACE_DNS, uuid5
from ledgerlake.operators.topk import latest_per_key
from ledgerlake.sources import io
from ledgerlake.sources.tables import read_table

WIDE_SCHEMA = T.StructType([
    T.StructField("trans_date_trans_time", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("zip", T.LongType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("job", T.StringType()),
    T.StructField("dob", T.StringType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("is_fraud", T.LongType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
    T.StructField("merch_zipcode", T.DoubleType()),
])

# The columns of the three output files
EVENT_COLUMNS = ["trans_date_trans_time", "user_id", "merchant", "category", "amt", "trans_num", "unix_time",
                 "is_fraud"]
USER_COLUMNS = ["user_id", "first_name", "last_name", "gender", "street", "city", "zip", "lat", "long", "job",
                "dob"]
MERCHANT_COLUMNS = ["merchant", "merch_lat", "merch_long", "merch_zipcode"]


def wide_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test input: the wide export built from the driver tables (one row per
    event; customer as card holder, supplier as merchant)."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    n_sup = supplier.select(F.count(F.lit(1))).scalar()
    e = (events.join(supplier, supplier["s_suppkey"] == (F.col("event_id") * 7 + F.col("user_id")) % n_sup)
               .join(customer, customer["c_custkey"] == events["user_id"], "left")
               .join(nation, nation["n_nationkey"] == customer["c_nationkey"], "left"))
    return e.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("trans_date_trans_time"),
        F.concat(F.lit("fraud_"), F.col("s_name")).alias("merchant"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amt"),
        F.lit(" Customer").alias("first"),
        F.right(F.col("c_name"), F.lit(9)).alias("last"),
        F.when(F.col("user_id") % 2 == 0, "M").otherwise("F").alias("gender"),
        # quotes, delimiters, a line break and backslashes, as free text has them
        F.concat(F.lit("Street "), F.col("user_id").cast("string"),
                 F.when(F.col("user_id") % 5 == 0, ' "a; b", c\n\\d "" \\').otherwise("")).alias("street"),
        F.col("n_name").alias("city"),
        (10000 + F.col("user_id")).cast("bigint").alias("zip"),
        (F.col("c_acctbal") / 1000).alias("lat"),
        (-F.col("c_acctbal") / 500).alias("long"),
        F.when(F.col("user_id") % 7 == 0, "").otherwise("Engineer").alias("job"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((F.col("user_id") * 37) % 20000).cast("int"))
        .cast("string").alias("dob"),
        F.col("event_id").cast("string").alias("trans_num"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("unix_time"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint").alias("is_fraud"),
        (F.col("s_acctbal") / 200).alias("merch_lat"),
        (-F.col("s_acctbal") / 100).alias("merch_long"),
        F.when(F.col("s_suppkey") % 8 == 0, F.lit(None).cast("double"))
        .otherwise((10000 + F.col("s_suppkey")).cast("double")).alias("merch_zipcode"),
    )


def keyed(wide: DataFrame) -> DataFrame:
    """User key (FS10/FS11), renames (PRJ4) and zip fill (PRJ6)."""
    key = F.concat(F.lower(F.trim(F.col("first"))), F.lit("|"), F.lower(F.trim(F.col("last"))))
    return (wide.withColumn("user_id", uuid5(NAMESPACE_DNS, key))
                .withColumnRenamed("first", "first_name").withColumnRenamed("last", "last_name")
                .withColumn("merch_zipcode", F.coalesce(F.col("merch_zipcode"), F.lit(0.0)).cast("bigint")))


def split_events(k: DataFrame) -> DataFrame:
    return k.select(*EVENT_COLUMNS)


def _first_per(k: DataFrame, key: str, cols: list[str]) -> DataFrame:
    # export order: transaction time then transaction number
    ordered = k.withColumn("__ord", F.struct(F.col("unix_time"), F.col("trans_num")))
    return latest_per_key(ordered, [key], [F.col("__ord").asc()]).select(*cols)


def split_users(k: DataFrame) -> DataFrame:
    return _first_per(k, "user_id", USER_COLUMNS)


def split_merchants(k: DataFrame) -> DataFrame:
    return _first_per(k, "merchant", MERCHANT_COLUMNS)


def run_split(spark: SparkSession, wide_path: str, out_root: str) -> dict[str, str]:
    """Read the comma-separated export, write the three ';' files."""
    k = keyed(io.read_delimited(spark, wide_path, WIDE_SCHEMA, sep=",", multi_line=True))
    outs = {}
    for name, df in (("events", split_events(k)), ("users", split_users(k)), ("merchants", split_merchants(k))):
        path = f"{out_root.rstrip('/')}/{name}"
        io.write_delimited(df, path, sep=";")
        outs[name] = path
    return outs
