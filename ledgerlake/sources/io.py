"""Sources and sinks (SRC1-SRC16).

Everything goes through Spark's readers and writers with explicit schemas, so
types cannot drift between files and reads are split across tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.quality import FailedChecks, ObservedChecks

# --- delimited files (SRC1, SRC2) ---------------------------------------------


# The dialect pandas and Postgres write: a quote inside a value is doubled, a
# backslash is an ordinary character, NULL is an empty field and the empty
# string a quoted one.  (When reading, NULL needs a token that no field holds, or
# the empty string would be taken for it.)
DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
READ_DIALECT = {**DIALECT, "nullValue": "\u0001null", "emptyValue": "", "mode": "PERMISSIVE"}
WRITE_DIALECT = {**DIALECT, "nullValue": "", "emptyValue": '""'}


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                   header: bool = True, multi_line: bool = False) -> DataFrame:
    """SRC1: ``read_csv(path, sep)`` / ``COPY ... DELIMITER ';' CSV HEADER`` with an
    explicit schema (no inference pass over the data).  ``multi_line`` where
    values may hold line breaks: a file is then read by one task."""
    return (spark.read.schema(schema).options(**READ_DIALECT).option("sep", sep).option("header", header)
            .option("multiLine", multi_line).csv(path))


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True,
                    mode: str = "overwrite") -> None:
    """SRC2: ``to_csv(path, sep, index=False)``; one file per task."""
    df.write.mode(mode).options(**WRITE_DIALECT).option("sep", sep).option("header", header).csv(path)


# --- FX payloads (SRC7, SRC6) ---------------------------------------------------

FX_BASE = "USD"


def fx_payload_rows(payloads: DataFrame, ts_col: str = "timestamp", payload_col: str = "payload") -> DataFrame:
    """SRC7: a JSON ``{currency: rate}`` payload per fetch to one row per
    (timestamp, base, currency, rate)."""
    rates = F.from_json(F.col(payload_col), T.MapType(T.StringType(), T.DoubleType()))
    return payloads.select(F.col(ts_col).alias("timestamp"), F.lit(FX_BASE).alias("base_currency"),
                           F.explode(rates).alias("currency", "rate"))


def with_date_parts(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    ts = F.try_to_timestamp(F.col(ts_col))
    return (df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))
              .withColumn("day", F.dayofmonth(ts)))


def write_dated_snapshot(df: DataFrame, path: str, ts_col: str = "timestamp") -> None:
    """SRC6: append under ``year=/month=/day=`` of the fetch time.  Hive-style
    folders let readers prune partitions by date; rows are gathered by date
    first (AQE splits large dates), so a date gets few files per run."""
    with_date_parts(df, ts_col).hint("rebalance", "year", "month", "day").write.mode("append").partitionBy("year", "month", "day").parquet(path)


# --- warehouse tables (SRC8, SRC11-SRC13, SRC16) ------------------------------------

# Schema routing of the model folders and the versioned
# feature-store aliases.
SCHEMA_ROUTES = {"staging": "staging", "intermediate": "analytics", "marts": "analytics",
                 "features": "feature_store", "predictions": "analytics_ml"}
ALIASES = {"fraud_features": "fraud_features_v1", "fraud_features_serving": "fraud_features_v1_serving",
           "fraud_predictions": "fraud_predictions_v1"}


def target_name(model: str, layer: str) -> str:
    """SRC13: the custom schema is used as is (no target prefix); aliases
    give versioned names."""
    return f"{SCHEMA_ROUTES[layer]}.{ALIASES.get(model, model)}"


def materialize_table(spark: SparkSession, df: DataFrame, model: str, layer: str, root: str,
                      partition_by: list[str] | None = None, checks: ObservedChecks | None = None) -> str:
    """SRC11: full-refresh table (create or replace as select) stored under
    ``root/<schema>/<table>/<version>`` (a shared location, not the driver's
    folder).  The new version is written whole before the table is pointed to
    it, so readers never see a missing or half-written table and a failed run
    leaves the old one.  ``checks`` are counted by the write itself; where one
    fails, the new version is deleted and the old one stays (FailedChecks)."""
    name = target_name(model, layer)
    schema, table = name.split(".")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{root.rstrip('/')}/{schema}'")
    if partition_by:
        # gather rows by the partition columns before the write so each task
        # writes few, large files; AQE splits a hot partition value
        df = df.hint("rebalance", *partition_by)
    path = f"{root.rstrip('/')}/{schema}/{table}/{uuid.uuid4().hex}"
    if checks is not None:
        df = checks.watch(df)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    if checks is not None:
        try:
            checks.enforce()
        except FailedChecks:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            raise
    _point_table(spark, name, path, spark.read.parquet(path), partition_by or [])
    return name


def _point_table(spark: SparkSession, name: str, path: str, written: DataFrame, partition_by: list[str]) -> None:
    """Make the table a scan of ``path``; one catalog update where the columns are unchanged."""
    shape = lambda df: [(f.name, f.dataType) for f in df.schema.fields]
    if spark.catalog.tableExists(name) and shape(spark.table(name)) == shape(written) and not partition_by:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written.schema.fields)
        parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts} LOCATION '{path}'")
        if partition_by:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def materialize_view(spark: SparkSession, model: str, layer: str, query: str) -> str:
    """SRC12: a named view in the catalog, which every session of the catalog
    resolves under its routed name."""
    name = target_name(model, layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC8 / SRC16: scan a warehouse table at query time."""
    return spark.table(name)


# --- relational database (SRC9) -----------------------------------------------------


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 8,
              properties: dict | None = None) -> DataFrame:
    """SRC9: a database table over JDBC, split on a numeric column when given.
    Not exercised here: no database is reachable from the test container."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})
