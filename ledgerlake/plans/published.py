"""SRC16: the report's tables published for direct queries, bucketed by their relationships' keys.

A visual's query joins a mart to its dimensions at query time.  Both sides of each relationship that a report joins are
stored in the same number of buckets of the relationship's key, sorted by it, so the join reads matching buckets and needs
no exchange, whatever the marts' size.

A version is written whole under a name of its own; a view of the table's routed name is then replaced by one catalog
update, so a reader sees the old or the new version, and a failed write leaves the old one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# table -> the key that its report joins use (both sides of a relationship share it)
BUCKET_KEYS = {
    "mart_kpi_merchant_overall": "merchant_name", "dim_merchants": "merchant_name",
    "mart_kpi_hourly": "time_key", "dim_time": "time_key",
    "mart_kpi_currency_daily": "date_key", "mart_kpi_daily": "date_key", "dim_date": "date_key",
}


def publish(spark: SparkSession, df: DataFrame, schema: str, table: str, root: str, key: str, buckets: int) -> str:
    """Store ``df`` in ``buckets`` buckets of ``key`` and make ``schema.table`` a view of it."""
    version = uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{root.rstrip('/')}/{schema}'")
    stored = f"{schema}.{table}__{version}"
    # one file a bucket: the rows are dealt as the buckets are
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{root.rstrip('/')}/{schema}/{table}/{version}").saveAsTable(stored))
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.{table} AS SELECT * FROM {stored}")
    return stored


class PublishedTables:
    """The published tables of a schema as attributes, for the report queries and the filter context."""

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema = spark, schema

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.spark.table(f"{self.schema}.{table}")


def publish_report_tables(models, root: str, schema: str = "report", buckets: int = 8, tables=tuple(BUCKET_KEYS)) -> PublishedTables:
    for t in tables:
        publish(models.spark, getattr(models, t), schema, t, root, BUCKET_KEYS[t], buckets)
    return PublishedTables(models.spark, schema)


def over_published(report, tables):
    """A report as a query over freshly published tables."""
    def run(models) -> DataFrame:
        from ledgerlake.plans.ingest import scratch
        schema = f"report_{uuid.uuid4().hex[:10]}"
        return report(publish_report_tables(models, scratch(models.spark, "report"), schema, tables=tables))
    run.__name__ = f"published_{report.__name__}"
    return run
