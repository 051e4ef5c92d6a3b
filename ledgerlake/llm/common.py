"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: the lineage is cut and the rows
    survive the loss of any executor."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables written by :func:`materialise` that nothing reads any more."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bound_arrow_batches(spark: SparkSession, rows: int = 500) -> None:
    """Let an Arrow batch carry at most ``rows`` whole texts (Spark's default is 10,000 rows): the session's setting is
    lowered, never raised."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(min(rows, int(spark.conf.get(key)))))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    return F.translate(c, UPPER, UPPER.lower())


def same(left: DataFrame, right: DataFrame, names) -> Column:
    """Equality of the named columns where two nulls count as equal; still an equi-join for Spark."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond
