"""Top-1 per key (FLT3/SL2/WN1/WN2/AG12) and reproducible random top-n (SL1).

``row_number() ... = 1`` is planned by Spark as a partial WindowGroupLimit
before the shuffle and a final one after it, so every map task forwards at
most one row per key.  A hot key (or the NULL key) therefore costs no more
shuffle volume than any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_tiebreak(df: DataFrame) -> Column:
    """Deterministic last sort key: a hash of the whole row (T7)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).desc()


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order, row_tiebreak(df))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def sample_hash(key: Column, salt: str) -> Column:
    """A 60-bit non-negative hash of ``key || salt`` (first 15 hex digits of
    md5): uniform, reproducible, and the same in any SQL engine with md5."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(salt))), 1, 15), 16, 10).cast("bigint")


def sample_top_n(df: DataFrame, key: str, fraction: float, salt: str = "0") -> DataFrame:
    """SL1: ``ORDER BY RANDOM() LIMIT max(1, int(total * pct))``, reproducibly.

    The random order is a salted hash of the key, so a retried task picks
    the same rows.  The n smallest hashes are found without funnelling n rows
    through one task: a histogram over the top 16 hash bits (at most 65,536
    counts reach the driver, their sum is the total) locates the bucket holding
    the n-th row; every bucket below it is taken whole by a filter, and only
    that one bucket (about total/65,536 rows) is ordered to take the
    remainder.  The keys' hashes are checkpointed first, so that ``df`` is
    computed once for the histogram and both parts.
    """
    ranked = (df.withColumn("__h", sample_hash(F.col(key), salt))
                .withColumn("__b", F.shiftright("__h", 44))).checkpoint()
    hist = ranked.groupBy("__b").count().orderBy("__b").collect()
    n = max(1, int(sum(r["count"] for r in hist) * fraction))
    seen, cut, need = 0, None, 0
    for row in hist:
        if seen + row["count"] >= n:
            cut, need = row["__b"], n - seen
            break
        seen += row["count"]
    if cut is None:          # no rows
        return ranked.drop("__h", "__b")
    below = ranked.where(F.col("__b") < cut)
    edge = ranked.where(F.col("__b") == cut).orderBy("__h", key).limit(need)
    return below.unionByName(edge).drop("__h", "__b")
