"""The latest point at or before a time, per key: the linear core of the as-of join (JN1) and the SCD2 join (JN2).

Facts and points of one (key, time bucket) meet in one partition, ordered by
time, and the last point is carried along.  A bucket's first facts take the
last point of the key's earlier buckets from a summary with one row per
(key, bucket).  Work is linear in facts plus points, and a key however hot is
split into its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def carry_last(facts: DataFrame, key: Column, time: Column, points: DataFrame, out: str,
               bucket_seconds: int) -> DataFrame:
    """``facts.*`` plus ``out``: the struct ``__v`` of the point with the fact's
    key and the largest ``__t <= time`` (microseconds).

    ``points``: (__k, __t, __v), at most one per (__k, __t), no NULLs in either.
    Facts with a NULL key or time get NULL.
    """
    bucket = F.floor(F.col("__t") / F.lit(bucket_seconds * MICROS)).cast("bigint")
    v = points.select("__k", "__t", F.lit(0).alias("__kind"), "__v").withColumn("__b", bucket)
    f = facts.select(key.alias("__k"), time.alias("__t"), F.lit(1).alias("__kind"),
                     F.struct(*[f"`{c}`" for c in facts.columns]).alias("__f"))
    # facts that find nothing are no hot partition: they are spread over buckets of their own
    nowhere = F.lit(-(1 << 50)) - F.pmod(F.xxhash64("__f"), F.lit(64))
    f = f.withColumn("__b", F.when(F.col("__k").isNull() | F.col("__t").isNull(), nowhere).otherwise(bucket))
    rows = v.unionByName(f, allowMissingColumns=True)
    upto = Window.partitionBy("__k", "__b").orderBy("__t", "__kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("__last", F.last("__v", ignorenulls=True).over(upto)).where("__kind = 1")
    # the last point of each bucket, carried to the key's later buckets
    marks = v.select("__k", "__b", "__t", "__v").unionByName(
        f.where("__k is not null and __t is not null").select("__k", "__b"), allowMissingColumns=True)
    tails = marks.groupBy("__k", "__b").agg(F.max_by("__v", "__t").alias("__v"))
    before = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(F.col("__k").alias("__ck"), F.col("__b").alias("__cb"),
                         F.last("__v", ignorenulls=True).over(before).alias("__carry")).where("__carry is not null")
    j = found.join(carry, (F.col("__k") == F.col("__ck")) & (F.col("__b") == F.col("__cb")), "left")
    known = F.col("__k").isNotNull() & F.col("__t").isNotNull()
    return j.select("__f.*", F.when(known, F.coalesce("__last", "__carry")).alias(out))
