"""Exact distinct counts that can be merged (AG7, RP6).

A count of distinct values per day cannot be added up over days.  A bitmap can: each value has a number, a group's values are
the set bits, and a coarser group is the OR of finer ones.  The numbers come from a stored dictionary; bitmaps are cut into
buckets of 32,768 numbers (4 KB), so a group holds one row per bucket that it touches, and no row grows with the data.

Facts are reduced to distinct (group, value) before they meet the dictionary, with a partial aggregate before the shuffle, so
a value or a day with a third of the facts sends one row per map task.  There is no ``Expand``: each counted column is a pass
over two narrow columns.

Defined cases: NULL values are not counted; NULL groups are groups; repeated rows change nothing; an empty table gives no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET = 32_768     # fixed by Spark's bitmap functions


def new_numbers(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, number) for the distinct values of ``column`` that ``known`` (value, number) does not hold.

    Numbers are dense within each partition, and the first follows the greatest known one, at the start of a bucket; the
    result must be written before it is used, as a recomputed partition may number its values anew."""
    v = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    start = F.lit(0).cast("bigint")
    if known is not None:
        v = v.join(known.select("value"), "value", "left_anti")
        top = known.agg(F.max("number")).first()[0]
        start = F.lit(0 if top is None else (top // BUCKET + 1) * BUCKET).cast("bigint")
    return v.select("value", (start + F.monotonically_increasing_id()).alias("number"))


def bitmaps(facts: DataFrame, groups: list[str], columns: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(groups, counted, bucket, bits): one row per group, counted name and touched bucket.  ``columns`` maps a name to the
    counted column and its dictionary."""
    parts = []
    for name, (column, dictionary) in columns.items():
        once = facts.where(F.col(column).isNotNull()).select(*groups, F.col(column).alias("__value")).distinct()
        # the partial aggregate of the join's other side has left one row per group and value
        numbered = once.join(dictionary.select(F.col("value").alias("__value"), "number"), "__value")
        parts.append(numbered.groupBy(*groups, F.lit(name).alias("counted"),
                                      F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))
    return reduce(DataFrame.unionByName, parts)


def rolled_up(stored: DataFrame, groups: list[str]) -> DataFrame:
    """Bitmaps of coarser groups: the OR over the rest."""
    return stored.groupBy(*groups, "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(stored: DataFrame, groups: list[str], names: list[str]) -> DataFrame:
    """Exact distinct counts per group (a column for each of ``names``) from bitmaps of the same or finer groups."""
    per_bucket = rolled_up(stored, groups).select(*groups, "counted", F.bitmap_count("bits").alias("n"))
    return per_bucket.groupBy(*groups).agg(*[
        F.coalesce(F.sum(F.when(F.col("counted") == n, F.col("n"))), F.lit(0)).alias(n) for n in names])


# --- over the facts ---------------------------------------------------------------

COUNTED = ["distinct_users", "distinct_merchants"]


def daily_bitmaps(models) -> DataFrame:
    """Users and merchants per (day, currency), written and read back."""
    from ledgerlake.plans.models import written
    fct = models.fct_transactions
    columns = {}
    for name, column in zip(COUNTED, ("user_id", "merchant_name")):
        columns[name] = (column, written(new_numbers(fct, column), f"dictionary-{column}"))
    return written(bitmaps(fct, ["date_key", "currency"], columns), "daily-bitmaps")


def distinct_levels(models) -> DataFrame:
    """Distinct users and merchants per day and currency, per day, per currency and over all, from one stored table."""
    stored, out = daily_bitmaps(models), None
    for level, groups in {"day and currency": ["date_key", "currency"], "day": ["date_key"], "currency": ["currency"],
                          "all": []}.items():
        one = distinct_counts(stored, groups, COUNTED).withColumn("level", F.lit(level))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.select("level", "date_key", "currency", *COUNTED)
