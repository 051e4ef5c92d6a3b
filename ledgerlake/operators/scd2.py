"""Slowly changing dimension, type 2 (WN5, JN2).

``versions`` turns a change log into half-open validity intervals
``[valid_from, valid_to)`` with ``lead`` per entity; ``as_of_left_join`` gives
each fact the version valid at its time.

Work of both is linear in facts plus versions, however many of either one
entity has, and no task holds more than one time bucket of an entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import FAR_FUTURE
from ledgerlake.operators.carry import carry_last, micros

BUCKET_SECONDS = 30 * 86_400


def versions(changes: DataFrame, key: str, valid_from: str, order_tiebreak: list, out_to: str,
             bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``lead(valid_from) over (partition by key order by valid_from, ...)``.

    Split by (key, time bucket) so an entity with a huge change history is
    not one task: the last version of a bucket takes the first start of the
    next non-empty bucket of the same entity.

    Change logs are at-least-once: a row landed n times gives n versions, of
    which only the last looks across to the next change; the others end where
    they start.  Equal rows are counted first (a partial aggregate), so the
    tiebreak is unique among what is left.
    """
    from ledgerlake.operators.rolling import neighbour_time
    columns = changes.columns
    once = changes.groupBy(*columns).agg(F.count(F.lit(1)).alias("__times"))
    out = neighbour_time(once, [key], valid_from, order_tiebreak, out_to, "next", bucket_seconds)
    out = out.withColumn("__nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__times"))))
    return out.select(*columns, F.when(F.col("__nth") < F.col("__times"), F.col(valid_from))
                      .otherwise(F.col(out_to)).alias(out_to))


def as_of_left_join(facts: DataFrame, fact_key: str, fact_time, dim: DataFrame, dim_key: str,
                    valid_from: str, valid_to: str, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``facts.*`` plus the other columns of ``dim``: the version with
    ``valid_from <= time < coalesce(valid_to, far future)``, NULLs without one.

    The non-empty intervals of one key must not overlap, as those made by
    ``versions`` never do; empty ones (``valid_to = valid_from``) match
    nothing.  A NULL key or time finds no version.
    """
    payload = [c for c in dim.columns if c != dim_key]
    start, end = micros(F.col(valid_from)), F.coalesce(micros(F.col(valid_to)), micros(F.lit(FAR_FUTURE)))
    points = dim.where(F.col(dim_key).isNotNull() & (start < end)).select(
        F.col(dim_key).alias("__k"), start.alias("__t"), F.struct(end.alias("__end"), *payload).alias("__v"))
    j = carry_last(facts, F.col(fact_key), micros(fact_time), points, "__version", bucket_seconds)
    valid = micros(fact_time) < F.col("__version.__end")
    return j.select(*facts.columns, *[F.when(valid, F.col("__version")[c]).alias(c) for c in payload])
