"""JN1: nearest-in-time as-of left join.

Semantics (per left row): among right rows with the same key, take the one
with the smallest ``abs(timestamp_diff(left_time, right_time, SECOND))``
(truncated whole seconds); on equal distance the later right row wins.  Left
rows without a match keep NULLs.  Right rows with a NULL time or key are
ignored (T4).

A left time t of whole seconds (all times, usually) needs one look-up: all right
rows of one second are at one truncated distance, so only the last row of each
second counts, and the nearest is the last row of t's own second, or else of the
nearest second before or after.  Seconds and left rows of one (key, time bucket)
meet in one window; the seconds before and after a bucket come from a summary
with one row per (key, bucket).  Left rows with a NULL time take the key's last
row: they are spread over buckets past every right row.

Left times with fractions go the general way.  The nearest right row is one of
two: a*, the latest right time <= t, or b**, the latest right time below
t + (d + 1) s, where d is the truncated distance to b*, the first right time > t
(every later row at the same truncated distance ties, and the latest of them
wins).  b** wins when there is a b* and d <= the distance to a*.  Both are
"latest point at or before" look-ups (``carry_last``): each right row carries
the time of its successor, so the first look-up gives a* and b*, and the
second, at t + (d + 1) s - 1 us, gives b**.  A row at the beginning of time per
key carries b* for left rows before the first right row.  Whether there are such
left times is found by a scan of the time column when the join is built.

Both ways are exact, linear in both sides, and split a key into time buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.carry import MICROS, carry_last, micros
from ledgerlake.operators.topk import latest_per_key

BEGINNING = -62_135_596_800 * MICROS    # 0001-01-01, before any right row


def _points(right: DataFrame, right_key: str, right_time: str, right_cols: dict[str, str],
            bucket_seconds: int) -> DataFrame:
    """(__k, __t, __v): one point per (key, distinct time) with the payload and
    the key's next distinct time, and one at the beginning of time per key."""
    from ledgerlake.operators.rolling import neighbour_time
    r = right.where(F.col(right_time).isNotNull() & F.col(right_key).isNotNull()).select(
        F.col(right_key).alias("__k"), F.col(right_time).alias("__rt"),
        *[F.col(src).alias(dst) for dst, src in right_cols.items()])
    # identical times of one key: one deterministic row (the reference's
    # order leaves such ties open)
    r = latest_per_key(r, ["__k", "__rt"], [])
    r = neighbour_time(r, ["__k"], "__rt", [], "__next_rt", "next", bucket_seconds)
    value = F.struct(F.col("__rt"), micros(F.col("__next_rt")).alias("__next"), *right_cols)
    points = r.select("__k", micros(F.col("__rt")).alias("__t"), value.alias("__v"))
    first = r.groupBy("__k").agg(micros(F.min("__rt")).alias("__next"))
    nothing = [F.lit(None).cast(r.schema[c].dataType).alias(c) for c in ("__rt", *right_cols)]
    first = first.select("__k", F.lit(BEGINNING).cast("bigint").alias("__t"),
                         F.struct(nothing[0], "__next", *nothing[1:]).alias("__v"))
    return points.unionByName(first)


SPREAD = 64                     # buckets that rows without a time or key are spread over
PAST_ALL = 400_000_000_000      # seconds since 1970, after any timestamp


def _last_of_seconds(right: DataFrame, right_key: str, right_time: str, right_cols: dict[str, str]) -> DataFrame:
    """(__k, __s, __v): the last right row of each (key, whole second); identical times: one deterministic row."""
    cols = [F.col(src).alias(dst) for dst, src in right_cols.items()]
    r = right.where(F.col(right_time).isNotNull() & F.col(right_key).isNotNull()).select(
        F.col(right_key).alias("__k"), F.col(right_time).alias("__rt"), *cols)
    tie = F.xxhash64("__k", "__rt", *right_cols)
    value = F.struct(F.col("__rt"), tie.alias("__tie"), *right_cols)
    second = F.floor(micros(F.col("__rt")) / F.lit(MICROS)).cast("bigint")
    # the second first: the aggregate sorts, and times tell rows apart sooner than the few keys do
    return r.groupBy(second.alias("__s"), "__k").agg(F.max(value).alias("__v")).select("__k", "__s", "__v")


def _whole_seconds(left: DataFrame, points: DataFrame, left_key: str, left_time: str, right_cols: dict[str, str],
                   bucket_seconds: int) -> DataFrame:
    """The join for left rows whose time is NULL or of whole seconds."""
    B = F.lit(bucket_seconds)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(SPREAD))
    key, t = F.col(left_key), F.floor(micros(F.col(left_time)) / F.lit(MICROS)).cast("bigint")
    second = F.when(key.isNull() | t.isNull(), F.lit(PAST_ALL) + salt * B).otherwise(t)
    bucket = F.floor(F.col("__s") / B).cast("bigint")
    p = points.withColumn("__b", bucket)
    f = left.select(key.alias("__k"), second.alias("__s"), F.lit(1).alias("__kind"),
                    F.struct(*[f"`{c}`" for c in left.columns]).alias("__f")).withColumn("__b", bucket)
    rows = p.select("__k", "__s", "__b", F.lit(0).alias("__kind"), F.struct("__s", "__v").alias("__p")).unionByName(
        f, allowMissingColumns=True)
    order = Window.partitionBy("__b", "__k").orderBy("__s", "__kind")
    rows = rows.withColumns({
        "__prev": F.last("__p", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__next": F.expr("lead(__p) IGNORE NULLS OVER (PARTITION BY __b, __k ORDER BY __s, __kind)")}).where("__kind = 1")
    # the last second before, and the first after, each bucket that holds left rows
    ends = p.groupBy("__k", "__b").agg(F.min(F.struct("__s", "__v")).alias("__first"), F.max(F.struct("__s", "__v")).alias("__last"))
    asked = f.where("__k is not null").select("__k", "__b").distinct()
    marks = asked.join(ends, ["__k", "__b"], "full")
    upto = Window.partitionBy("__k").orderBy("__b")
    marks = marks.select(
        F.col("__k").alias("__mk"), F.col("__b").alias("__mb"),
        F.last("__last", ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.expr("lead(__first) IGNORE NULLS OVER (PARTITION BY __k ORDER BY __b)").alias("__after"))
    j = rows.join(marks, (F.col("__b") == F.col("__mb")) & (F.col("__k") == F.col("__mk")), "left")
    j = j.select("__f", "__s", F.coalesce("__prev", "__before").alias("__prev"), F.coalesce("__next", "__after").alias("__next"))
    fraction = F.pmod(micros(F.col("__prev.__v.__rt")), F.lit(MICROS)) > 0
    earlier = F.col("__s") - F.col("__prev.__s") - F.when(fraction, 1).otherwise(0)
    same = F.col("__prev.__s") == F.col("__s")
    later = F.col("__next.__s") - F.col("__s")
    wins = F.col("__next").isNotNull() & (F.col("__prev").isNull() | (~same & (later <= earlier)))
    best = F.when(wins, F.col("__next.__v")).otherwise(F.col("__prev.__v"))
    j = j.withColumn("__best", best)
    return j.select("__f.*", F.col("__best.__rt").alias("__right_time"), *[F.col("__best")[c].alias(c) for c in right_cols])


def _any_time(left: DataFrame, right: DataFrame, left_key: str, left_time: str, right_key: str, right_time: str,
              right_cols: dict[str, str], bucket_seconds: int) -> DataFrame:
    """The join for left rows with a time, of any precision."""
    points = _points(right, right_key, right_time, right_cols, bucket_seconds)
    t = micros(F.col(left_time))
    j = carry_last(left, F.col(left_key), t, points, "__a", bucket_seconds)
    later = F.floor((F.col("__a.__next") - t) / F.lit(MICROS))
    earlier = F.floor((t - micros(F.col("__a.__rt"))) / F.lit(MICROS))
    wins = F.col("__a.__next").isNotNull() & (F.col("__a.__rt").isNull() | (later <= earlier))
    j = j.withColumn("__x", F.when(wins, t + (later + 1) * F.lit(MICROS) - 1).cast("bigint"))
    j = carry_last(j, F.col(left_key), F.col("__x"), points, "__b", bucket_seconds)
    out = [F.when(F.col("__x").isNotNull(), F.col("__b")[c]).otherwise(F.col("__a")[c]).alias(n)
           for c, n in (("__rt", "__right_time"), *((c, c) for c in right_cols))]
    return j.select(*left.columns, *out)


def nearest_asof_join(left: DataFrame, right: DataFrame, left_key: str, left_time: str,
                      right_key: str, right_time: str, right_cols: dict[str, str],
                      bucket_seconds: int = 3_600) -> DataFrame:
    """left.* + right_cols + ``__right_time``.  A NULL left time takes the
    latest right row of its key (NULL distances tie and the later wins)."""
    broken = F.coalesce(F.pmod(micros(F.col(left_time)), F.lit(MICROS)) != 0, F.lit(False))
    points = _last_of_seconds(right, right_key, right_time, right_cols)
    if left.where(broken).select(left_time).isEmpty():
        return _whole_seconds(left, points, left_key, left_time, right_cols, bucket_seconds)
    out = _whole_seconds(left.where(~broken), points, left_key, left_time, right_cols, bucket_seconds)
    return out.unionByName(_any_time(left.where(broken), right, left_key, left_time, right_key, right_time, right_cols,
                                     bucket_seconds))
