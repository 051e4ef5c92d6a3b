"""Point-in-time window features that split hot keys (WN6-WN14).

Spark evaluates ``RANGE BETWEEN W PRECEDING AND 1 PRECEDING`` inside one task
per partition key and re-aggregates the moving frame for every row, so a key
holding a third of the data becomes one task doing rows x frame work.  The
operators here give the same answers while partitioning by (key, time bucket):

``prior_window_aggs`` -- count / non-null count / sum / max of a value over
events of the same key with time in ``[t - W, t - 1]``.  With bucket width B
dividing W (m = W / B) and q the bucket of t, the frame is

    suffix of bucket q-m from t-W  +  full buckets q-m+1 .. q-1  +  prefix of bucket q before t

* the prefix is a running aggregate inside partition (key, q);
* the full buckets come from a per-(key, bucket) partial aggregate (size:
  keys x active buckets, independent of rows per key) and a range window over
  the bucket number;
* the suffix is brought into partition (key, q) by a *shadow* copy of every
  event, shifted by W: event s lands at tau = s + W, in bucket q exactly when
  it belongs to the suffix of some row of bucket q, and it counts for row t
  exactly when tau >= t.  Running aggregates in descending tau order give it.

All window frames are "unbounded preceding .. offset" frames, which Spark
evaluates incrementally, so each partition costs one sort.  Rows whose order
value is NULL form one peer group (SQL RANGE semantics): their frame is all
NULL-time rows of the key, which share the partition of the NULL bucket.

``neighbour_time`` -- ``lag`` / ``lead`` of a time per key, split the same way:
inside (key, bucket) a window, and for a bucket's edge row the nearest time of
the previous / next non-empty bucket of the key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import decimal_avg, seconds_diff

DEFAULT_BUCKET_SECONDS = 86_400


def join_on_keys(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Left join on null-safe key equality; the right side's key columns are
    renamed first so self-derived sides do not clash, then dropped."""
    r = right.select(*[F.col(c).alias(f"__rk_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__rk_{c}")) for c in cols])
    return left.join(r, cond, "left").drop(*[f"__rk_{c}" for c in cols])


def in_part(keys: list[str], bucket: str):
    """(keys, bucket) as one struct.  It is never NULL itself and NULL keys in it are equal, so windows and plain equality joins
    share one exchange, where a null-safe join would deal the rows anew."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([*keys, bucket])])


def _with_summary(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Left join of the (key, bucket) summary onto rows that are already dealt by ``__part``."""
    s = summary.withColumnRenamed("__part", "__rk_part")
    return rows.join(s, F.col("__part") == F.col("__rk_part"), "left").drop("__rk_part")


def prior_window_aggs(df: DataFrame, keys: list[str], t_col: str, v_col: str,
                      widths: dict[str, int], bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                      prefix: str = "__pw") -> DataFrame:
    """Append ``{prefix}_{cnt,nn,sum,max}_{label}`` for every width.

    Rows at the same (key, second) are peers: they share one frame and do
    not see each other.  Each row is shuffled once per width plus once, with
    its key, time and value; pass narrow rows.
    """
    B = bucket_seconds
    for w in widths.values():
        if w % B:
            raise ValueError(f"bucket width {B} must divide window width {w}")
    t, v, kind = F.col(t_col), F.col(v_col), F.col("__kind")
    # each timed row becomes itself (kind 0) and one shadow per width
    kinds = F.when(t.isNull(), F.array(F.lit(0))).otherwise(F.array(*[F.lit(k) for k in range(len(widths) + 1)]))
    rows = df.select(F.struct(*df.columns).alias("__row"), *keys, t.alias("__t"), v.alias("__v"),
                     F.explode(kinds).alias("__kind"))
    shift = F.lit(0)
    for i, w in enumerate(widths.values()):
        shift = F.when(kind == i + 1, F.lit(w)).otherwise(shift)
    rows = rows.select(F.when(kind == 0, F.col("__row")).alias("__row"), *keys, "__v", "__kind",
                       (F.col("__t") + shift).alias("__tau"))
    rows = rows.withColumn("__b", F.floor(F.col("__tau") / F.lit(B)).cast("bigint")).withColumn("__part", in_part(keys, "__b"))
    rows = rows.drop(*keys, "__b")
    asc_prior = Window.partitionBy("__part").orderBy(F.col("__tau").asc()).rangeBetween(Window.unboundedPreceding, -1)
    desc_upto = Window.partitionBy("__part").orderBy(F.col("__tau").desc()).rangeBetween(Window.unboundedPreceding, 0)

    def stats(k):
        own = F.when(kind == k, F.col("__v"))
        return {"cnt": F.count(F.when(kind == k, 1)), "nn": F.count(own), "sum": F.sum(own), "max": F.max(own)}

    # full buckets: per (key, bucket) totals, then a range window over the
    # bucket number per key (one row per active bucket)
    totals = df.select(*keys, F.floor(t / F.lit(B)).cast("bigint").alias("__b"), v.alias("__v"), F.lit(0).alias("__kind"))
    buckets = totals.groupBy(*keys, "__b").agg(*[x.alias(f"__b_{n}") for n, x in stats(0).items()])
    fold = {"cnt": F.sum, "nn": F.sum, "sum": F.sum, "max": F.max}
    mids = []
    for i, w in enumerate(widths.values()):
        wb = Window.partitionBy(*keys).orderBy("__b").rangeBetween(-(w // B - 1), -1)
        inner = F.col("__b").isNotNull() & F.lit(w // B > 1)
        mids += [F.when(inner, f(f"__b_{n}").over(wb) if w // B > 1 else None).alias(f"__mid_{n}_{i}")
                 for n, f in fold.items()]
    rows = rows.select("__row", "__part", "__kind", *[x.over(asc_prior).alias(f"__pre_{n}") for n, x in stats(0).items()],
                       *[x.over(desc_upto).alias(f"__suf_{n}_{i}") for i in range(len(widths))
                         for n, x in stats(i + 1).items()]).where(kind == 0)
    j = _with_summary(rows, buckets.select(in_part(keys, "__b").alias("__part"), *mids))

    z, outs = F.lit(0), []
    decimal_sum = df.schema[v_col].dataType.typeName() == "decimal"
    for i, lab in enumerate(widths):
        def tot(name):
            return (F.coalesce(F.col(f"__pre_{name}"), z) + F.coalesce(F.col(f"__mid_{name}_{i}"), z)
                    + F.coalesce(F.col(f"__suf_{name}_{i}"), z))
        s = tot("sum").cast("decimal(38,9)") if decimal_sum else tot("sum")
        outs += [tot("cnt").cast("bigint").alias(f"{prefix}_cnt_{lab}"),
                 tot("nn").cast("bigint").alias(f"{prefix}_nn_{lab}"),
                 F.when(tot("nn") > 0, s).alias(f"{prefix}_sum_{lab}"),
                 F.greatest("__pre_max", f"__mid_max_{i}", f"__suf_max_{i}").alias(f"{prefix}_max_{lab}")]
    return j.select("__row.*", *outs)


def prior_event_time(df: DataFrame, keys: list[str], ts_col: str, tiebreak: str, out_col: str,
                     bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``lag(ts) over (partition by keys order by ts, tiebreak)`` split by time bucket."""
    return neighbour_time(df, keys, ts_col, [tiebreak], out_col, "prev", bucket_seconds)


def neighbour_time(df: DataFrame, keys: list[str], ts_col: str, tiebreaks: list, out_col: str,
                   direction: str = "prev", bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``lag``/``lead`` of a time column per key, ordered by (ts, tiebreaks),
    split by (key, time bucket).  NULL times form their own bucket, first."""
    ts = F.col(ts_col)
    bucket = F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(bucket_seconds * 1_000_000)).cast("bigint")
    rows = df.withColumn("__lb", bucket).withColumn("__part", in_part(keys, "__lb")).drop("__lb")
    w = Window.partitionBy("__part").orderBy(ts.asc(), *tiebreaks)
    wk = Window.partitionBy(*keys).orderBy(F.col("__lb").asc_nulls_first())
    step, nearest, edge = ((F.lag, F.max, F.row_number().over(w) == 1) if direction == "prev" else
                           (F.lead, F.min, F.lead(F.lit(1)).over(w).isNull()))
    summary = df.withColumn("__lb", bucket).groupBy(*keys, "__lb").agg(nearest(ts).alias("__v"))
    summary = summary.select(in_part(keys, "__lb").alias("__part"), step("__v").over(wk).alias("__other"))
    rows = rows.withColumns({"__nb": step(ts).over(w), "__edge": edge})
    j = _with_summary(rows, summary)
    return j.select(*df.columns, F.when(F.col("__edge"), F.col("__other")).otherwise(F.col("__nb")).alias(out_col))


def point_in_time_features(e: DataFrame, specs, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Recency and rolling features per ``transaction_id`` (the key of ``e``).

    ``e``: (transaction_id, event_ts, unix_time_seconds, original_amount, key
    columns).  Every key set is computed from these narrow rows on its own and
    joined back once by transaction_id; one form for every key, hot or not.
    """
    out = e.select("transaction_id")
    for prefix, keys, widths, full in specs:
        r = prior_event_time(e.select("transaction_id", "event_ts", *keys), keys, "event_ts", "transaction_id",
                             "__prev", bucket_seconds)
        out = join_on_keys(out, r.select("transaction_id", seconds_diff(F.col("event_ts"), F.col("__prev"))
                                         .alias(f"{prefix}_recency_seconds")), ["transaction_id"])
        w = prior_window_aggs(e.select("transaction_id", "unix_time_seconds", "original_amount", *keys), keys,
                              "unix_time_seconds", "original_amount", widths, bucket_seconds)
        cols = []
        for lab in widths:
            cols += [F.col(f"__pw_cnt_{lab}").alias(f"{prefix}_txn_count_{lab}"),
                     decimal_avg(F.col(f"__pw_sum_{lab}"), F.col(f"__pw_nn_{lab}"))
                     .alias(f"{prefix}_original_amount_avg_{lab}")]
            if full:
                cols += [F.col(f"__pw_{s}_{lab}").alias(f"{prefix}_original_amount_{s}_{lab}") for s in ("sum", "max")]
        out = join_on_keys(out, w.select("transaction_id", *cols), ["transaction_id"])
    return out
