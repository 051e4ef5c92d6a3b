"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words; every document of the source then has the same expected number of copies,
target / source_size.  The expected copies are prefix-summed along the source, one random offset in [0, 1) is added per
source, and a document is emitted once for every integer boundary that the running sum crosses at it.  Documents stand
by size, then id, with every second stretch of one expected emission turned round: the sample is stratified by size, and
what one stretch takes too much the next takes too little, so the words taken come near the target.

The prefix sum is two-level: rows are range-partitioned by (source, size, id), which splits a hot source over many
partitions; only the row counts per (partition, source) are summed, and a row adds its place within the partition.

Defined cases: a null text has size 0; a null source is a source of its own and sorts last; a source of size 0 has
target 0 and is not taken; repeated rows are separate rows; an empty table gives an empty result; other columns are
ignored by :func:`systematic_mix` and kept by :func:`mix_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, same

WORD = "[^ \\t-\\r]+"
OFFSET_BITS = 20   # the random offset is a multiple of 2**-20: sums with whole numbers stay exact


def n_words(text: Column) -> Column:
    """Number of maximal runs of characters other than space and U+0009 to U+000D (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(rows: DataFrame, weights=(1, 2, 3), max_repeat: float = 3.0) -> DataFrame:
    """(source, source_size, target), one row per source.

    Weights repeat along the sources in code point order, nulls last.  Together the sources take as many words as there
    are; a target above ``max_repeat`` times its source's size stops there and the excess is shared again by
    weight.  The sharing ends at one water level: with sources sorted by cap / weight, the capped ones are the first k
    and the others get level * weight, level = (total - caps of the first k) / (weights of the rest).
    """
    every = Window.partitionBy()
    s = rows.groupBy("__source").agg(F.sum("__size").alias("__total"))
    place = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1
    s = s.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                         (place % len(weights) + 1).cast("int")))
    s = s.withColumn("__cap", F.col("__total") * F.lit(float(max_repeat)))
    asc = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("__source").asc_nulls_last())
    upto = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumns({"__k": F.row_number().over(asc), "__caps": F.sum("__cap").over(upto) - F.col("__cap"),
                       "__left": F.sum("__w").over(every) - F.sum("__w").over(upto) + F.col("__w"),
                       "__all": F.sum("__total").over(every).cast("double")})
    level = (F.col("__all") - F.col("__caps")) / F.col("__left")
    s = s.withColumn("__level", F.when(F.col("__cap") / F.col("__w") > level, F.struct("__k", level.alias("v"))))
    s = s.withColumn("__first", F.min("__level").over(every))
    open_ = F.col("__first.__k") <= F.col("__k")
    target = F.when(F.coalesce(open_, F.lit(False)),
                    F.least(F.col("__first.v") * F.col("__w"), F.col("__cap"))).otherwise(F.col("__cap"))
    return s.select("__source", F.col("__total").alias("__source_size"), target.alias("__target"))


def _plan(rows: DataFrame, weights, max_repeat, seed) -> DataFrame:
    """rows: (__id, __source, __size, ...); adds __source_size, __target and __copies."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    goals = targets(rows, weights, max_repeat)
    dealt = materialise(rows.repartitionByRange(parts, "__source", "__size", "__id")
                        .withColumn("__part", F.spark_partition_id()), "mix-dealt")
    counts = dealt.groupBy("__part", "__source").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", "__source", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
                           F.sum("__n").over(Window.partitionBy("__source")).alias("__rows"))
    starts = starts.withColumnsRenamed({"__part": "__p", "__source": "__s"}).join(
        goals, F.col("__s").eqNullSafe(F.col("__source"))).drop("__source")
    place = Window.partitionBy("__part", "__source").orderBy("__size", "__id")
    out = dealt.withColumn("__row", F.row_number().over(place) - 1).join(
        starts, (F.col("__part") == F.col("__p")) & F.col("__source").eqNullSafe(F.col("__s"))).drop("__p", "__s")
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    named = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("="), F.col("__source").cast("string")), F.lit("null")))
    offset = F.conv(F.substring(F.md5(named), 1, OFFSET_BITS // 4), 16, 10).cast("double") / float(1 << OFFSET_BITS)
    extra = rate - F.floor(rate)
    stretch = F.when(extra > 0, F.greatest(F.round(1 / extra), F.lit(1.0))).otherwise(F.lit(1.0)).cast("long")
    rank, stretch = F.col("__start") + F.col("__row"), F.least(stretch, F.col("__rows"))
    nth = F.floor(rank / stretch)
    turned = (nth % 2 == 1) & ((nth + 1) * stretch <= F.col("__rows"))
    rank = F.when(turned, (2 * nth + 1) * stretch - 1 - rank).otherwise(rank)
    crossed = F.floor(offset + rate * (rank + 1)) - F.floor(offset + rate * rank)
    return out.withColumn("__copies", F.least(crossed, F.lit(int(max_repeat))).cast("long"))


def systematic_mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                   weights=(1, 2, 3), max_repeat: float = 3.0, seed: int = 7) -> DataFrame:
    """One row per input row: (id, source, size, source_size, target, copies, taken)."""
    rows = materialise(df.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"),
                                 n_words(F.col(text_col)).alias("__size")), "mix-sizes")
    return _plan(rows, weights, max_repeat, seed).select(
        F.col("__id").alias(id_col), F.col("__source").alias(source_col), F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        F.col("__copies").alias("copies"), (F.col("__size") * F.col("__copies")).alias("taken"))


def mix_documents(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                  weights=(1, 2, 3), max_repeat: float = 3.0, seed: int = 7) -> DataFrame:
    """The mixed documents: every row of ``df`` as often as the mix takes it, columns unchanged."""
    key = ["__id", "__source", "__fp", "__nth"]
    src = df.withColumns({"__id": F.col(id_col), "__source": F.col(source_col), "__fp": F.xxhash64(text_col)})
    src = src.withColumn("__nth", F.row_number().over(Window.partitionBy("__id", "__source", "__fp").orderBy("__fp")))
    rows = materialise(src.select(*key, n_words(F.col(text_col)).alias("__size")), "mix-sizes")
    plan = _plan(rows, weights, max_repeat, seed).filter("__copies > 0").select(*key, "__copies")
    joined = src.join(plan, same(src, plan, key))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(
        *[src[f"`{c}`"] for c in df.columns])
