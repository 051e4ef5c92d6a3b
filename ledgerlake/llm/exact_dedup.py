"""Exact deduplication by a tree merge of digest runs (Spark expressions only).

Every row goes to one of ``n_runs`` runs by a hash of its id.  A run holds one entry per distinct digest: how many rows
it has and the identifier that stays.  Runs then meet in rounds of ``fan_in``: run r of a round merges into run
r div fan_in of the next, each merge a grouped aggregation on (run, digest), until one logical run is left.  An entry
is the SHA-256 of the whole text plus its byte length and a second, independent 64-bit hash: entries merge only where
all three agree, which verifies the kept identifier at every level.  A text that a third of all rows share
therefore never has more than ``fan_in`` entries per merge (n_runs after the first), whatever its number of copies.

The result goes back down the same way: the final entry joins the first-level entries of its digest, and rows look up
(run, digest), so no lookup key holds more than 1 / n_runs of a hot group.

Defined cases: a null text counts as empty; of equal texts the row with the largest id stays and null ids sort lowest;
of fully repeated rows (same id, same text) one is kept.  An empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, same

DIGEST = ["__sha", "__len", "__chk"]


def _digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("__id"), F.unhex(F.sha2(text, 256)).alias("__sha"),
                     F.octet_length(text).alias("__len"), F.xxhash64(text).alias("__chk"))


def _merge(entries: DataFrame) -> DataFrame:
    return entries.groupBy("__run", *DIGEST).agg(F.max("__keep").alias("__keep"), F.sum("__n").alias("__n"))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_runs: int = 256,
                 fan_in: int = 4) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256)."""
    rows = materialise(_digests(df, id_col, text_col).withColumn(
        "__run", F.pmod(F.xxhash64("__id"), F.lit(n_runs)).cast("int")), "digests")
    first = _merge(rows.select("__run", *DIGEST, F.col("__id").alias("__keep"), F.lit(1).cast("long").alias("__n")))
    top, runs = first, n_runs
    while runs > 1:
        top = _merge(top.withColumn("__run", F.floor(F.col("__run") / fan_in).cast("int")))
        runs = -(-runs // fan_in)
    top = top.drop("__run")
    down = first.select("__run", *DIGEST).join(top, DIGEST)
    again = Window.partitionBy("__run", *DIGEST, "__id").orderBy("__keep")
    out = rows.join(down, ["__run", *DIGEST]).withColumn(
        "__kept", F.col("__id").eqNullSafe(F.col("__keep")) & (F.row_number().over(again) == 1))
    return out.select(F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"), F.col("__n").alias("group_size"),
                      F.col("__kept").alias("kept"), F.lower(F.hex("__sha")).alias("text_sha256"))


def drop_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``df`` that stay, with their columns unchanged."""
    groups = exact_groups(df, id_col, text_col, **kw)
    stay = groups.filter("kept").select(F.col(id_col).alias("__id"), F.unhex("text_sha256").alias("__sha"))
    src = df.withColumns({"__id": F.col(id_col),
                          "__sha": F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))})
    one = Window.partitionBy("__id", "__sha").orderBy(F.col(text_col).isNull())
    return (src.join(stay, same(src, stay, ["__id", "__sha"]), "left_semi")
            .withColumn("__rn", F.row_number().over(one)).filter("__rn = 1").select(*[f"`{c}`" for c in df.columns]))
