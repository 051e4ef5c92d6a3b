"""Best-fit packing of documents into bins of a fixed number of words, under conflicts.

A document longer than a bin is cut into pieces at whole bins; no words are lost.  Two pieces of one duplicate
cluster never share a bin, and a bin takes at most ``max_per_source`` pieces of one source.  Spark deals the pieces
by hash to shards of about ``shard_rows`` pieces, which bounds a task's memory and spreads hot sources and clusters
evenly; each shard is packed on its own, largest piece first.  The deal hashes id, source, piece, cluster and the row's
rank among equal rows, so bins do not depend on the order of the rows or their files.  With more than one shard, the
pieces of bins filled under ``full`` are dealt and packed again, round by round while that saves bins.  A piece finds
bins of its own shard only, so a tighter bin of another shard is missed and bins change with the number of shards.

Within a shard the open bins are kept by residual; a bitmap over residuals finds the successor, the tightest residual that
still holds the piece.  Each residual, duplicate cluster and (source, count) keeps a bitmap of bins, so the compatible
bins of a residual are one AND-NOT away; the search goes on to the next residual until one is left, and a new bin opens
only if none is.

Defined cases: a null text has no words and still gets a place; a null source is a source of its own; ties go by id, then
piece; repeated rows are one cluster and so go to different bins; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .mixing import n_words


def best_fit(pieces: list[tuple[int, int, int]], capacity: int, max_per_source: int) -> list[int]:
    """Bin number of each piece (size, cluster, source), packed in the given order."""
    levels: dict[int, int] = {}        # residual -> bitmap of bins
    occupied = 0                       # bitmap of residuals with a bin
    in_cluster: dict[int, int] = {}    # cluster -> bitmap of bins
    per_source: dict[tuple, int] = {}  # (source, k) -> bitmap of bins with at least k pieces of it
    residual: list[int] = []
    out = []
    for size, cluster, source in pieces:
        barred = in_cluster.get(cluster, 0) | per_source.get((source, max_per_source), 0)
        later, chosen = occupied >> size, -1
        while later:
            step = (later & -later).bit_length() - 1
            free = levels[size + step] & ~barred
            if free:
                chosen = (free & -free).bit_length() - 1
                break
            later &= later - 1   # the successor search goes on
        if chosen < 0:
            chosen = len(residual)
            residual.append(capacity)
        else:
            old = residual[chosen]
            levels[old] &= ~(1 << chosen)
            if not levels[old]:
                occupied &= ~(1 << old)
        bit, left = 1 << chosen, residual[chosen] - size
        residual[chosen] = left
        levels[left] = levels.get(left, 0) | bit
        occupied |= 1 << left
        in_cluster[cluster] = in_cluster.get(cluster, 0) | bit
        k = 1
        while per_source.get((source, k), 0) & bit:
            k += 1
        per_source[(source, k)] = per_source.get((source, k), 0) | bit
        out.append(chosen)
    return out


COLUMNS = ["__id", "__source", "__piece", "__first", "__size", "__cluster", "__deal"]


def _packed(pieces: DataFrame, shards: int, first_shard: int, capacity: int, max_per_source: int) -> DataFrame:
    """The pieces with (bin, start), each of the shards packed on its own."""
    dealt = pieces.select(*COLUMNS, (F.pmod(F.xxhash64("__deal", F.lit(first_shard)), F.lit(shards)) + first_shard)
                          .cast("int").alias("__shard"))
    types = ", ".join(f"{c} {dealt.schema[c].dataType.simpleString()}" for c in COLUMNS)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__size", "__id", "__cluster", "__piece", "__source"],
                              ascending=[False, True, True, True, True], kind="stable",
                              na_position="last").reset_index(drop=True)
        sources = pd.factorize(pdf["__source"], use_na_sentinel=False)[0]
        bins = best_fit(list(zip(pdf["__size"].tolist(), pdf["__cluster"].tolist(), sources.tolist())), capacity,
                        max_per_source)
        pdf["__bin"] = bins
        pdf["__start"] = pdf.groupby("__bin")["__size"].cumsum() - pdf["__size"]
        pdf["__bin"] += pdf["__shard"].astype("int64") * (1 << 32)
        return pdf[[*COLUMNS, "__bin", "__start"]]

    return dealt.groupBy("__shard").applyInPandas(run, f"{types}, __bin long, __start long")


def pack(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
         capacity: int = 2048, max_per_source: int = 3, shard_rows: int = 4096, full: float = 0.9) -> DataFrame:
    """(id, source, piece, first_word, size, cluster, bin_id, bin_start), one row per piece.

    ``cluster``: hash of the whole text (exact copies conflict).  ``bin_start``: words of the bin before the piece.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), n_words(text).alias("__n"),
                     F.xxhash64(text).alias("__cluster"))
    # equal rows are counted and told apart by their rank: the same rows in other files are dealt the same way
    equal = docs.groupBy("__id", "__source", "__n", "__cluster").agg(F.count("*").alias("__rows"))
    docs = equal.withColumn("__rank", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__rows"))))
    last = F.greatest(F.ceil(F.col("__n") / capacity).cast("long") - 1, F.lit(0).cast("long"))
    pieces = docs.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = materialise(pieces.withColumns({
        "__first": F.col("__piece") * capacity,
        "__size": F.least(F.col("__n") - F.col("__piece") * capacity, F.lit(capacity)).cast("long"),
        "__deal": F.xxhash64("__id", "__source", "__piece", "__cluster", "__rank")}).select(*COLUMNS), "pack-pieces")
    n, used = pieces.count(), 0
    shards = max(1, -(-n // shard_rows))
    out = _packed(pieces, shards, used, capacity, max_per_source)
    settled = []
    while shards > 1:   # the loose pieces of a round are packed again, as long as that saves bins and they get few
        out = materialise(out, "pack-bins")
        loose_bins = materialise(out.groupBy("__bin").agg(F.sum("__size").alias("__fill"))
                                 .filter(F.col("__fill") < full * capacity).select("__bin"), "pack-loose-bins")
        loose = materialise(out.join(loose_bins, "__bin", "left_semi"), "pack-loose")
        m, used = loose.count(), used + shards
        if m == 0:
            break
        shards = -(-m // shard_rows)
        again = materialise(_packed(loose, shards, used, capacity, max_per_source), "pack-again")
        if again.select("__bin").distinct().count() >= loose_bins.count():
            break
        settled.append(out.join(loose_bins, "__bin", "left_anti").select(*out.columns))
        out = again
        if 2 * m > n:
            break
        n = m
    for part in settled:
        out = out.unionByName(part)
    return out.select(F.col("__id").alias(id_col), F.col("__source").alias(source_col), F.col("__piece").alias("piece"),
                      F.col("__first").alias("first_word"), F.col("__size").alias("size"),
                      F.col("__cluster").alias("cluster"), F.col("__bin").alias("bin_id"),
                      F.col("__start").alias("bin_start"))
