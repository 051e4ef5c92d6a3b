"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is taken from every word shingle of a text.  To link all fingerprints within ``max_bits``
(k) differing bits, the 64 bits are cut into ceil((k + 1) / 2) segments: of k differing bits some segment holds one
at most (k = 2: two segments of 32 bits).  Each distinct fingerprint is indexed under every one-wildcard variant of
every segment (the segment with one bit left out, its place kept), fingerprints with an equal variant meet in an
equality join, and the pair is verified by the number of differing bits.

Buckets of more than ``bucket_max`` distinct fingerprints (dense groups of near copies) are not paired.  Their
fingerprints are linked exactly and in linear size: fingerprints within k = 2 bits share a midpoint one flip from each, so
each is listed under itself and its 64 one-bit flips, and every list links its members to its smallest one.  All links
of a big bucket are found this way; links only serve to find groups, so a chain stands for all pairs.

Components of the links are found by repeated contraction (see graph.py), over distinct fingerprints only; documents look
theirs up by (fingerprint, salt), so a fingerprint that a third of all rows share is spread over ``salts`` keys.

Defined cases: a null text counts as empty; no words: fingerprint 0, linked like any other; fewer words than the shingle
length: one shingle of all words; repeated rows are separate rows of one component; null ids sort last and a component
of null ids only has a null id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, same
from .graph import components

BLOCK = 1 << 16   # shingles per numpy block: bounds memory on very long texts


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint: a bit is 1 if set in over half of the shingles' XXH64."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    joined, starts = b" ".join(words), ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    stops = (ends - 1)[min(shingle, len(words)) - 1:]
    ones, hash64 = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, n, BLOCK):
        h = np.array([hash64(joined[a:b], seed) for a, b in
                      zip(starts[lo:min(lo + BLOCK, n)].tolist(), stops[lo:lo + BLOCK].tolist())], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _sha(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int, seed: int = 42,
                 digest: bool = False) -> DataFrame:
    """(__id, __fp) per row, with ``digest`` also the SHA-256 of the text, __sha."""
    more = [_sha(text_col).alias("__sha")] if digest else []
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), *more)
    names, types = ["__id", "__fp"], f"__id {rows.schema['__id'].dataType.simpleString()}, __fp long"
    if digest:
        names, types = [*names, "__sha"], f"{types}, __sha binary"

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], names=names)
    return rows.mapInArrow(run, types)


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    n = (max_bits + 2) // 2
    return [(64 * i // n, 64 * (i + 1) // n) for i in range(n)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _variants(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(fp, wild, key): every one-wildcard variant of every segment; wild is the bit left out of the 64."""
    masks = [((1 << hi) - (1 << lo)) & ~(1 << w) for lo, hi in _segments(max_bits) for w in range(lo, hi)]
    return nodes.select("fp", F.posexplode(F.array(*[_signed(m) for m in masks])).alias("wild", "mask")).select(
        "fp", "wild", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))


def links(nodes: DataFrame, max_bits: int = 2, bucket_max: int = 64) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) within ``max_bits``: every pair that meets in a bucket
    of up to ``bucket_max``, and a chain with the same components for larger buckets."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2: midpoints one flip away cover no more")
    bucket = Window.partitionBy("wild", "key")   # one shuffle of the variants; a big bucket spills
    meet = materialise(_variants(nodes, max_bits).withColumn("n", F.count("*").over(bucket)).filter("n > 1"),
                       "simhash-members")
    small = meet.filter(F.col("n") <= bucket_max)
    a = small.select("wild", "key", F.col("fp").alias("a"))
    b = small.select("wild", "key", F.col("fp").alias("b"))
    # a pair with equal segments meets under each wildcard: the segment's first is enough
    flipped = _signed(1).bitwiseAND(F.call_function("shiftright", F.col("a").bitwiseXOR(F.col("b")), F.col("wild"))) != 0
    first = flipped | F.col("wild").isin([lo for lo, _ in _segments(max_bits)])
    pairs = a.join(b, ["wild", "key"]).filter((F.col("a") < F.col("b")) & first &
                                              (differing(F.col("a"), F.col("b")) <= max_bits)).select("a", "b")
    dense = meet.filter(F.col("n") > bucket_max).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i).cast("long")
                                            for i in range(64 if max_bits == 2 else 0)])
    mids = dense.select("fp", F.explode(flips).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("mid"))
    low = mids.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("mid", "a")
    chain = mids.join(low, "mid").filter("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.unionAll(chain).distinct()


def _rooted(nodes: DataFrame, max_bits: int, bucket_max: int) -> DataFrame:
    """(fp, __min, root): the distinct fingerprints (fp, __min) with a fingerprint that names their component."""
    comp = components(links(nodes.select("fp"), max_bits, bucket_max))
    return nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "__min", F.coalesce("root", "fp").alias("root"))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
                   bucket_max: int = 64, salts: int = 64) -> DataFrame:
    """(id, fingerprint, component_id) per row: the fingerprint as 16 hex digits, the component's smallest id."""
    rows = materialise(fingerprints(df, id_col, text_col, shingle).withColumn(
        "__salt", F.pmod(F.xxhash64("__id"), F.lit(salts)).cast("int")), "simhash-rows")
    first = rows.groupBy("__fp", "__salt").agg(F.min("__id").alias("__min"))
    nodes = materialise(first.groupBy(F.col("__fp").alias("fp")).agg(F.min("__min").alias("__min")), "simhash-nodes")
    rooted = _rooted(nodes, max_bits, bucket_max)
    best = rooted.groupBy("root").agg(F.min("__min").alias("__comp"))
    of = rooted.join(best, "root").select(F.col("fp").alias("__fp"), "__comp")
    keyed = first.select("__fp", "__salt").join(of, "__fp")
    return rows.join(keyed, ["__fp", "__salt"]).select(
        F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
        F.col("__comp").alias("component_id"))


def drop_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
              bucket_max: int = 64) -> DataFrame:
    """One row of each component: the one with the smallest id (null ids last), then the smallest SHA-256 of the text;
    columns unchanged.  A row is known by id and text, so unrelated rows with a null or the same id all stay."""
    rows = fingerprints(df, id_col, text_col, shingle, digest=True)
    row = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__sha").alias("sha"))
    nodes = materialise(rows.groupBy(F.col("__fp").alias("fp")).agg(F.min(row).alias("__min")), "simhash-nodes")
    best = _rooted(nodes, max_bits, bucket_max).groupBy("root").agg(F.min("__min").alias("__min"))
    stay = best.select(F.col("__min.id").alias("__id"), F.col("__min.sha").alias("__sha"))
    src = df.withColumns({"__id": F.col(id_col), "__sha": _sha(text_col)})
    one = Window.partitionBy("__id", "__sha").orderBy(F.col(text_col).isNull())   # fully repeated rows only
    return (src.join(stay, same(src, stay, ["__id", "__sha"]), "left_semi").withColumn("__rn", F.row_number().over(one))
            .filter("__rn = 1").select(*[f"`{c}`" for c in df.columns]))
