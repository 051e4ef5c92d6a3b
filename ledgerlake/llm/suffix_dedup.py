"""Suffix-array removal of repeated byte strings.

Every byte covered by a ``window``-byte string (200) that also starts anywhere else, same document included, is removed;
strings are judged on the input and never cross documents.

1. Every window has an anchor: among its ``anchor``-byte substrings the one with the smallest hash, the leftmost of
   equals.  It depends on the window's bytes alone, so equal windows have equal anchors in the same place.  Neighbouring
   windows with one anchor form a fragment (about 50 window starts for anchors of half the window).
2. Anchors that occur once are dropped by an aggregation over anchor hashes and a join; of the rest, equal fragments
   are counted together by (anchor, 64-bit hash of the fragment).  A fragment that occurs twice is repeated whole.
3. The distinct fragments of one anchor form one string; a suffix array over it (see grouping_sa.py) puts equal windows
   next to each other.  Many strings of like size are sorted together in a task.
4. Anchors with over ``lane_max`` distinct fragments (the edges of a passage met in very many contexts) are not gathered:
   their fragments are cut again as texts of their own, by anchors three quarters of the way from this length to the
   window's, and go through the same steps.  Each level leaves a quarter of the stretch in which a passage's edge lies,
   what lies inside the passage becomes equal fragments, and at anchors as long as the window every fragment is one window.
   A level's result is written, so no query holds the joins of more than one level.
5. Repeated starts go back to all occurrences of their fragment, and then to the documents.

Rows are told apart by their id if the ids are whole numbers without nulls or repeats, else by a 128-bit content key of (id,
text).  Texts are shuffled twice: to cut fragments, and to remove bytes.

Hot keys: anchors and fragments are counted with partial aggregation; in the joins back to occurrences a key with over a
thousandth of all rows (so at most a thousand keys) is looked up by broadcast and never meets in one task.

Defined cases: a null text is empty; a text shorter than the window keeps everything; a text that occurs twice
repeats itself whole; repeated rows count as separate places; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_arrow_batches, materialise
from .grouping_sa import repeated_windows

BUFFER = 400_000         # bytes hashed together
LANE_BYTES = 500_000     # bytes suffix-sorted together
HOT_KEYS = 1_000         # keys looked up by broadcast at most
MULTIPLIER = 0x9E3779B97F4A7C15
KEY = ["__k1", "__k2"]


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Anchors:
    """Cuts texts into fragments of equal anchor."""

    def __init__(self, window: int, anchor: int):
        self.window, self.anchor = window, anchor
        n = BUFFER + 2 * window + 1
        self.power, self.inverse = _powers(MULTIPLIER, n), _powers(pow(MULTIPLIER, -1, 1 << 64), n)

    def pieces(self, texts):
        """(row, offset, bytes) with at most BUFFER window starts each; a window lies whole in one piece."""
        for row, b in enumerate(texts):
            for at in range(0, len(b) - self.window + 1, BUFFER):
                yield row, at, b[at:at + BUFFER + self.window - 1]

    def buffers(self, texts):
        held, size = [], 0
        for piece in self.pieces(texts):
            if size + len(piece[2]) > BUFFER + self.window - 1:
                yield held
                held, size = [], 0
            held.append(piece)
            size += len(piece[2])
        if held:
            yield held

    def fragments(self, held):
        """Of one buffer: (row, start in its text, start and stop in the buffer, window starts, anchor hash), buffer."""
        raw = b"".join(p[2] for p in held)
        text, n, w, k = np.frombuffer(raw, np.uint8), len(raw), self.window, self.anchor
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(text * self.power[:n], out=sums[1:])
        gram = _mix((sums[k:] - sums[:-k]) * self.inverse[:n - k + 1])
        low = np.uint64((1 << 24) - 1)
        least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
        span, have = w - k + 1, 1
        while 2 * have <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        starts = n - w + 1
        least = np.minimum(least[:starts], least[span - have:span - have + starts])
        at = (least & low).astype(np.int64)
        lengths = np.array([len(p[2]) for p in held])
        stops = np.cumsum(lengths)
        piece = np.repeat(np.arange(len(held)), lengths)[:starts]
        inside = np.arange(starts) + w <= stops[piece]
        new = np.ones(starts, bool)
        new[1:] = (at[1:] != at[:-1]) | (piece[1:] != piece[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, starts))
        first, count = first[inside[first]], count[inside[first]]
        own = piece[first]
        begin = first - (stops - lengths)[own] + np.array([p[1] for p in held])[own]
        row = np.array([p[0] for p in held])[own]
        return row, begin, first, first + count + w - 1, count, gram[at[first]].view(np.int64), raw


def _texts(column) -> list[bytes]:
    return [t.as_py() or b"" for t in column]


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    one = df.groupBy(F.col(id_col).alias("__id")).count().filter("count > 1 or __id is null")
    if df.schema[id_col].dataType.typeName() in ("long", "integer", "short", "byte") and one.isEmpty():
        k1, k2 = F.col(id_col).cast("long"), F.lit(0).cast("long")
    else:
        k1, k2 = F.xxhash64(F.col(id_col), text), F.xxhash64(text, F.col(id_col), F.lit(1))
    return df.select(F.col(id_col).alias("__id"), k1.alias("__k1"), k2.alias("__k2"), text.cast("binary").alias("__text"))


def _occurrences(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(k1, k2, start, n, anchor, frag): every fragment of every text."""
    def run(batches):
        cut = Anchors(window, anchor)
        for b in batches:
            texts, k1, k2 = _texts(b.column(2)), b.column(0).to_numpy(), b.column(1).to_numpy()
            for held in cut.buffers(texts):
                row, begin, lo, hi, count, hashes, raw = cut.fragments(held)
                whole = np.array([xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(lo.tolist(), hi.tolist())],
                                 np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (k1[row], k2[row], begin, count.astype(np.int32), hashes, whole)],
                    names=[*KEY, "start", "n", "anchor", "frag"])
    return docs.select(*KEY, "__text").mapInArrow(
        run, "__k1 long, __k2 long, start long, n int, anchor long, frag long")


def _fragment_bytes(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(anchor, frag, once, bytes, d) of the wanted fragments, cut from one text that has them."""
    asked = wanted.groupBy(F.col("rep.__k1").alias("__k1"), F.col("rep.__k2").alias("__k2")).agg(
        F.collect_list(F.struct(F.col("rep.start").alias("start"), "n", "anchor", "frag", "once", "d")).alias("asked"))

    def run(batches):
        for b in batches:
            for t, asked_ in zip(_texts(b.column(0)), b.column(1)):
                a = asked_.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["anchor"] for x in a], pa.int64()), pa.array([x["frag"] for x in a], pa.int64()),
                     pa.array([x["once"] for x in a], pa.bool_()),
                     pa.array([t[x["start"]:x["start"] + x["n"] + window - 1] for x in a], pa.binary()),
                     pa.array([x["d"] for x in a], pa.int64())], names=["anchor", "frag", "once", "bytes", "d"])
    return docs.join(asked, KEY).select("__text", "asked").mapInArrow(
        run, "anchor long, frag long, once boolean, bytes binary, d long")


def _true_ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _sorted_lanes(frags: DataFrame, window: int) -> DataFrame:
    """(anchor, frag, lo, hi): ranges of repeated window starts, for fragments that occur once.

    A batch of strings takes as many steps as its longest, so strings come by their number of fragments."""
    def solve(lanes):
        out = ([], [], [], [])
        lanes = [lane for lane in lanes if len(lane[1]) > 1]
        if lanes:
            for (anchor, members), flags in zip(lanes, repeated_windows([[x[2] for x in m] for _, m in lanes], window)):
                for (frag, once, _), flag in zip(members, flags):
                    for lo, hi in _true_ranges(flag) if once else ():
                        for column, v in zip(out, (anchor, frag, lo, hi)):
                            column.append(v)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                           pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())],
                                          names=["anchor", "frag", "lo", "hi"])

    def run(batches):
        lanes, size, last = [], 0, None
        for b in batches:
            for anchor, frag, once, data, _ in zip(*(c.to_pylist() for c in b.columns)):
                if anchor != last:
                    if size > LANE_BYTES:
                        yield solve(lanes)
                        lanes, size = [], 0
                    lanes.append((anchor, []))
                    last = anchor
                members = lanes[-1][1]
                if members and members[-1][0] == frag:
                    continue                       # repeated rows deliver a fragment twice
                members.append((frag, once, data))
                size += len(data)
        if lanes:
            yield solve(lanes)
    parts = int(frags.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (frags.repartition(parts, "anchor").sortWithinPartitions("d", "anchor", "frag")
            .mapInArrow(run, "anchor long, frag long, lo int, hi int"))


def _join_counted(rows: DataFrame, keys: DataFrame, on: list[str], count: str) -> DataFrame:
    """``rows`` joined to ``keys``, a written table with one row a key and the key's number of ``rows`` in ``count``."""
    limit = max(1, rows.count() // HOT_KEYS)
    hot = F.broadcast(keys.filter(F.col(count) > limit))
    return (rows.join(hot, on)
            .unionByName(rows.join(hot.select(*on), on, "left_anti").join(keys.filter(F.col(count) <= limit), on)))


def repeated_starts(docs: DataFrame, window: int, anchor: int, lane_max: int) -> DataFrame:
    """(k1, k2, ranges array<struct<lo, hi>>) of the texts with repeated windows: their starts, half-open ranges."""
    every = materialise(_occurrences(docs, window, anchor), "suffix-occurrences")
    shared = materialise(every.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1"), "suffix-anchors")
    here = materialise(_join_counted(every, shared, ["anchor"], "c").drop("c"), "suffix-shared")
    frags = here.groupBy("anchor", "frag").agg(F.count("*").alias("m"), F.min(F.struct(*KEY, "start")).alias("rep"),
                                               F.min("n").alias("n"))
    frags = materialise(frags.withColumn("once", F.col("m") == 1), "suffix-fragments")
    whole = frags.filter(~F.col("once")).select("anchor", "frag", F.lit(0).alias("lo"), F.col("n").alias("hi"), "m")
    found = _join_counted(here, whole, ["anchor", "frag"], "m").drop("m")
    if anchor < window:   # else a fragment is one window
        lanes = frags.groupBy("anchor").agg(F.count("*").alias("d"), F.max("once").alias("open")).filter(
            "d > 1 and open").select("anchor", "d")   # without a fragment that occurs once nothing is left to find
        wanted = _join_counted(frags, materialise(lanes, "suffix-lanes"), ["anchor"], "d")
        data = materialise(_fragment_bytes(docs, wanted, window), "suffix-bytes")
        parts = _sorted_lanes(data.filter(F.col("d") <= lane_max), window)
        dense = data.filter(F.col("d") > lane_max)
        if not dense.isEmpty():
            dense = materialise(dense.dropDuplicates(["anchor", "frag"]).select(
                F.col("anchor").alias("__k1"), F.col("frag").alias("__k2"), F.col("bytes").alias("__text"), "once"),
                "suffix-dense")
            deeper = repeated_starts(dense, window, anchor + (3 * (window - anchor) + 3) // 4, lane_max).join(
                dense.filter("once").select(*KEY), KEY, "left_semi")     # the others are repeated whole
            parts = parts.unionAll(deeper.select(F.col("__k1").alias("anchor"), F.col("__k2").alias("frag"),
                                                 F.inline("ranges")))
        found = found.unionByName(here.join(parts, ["anchor", "frag"]))
    found = found.groupBy(*KEY).agg(F.collect_list(F.struct(
        (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))).alias("ranges"))
    return materialise(found, "suffix-starts")


def covered(ranges: list[tuple[int, int]], window: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under windows starting in the half-open ranges."""
    runs: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi - 1 + window)
        else:
            runs.append([lo, hi - 1 + window])
    return [(a, b) for a, b in runs]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 200, anchor: int = 100,
                   lane_max: int = 16) -> DataFrame:
    """(id, n_bytes, removed array<struct<start, len>>, kept binary), one row per input row."""
    if not 1 <= anchor <= window:
        raise ValueError("the anchor must fit the window")
    bound_arrow_batches(df.sparkSession)
    docs = _docs(df, id_col, text_col)
    id_type = docs.schema["__id"].dataType.simpleString()
    starts = repeated_starts(docs, window, anchor, lane_max)

    def run(batches):
        for b in batches:
            removed, kept, sizes = [], [], []
            for t, ranges in zip(_texts(b.column(1)), b.column(2)):
                runs = covered([(r["lo"], r["hi"]) for r in ranges.as_py() or ()], window)
                edges = [0, *(x for run_ in runs for x in run_), len(t)]
                kept.append(b"".join(t[i:j] for i, j in zip(edges[::2], edges[1::2])))
                removed.append([{"start": i, "len": j - i} for i, j in runs])
                sizes.append(len(t))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("len", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["__id", "n_bytes", "removed", "kept"])
    out = docs.join(starts, KEY, "left").select("__id", "__text", "ranges").mapInArrow(
        run, f"__id {id_type}, n_bytes long, removed array<struct<start:bigint,len:bigint>>, kept binary")
    return out.withColumnRenamed("__id", id_col)
