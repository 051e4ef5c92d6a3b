"""Hard negatives: cover-tree search under score windows.

Each anchor's positives are its best rows of its own label; the hard negatives of (anchor, positive) are the best rows of
other labels whose score lies between two shares of the positive's.  Both are the same exact search: best rows within a
window of scores.

The top level of the index is fitted on ``sample_rows`` rows (a bounded sample, smallest hashes of the row): ``tops`` centres,
picked farthest first, and the labels met most often.  Every row belongs to the cell of its label's group (a frequent label
alone, others by hash) and its nearest centre.  Cells in order make up lanes, one a task: a large cell is split by hash into
several.  A lane's rows stand in shards of at most ``shard_rows``, each of one group and with a cover tree (cover_tree.py) of
its own; so the positives of an anchor are looked for among its label's group only, its negatives not among its label's.

Anchors travel in packed blocks to the lanes of those cells whose covering angle lets a row fall into one of their windows;
the sample gives each window a first lower limit.  A lane's trees are descended by many anchors together, leaves are exact
matrix products, and what was found in one shard narrows the windows for the next.  A lane sends on the best rows of each
window; the best of all lanes are merged block by block.

Defined cases: rows with a null id, label or vector, or a null component, take no part; a vector shorter than the longest
counts as filled up with zeros; a zero vector scores 0; repeated rows and ids are rows of their own, known by a row
number, so a row never is its own positive but its copy may be; equal scores are ordered by id; an anchor without
positives, or a window without rows, gives no row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_arrow_batches, materialise
from .cover_tree import HIGHEST, LOWEST, Best, CoverTree, angle_bounds, cover, covering_angle, exact_type

FOUND = "anchor_uid long, number long, rank int, score long, id long"
PARTS = "block string, anchors binary, numbers binary, counts binary, scores binary, ids binary"
#: Labels with a group of their own, and groups that the others share.
OWN, SHARED = 64, 64
#: Bytes of vectors that a lane's task holds, as 4-byte floats.
LANE_BYTES = 1 << 27
#: Anchors that descend together.
TOGETHER = 1024


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as an integer matrix, filled up with zeros."""
    n = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim) < n[:, None]] = flat
    return out


def _unpacked(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    """A column of packed vectors as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


class _Sample:
    """The bounded sample, the tops and the labels picked from it."""

    def __init__(self, rows: list, dim: int, tops: int):
        self.dim = dim
        self.x = np.zeros((len(rows), dim), np.int64)
        for i, r in enumerate(rows):
            self.x[i, :len(r["vec"])] = r["vec"]
        self.uids = np.array([r["uid"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        picked, _ = cover(self.x.astype(np.float64), 0.0, tops)
        self.tops = self.x[picked].astype(np.float64)
        names, n = np.unique(self.labels, return_counts=True)
        self.own = np.sort(names[np.argsort(-n, kind="stable")[:OWN]])

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return (np.einsum("ij,ij->i", self.tops, self.tops) - 2 * (x @ self.tops.T)).argmin(axis=1)

    def groups(self, labels: np.ndarray) -> np.ndarray:
        """Of each label: its own group's number, or from ``OWN`` on one that it shares."""
        at = np.minimum(np.searchsorted(self.own, labels), len(self.own) - 1)
        mixed = labels.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        return np.where(self.own[at] == labels, at, OWN + (mixed % np.uint64(SHARED)).astype(np.int64))

    def limits(self, q: np.ndarray, windows: np.ndarray, k: int, same: bool, norm: float) -> np.ndarray:
        """A lower limit for each window's k best rows: the sample's k-th best."""
        least, most = windows[:, 4], windows[:, 5]
        if len(self.x) < k or not len(windows):
            return least
        kind = exact_type(norm * norm)
        s = (q.astype(kind) @ self.x.T.astype(kind))[windows[:, 0]]
        fit = (self.labels == windows[:, 2, None]) == same
        # a limit that the type can't hold is beyond all scores, rounded or not
        fit &= (s >= least.astype(kind)[:, None]) & (s <= most.astype(kind)[:, None])
        if same:
            fit &= self.uids != windows[:, 1, None]
        s[~fit] = LOWEST
        s = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        return np.where(fit.sum(axis=1) >= k, np.maximum(least, s.astype(np.int64)), least)


def _assign(sample: _Sample, kind: str):
    def run(batches):
        for b in batches:
            x = _matrix(b.column("vec"), sample.dim)
            f = x.astype(np.float64)
            top = sample.nearest(f)
            gap = f - sample.tops[top]
            packed = np.ascontiguousarray(x.astype(kind)).view(f"V{sample.dim * np.dtype(kind).itemsize}").ravel()
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("uid", "id", "label", "anchor")), pa.array([v.tobytes() for v in packed], pa.binary()),
                 pa.array(sample.groups(b.column("label").to_numpy()).astype(np.int32)), pa.array(top.astype(np.int32)),
                 pa.array(np.einsum("ij,ij->i", gap, gap)), pa.array(np.einsum("ij,ij->i", f, f))],
                names=["uid", "id", "label", "anchor", "vec", "grp", "top", "gap2", "norm2"])
    return run


def _send(sample: _Sample, cells: list, norm: float, kind: str, k: int, same: bool):
    """Blocks of anchors -> (lane, block, queries, windows): for each lane, the anchors that may find rows there."""
    where = np.array([c["top"] for c in cells], np.int64)
    group = np.array([c["grp"] for c in cells], np.int64)
    lanes = max(c["lane"] + c["parts"] for c in cells)
    tops = np.unique(where)
    centre = sample.tops[tops]
    # in the augmented space the last components of centre and row differ too, by less than this
    own = np.array([max(norm ** 2 - c @ c, 0) ** 0.5 for c in sample.tops])
    reach = np.zeros(len(sample.tops))
    for c in cells:
        tail = max(abs(max(norm ** 2 - c[v], 0) ** 0.5 - own[c["top"]]) for v in ("norm2", "least2"))
        reach[c["top"]] = max(reach[c["top"]], (c["gap2"] + tail * tail) ** 0.5)
    turn = covering_angle(reach[tops], norm)
    at = np.searchsorted(tops, where)
    known = {}

    def reached(g):
        """For each top the lanes with cells of it where an anchor of group ``g`` looks."""
        if g not in known:
            known[g] = np.zeros((len(tops), lanes), np.float32)
            for i in np.flatnonzero(group == g if same else (group != g) | (g >= OWN)):
                known[g][at[i], cells[i]["lane"]:cells[i]["lane"] + cells[i]["parts"]] = 1
        return known[g]

    def run(batches):
        for b in batches:
            for block, anchors in zip(b.column("block").to_pylist(), b.column("anchors")):
                a = anchors.values
                q = _unpacked(a.field("vec"), kind, sample.dim)
                uid, label, grp = (a.field(c).to_numpy() for c in ("uid", "label", "grp"))
                row = np.repeat(np.arange(len(q)), pc.list_value_length(a.field("number")).to_numpy())
                w = np.stack([row, uid[row], label[row], *(a.field(c).flatten().to_numpy() for c in ("number", "least", "most"))],
                             axis=1)
                w = w[w[:, 4] <= w[:, 5]]
                if not len(w):
                    continue
                w[:, 4] = sample.limits(q, w, k, same, norm)
                f = q.astype(np.float64)
                up, low = angle_bounds(f @ centre.T, np.sqrt(np.einsum("ij,ij->i", f, f)), norm, turn)
                may = np.zeros((len(q), len(tops)), np.float32)
                np.maximum.at(may, w[:, 0], (up[w[:, 0]] >= w[:, 4, None]) & (low[w[:, 0]] <= w[:, 5, None]))
                go = np.zeros((len(q), lanes), bool)
                for g in np.unique(grp).tolist():
                    go[grp == g] = may[grp == g] @ reached(g) > 0
                go[np.bincount(w[:, 0], minlength=len(q)) == 0] = False
                for lane in np.flatnonzero(go.any(axis=0)).tolist():
                    rows = go[:, lane]
                    mine = w[rows[w[:, 0]]]
                    mine[:, 0] = (np.cumsum(rows) - 1)[mine[:, 0]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lane], pa.int32()), pa.array([block]), pa.array([q[rows].tobytes()], pa.binary()),
                         pa.array([mine.tobytes()], pa.binary())], names=["lane", "block", "queries", "windows"])
    return run


class _Lane:
    """A lane's trees, and the blocks of anchors that wait to descend them."""

    def __init__(self, k: int, same: bool, shard_rows: int):
        self.k, self.same, self.shard_rows = k, same, shard_rows
        self.trees, self.rows, self.held, self.group, self.blocks, self.asked = [], [], 0, None, [], 0

    def take(self, group: int, x: np.ndarray, ids: np.ndarray, uids: np.ndarray, labels: np.ndarray):
        """Adjacent rows of one group."""
        if group != self.group:
            self.plant()
        self.group = group
        lo = 0
        while lo < len(x):
            hi = min(len(x), lo + self.shard_rows - self.held)
            self.rows.append(tuple(c[lo:hi] for c in (x, ids, uids, labels)))
            self.held += hi - lo
            if self.held == self.shard_rows:
                self.plant()
            lo = hi

    def plant(self):
        if self.held:
            self.trees.append(CoverTree(*(np.concatenate(c) for c in zip(*self.rows))))
        self.rows, self.held = [], 0

    def ask(self, block: str, queries: np.ndarray, windows: np.ndarray):
        self.blocks.append((block, queries, windows))
        self.asked += len(queries)
        if self.asked >= TOGETHER:
            yield from self.answer()

    def answer(self):
        """For each waiting block its windows' best rows, packed."""
        self.plant()
        blocks, self.blocks, self.asked = self.blocks, [], 0
        if not blocks or not self.trees:
            return
        queries, windows = (np.concatenate(c) for c in list(zip(*blocks))[1:])
        windows = windows.copy()
        ends = np.cumsum([len(w) for _, _, w in blocks])
        windows[:, 0] += np.repeat(np.cumsum([0, *(len(q) for _, q, _ in blocks[:-1])]), [len(w) for _, _, w in blocks])
        best = Best(queries, windows, self.k, self.same)
        for tree in self.trees:
            tree.look(best)
        w, score, ids, _ = best.settle()
        for (block, _, mine), hi in zip(blocks, ends.tolist()):
            lo = hi - len(mine)
            a, z = np.searchsorted(w, (lo, hi))
            if a == z:
                continue
            count = np.bincount(w[a:z] - lo, minlength=len(mine))
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), *(pa.array([np.ascontiguousarray(v, np.int64).tobytes()], pa.binary())
                                      for v in (mine[some, 1], mine[some, 3], count[some], score[a:z], ids[a:z]))],
                names=[c.split()[0] for c in PARTS.split(", ")])


def _search(dim: int, kind: str, k: int, same: bool, shard_rows: int):
    """Lanes in order, each first its rows, then its blocks -> the best rows per window."""
    def run(batches):
        at, lane = None, None
        for b in batches:
            lanes, kinds = b.column("lane").to_numpy(), b.column("kind").to_numpy()
            groups = b.column("grp").to_numpy(zero_copy_only=False)   # null, so not a number, for blocks
            cuts = np.flatnonzero(np.r_[True, (lanes[1:] != lanes[:-1]) | (kinds[1:] != kinds[:-1]) | (groups[1:] != groups[:-1])])
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), b.num_rows]):
                if lanes[lo] != at:
                    if lane:
                        yield from lane.answer()
                    at, lane = lanes[lo], _Lane(k, same, shard_rows)
                part = b.slice(lo, hi - lo)
                if kinds[lo] == 0:
                    lane.take(int(groups[lo]), _unpacked(part.column("vec"), kind, dim),
                              *(part.column(c).to_numpy() for c in ("id", "uid", "label")))
                    continue
                for block, queries, windows in zip(*(part.column(c).to_pylist() for c in ("block", "queries", "windows"))):
                    yield from lane.ask(block, np.frombuffer(queries, kind).reshape(-1, dim),
                                        np.frombuffer(windows, np.int64).reshape(-1, 6))
        if lane:
            yield from lane.answer()
    return run


def _merge(k: int, hold: int = 1 << 20):
    """The best rows of all lanes, blocks in order -> the k best of each window."""
    def best(parts):
        uid, number, score, ids = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((ids, ~score, number, uid))
        uid, number = uid[order], number[order]
        start = np.flatnonzero(np.r_[True, (uid[1:] != uid[:-1]) | (number[1:] != number[:-1])])
        rank = np.arange(len(uid)) - np.repeat(start, np.diff(np.r_[start, len(uid)]))
        keep = rank < k
        return (uid[keep], number[keep], score[order][keep], ids[order][keep]), rank[keep]

    def batch(parts):
        (uid, number, score, ids), rank = best(parts)
        return pa.RecordBatch.from_arrays([*map(pa.array, (uid, number, (rank + 1).astype(np.int32), score, ids))],
                                          names=["anchor_uid", "number", "rank", "score", "id"])

    def run(batches):
        at, parts, held = None, [], 0
        for b in batches:
            for block, *packed in zip(*(b.column(c).to_pylist() for c in range(b.num_columns))):
                if block != at:
                    if parts:
                        yield batch(parts)
                    at, parts, held = block, [], 0
                uid, number, count, score, ids = (np.frombuffer(v, np.int64) for v in packed)
                parts.append((np.repeat(uid, count), np.repeat(number, count), score, ids))
                held += len(score)
                if held > hold:
                    parts = [best(parts)[0]]
                    held = 0
        if parts:
            yield batch(parts)
    return run


def _lanes(cells: list, lane_rows: int) -> list:
    """The cells, in order of group and top, with the lanes that hold them: each as many cells as fit, a large cell several."""
    out, lane, held = [], -1, lane_rows
    for c in sorted(cells, key=lambda c: (c["grp"], c["top"])):
        parts = -(-c["n"] // lane_rows)
        if parts > 1 or held + c["n"] > lane_rows:
            lane, held = lane + 1, 0
        out.append(c | {"lane": lane, "parts": parts})
        lane, held = (lane + parts - 1, lane_rows) if parts > 1 else (lane, held + c["n"])
    return out


def _percent_floor(column: str, percent: int) -> Column:
    """floor(percent * column / 100) in integers, without a product beyond the column's own size."""
    rest = f"pmod({column}, 100)"
    return F.expr(f"({percent}) * (({column} - {rest}) div 100) + ((({percent}) * {rest}) - pmod(({percent}) * {rest}, 100)) div 100")


class VectorIndex:
    """Every row of (uid, id, label, vec, anchor), under its cell and lane."""

    def __init__(self, rows: DataFrame, tops: int, sample_rows: int, shard_rows: int):
        spark = rows.sparkSession
        bound_arrow_batches(spark)
        self.shard_rows = shard_rows
        dim, least, most = rows.agg(F.max(F.size("vec")), F.min(F.array_min("vec")), F.max(F.array_max("vec"))).first()
        self.dim = max(dim or 0, 1)
        self.kind = next(t for t in ("int16", "int32", "int64")
                         if (least or 0) >= np.iinfo(t).min and (most or 0) <= np.iinfo(t).max)
        few = rows.orderBy(F.xxhash64("id", "uid"), "uid").limit(sample_rows).collect()
        self.empty = not few
        if self.empty:
            return
        self.sample = _Sample(few, self.dim, tops)
        self.rows = materialise(rows.mapInArrow(
            _assign(self.sample, self.kind), "uid long, id long, label long, anchor boolean, vec binary, grp int, top int, "
            "gap2 double, norm2 double"), "negatives-rows")
        # at most ``tops`` times OWN + SHARED rows
        cells = [r.asDict() for r in self.rows.groupBy("grp", "top").agg(
            F.count("*").alias("n"), F.max("gap2").alias("gap2"), F.max("norm2").alias("norm2"),
            F.min("norm2").alias("least2")).collect()]
        self.norm = max(c["norm2"] for c in cells) ** 0.5
        # three lanes a core at least, but none beyond what a task may hold
        even = -(-sum(c["n"] for c in cells) // (3 * spark.sparkContext.defaultParallelism))
        self.cells = _lanes(cells, max(shard_rows // 4, 1, min(even, max(shard_rows, LANE_BYTES // (4 * self.dim)))))
        self.lanes = max(c["lane"] + c["parts"] for c in self.cells)
        named = json.dumps([{k: c[k] for k in ("grp", "top", "lane", "parts")} for c in self.cells])
        lanes = spark.range(0, 1, 1, 1).select(F.inline(F.from_json(
            F.lit(named), "array<struct<grp: int, top: int, lane: int, parts: int>>")))
        self.points = self.rows.join(F.broadcast(lanes), ["grp", "top"]).withColumn(
            "lane", (F.col("lane") + F.pmod(F.xxhash64("uid"), F.col("parts"))).cast("int")).select(
            "lane", F.lit(0).alias("kind"), "grp", "top", "id", "uid", "label", "vec")

    def best(self, anchors: DataFrame, k: int, same: bool, block: int = 256) -> DataFrame:
        """(anchor_uid, number, rank, score, id): the k best rows for each window of the anchors (uid, label, vec, grp, top,
        number array, least array, most array)."""
        n = {r["top"]: r["n"] for r in anchors.groupBy("top").count().withColumnRenamed("count", "n").collect()}
        parts = F.create_map(*[F.lit(v) for t in sorted({c["top"] for c in self.cells}) for v in (t, -(-n.get(t, 1) // block))])
        name = F.concat_ws("-", F.col("top"), F.pmod(F.xxhash64("uid", F.lit(1)), parts[F.col("top")]))
        blocks = anchors.groupBy(name.alias("block")).agg(
            F.collect_list(F.struct("uid", "label", "grp", "vec", "number", "least", "most")).alias("anchors"))
        sent = blocks.mapInArrow(_send(self.sample, self.cells, self.norm, self.kind, k, same),
                                 "lane int, block string, queries binary, windows binary")
        both = self.points.unionByName(sent.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        found = both.repartitionById(self.lanes, F.col("lane")).sortWithinPartitions(
            "lane", "kind", "grp", "top", "id", "block").mapInArrow(
            _search(self.dim, self.kind, k, same, self.shard_rows), PARTS)
        partitions = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return found.repartition(partitions, "block").sortWithinPartitions("block").mapInArrow(_merge(k), FOUND)


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "vec", label_col: str = "label",
                   positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90,
                   tops: int = 64, sample_rows: int = 2048, shard_rows: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds.
    ``vec_col`` holds integers; scores are integer inner products."""
    rows = df.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()
                     & ~F.coalesce(F.exists(vec_col, lambda v: v.isNull()), F.lit(False)))
    rows = materialise(rows.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<long>").alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("anchor")), "negatives-input")
    index = VectorIndex(rows, tops, sample_rows, shard_rows)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if index.empty:
        return df.sparkSession.createDataFrame([], schema)
    anchors = materialise(index.rows.filter("anchor").select("uid", "id", "label", "vec", "grp", "top"), "negatives-anchors")
    one = {"number": F.array(F.lit(0).cast("long")), "least": F.array(F.lit(LOWEST)), "most": F.array(F.lit(HIGHEST))}
    near = materialise(index.best(anchors.withColumns(one), positives, same=True).select(
        F.col("anchor_uid").alias("uid"), F.col("rank").cast("long").alias("number"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score")), "negatives-positives")
    # 100 * score between the two percentages of the positive's, in integers
    low, high = (_percent_floor("positive_score", p) for p in (-least_percent, most_percent))
    least, most = -low, high
    window = F.collect_list(F.struct("number", least.alias("least"), most.alias("most"))).alias("w")
    asked = anchors.join(near.groupBy("uid").agg(window), "uid").select(
        "uid", "id", "label", "vec", "grp", "top", *[F.col(f"w.{c}").alias(c) for c in ("number", "least", "most")])
    found = index.best(asked, negatives, same=False).select(
        F.col("anchor_uid").alias("uid"), "number", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select("uid", F.col("id").alias("anchor_id"))
    return found.join(near.join(ids, "uid"), ["uid", "number"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
