"""Exact n-gram Jaccard join in the metric space of shingle sets (distance 1 - Jaccard).

Sets that are equal are one node.  Two nodes link when their Jaccard similarity is at least ``percent`` / 100, that is when
their distance is at most r.

Unrelated texts share no shingle and are all at distance 1 from any pivot, so pivots alone cannot tell them apart.  The
first regions are therefore cells of *projections*: the shingle universe is cut by hash into more parts than two linked
sets can have differing shingles, so linked sets agree on a whole part, which is their cell.  How many shingles may differ
depends on the sizes: sizes fall into classes, and a set near the end of its class is also listed in the next one.  Only
sets that meet another in a cell are made again from their texts and kept.  A cell's first pivot is its least node, and
all cells of one pivot are one region.

Regions are then joined recursively, all regions of a round at once:

1. each region takes pivots (the first round its least node, later small regions one and large ones ``pivots``, first from
   the rarest components); each member's distance to its region's pivots is computed exactly, once per pair over all
   regions, and gives links;
2. members go to the Voronoi region of their nearest pivot, and are replicated into the region of every other pivot that is
   at most 2 r farther (a partner within r cannot be nearer to a third pivot otherwise); a region that this would more
   than double stays one;
3. pivots are done and leave; a region whose members are one component already has nothing left to find and leaves too;
4. after ``stars`` rounds, regions of up to ``local`` members are joined in one task by exact intersections, between members
   of different components whose distances to the pivot differ by at most r (triangle inequality); others go to step 1.

A large region that does not shrink is dealt into pairs of hashed blocks, an exact way for texts that agree on a part, are
near one another and still do not link.

Defined cases: a null text counts as empty; no words: empty set, linked with nothing; fewer words than the shingle length:
one shingle of all words; repeated rows are separate rows of one component; null ids sort last and a component of null ids
only has a null id; an empty table gives an empty result; other columns are ignored.  A shingle is known by 64 bits made
from its words' XXH3 hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_arrow_batches, discard, materialise, same
from .graph import components

_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def shingle_set(text: str | None, shingle: int = 3) -> np.ndarray:
    """The distinct shingles of a text, sorted, 64 bits each."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, _U)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    size = min(shingle, len(words))
    h = np.full(len(words) - size + 1, size, _U)
    for j in range(size):
        h = h * _U(0x9E3779B97F4A7C15) + w[j:len(w) - size + 1 + j]
    return np.unique(mix(h))


class Cells:
    """The cells of sets at a similarity of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent, self.miss = percent, 100 - percent
        # a set that differs from a linked one has so many shingles at least
        self.least = -(-percent // self.miss) if self.miss else 1 << 62
        self.bounds = [self.least]

    def size_class(self, n: int) -> int:
        """Classes are 1.5 wide, so a set's partners lie in its own class or in a neighbour."""
        while self.bounds[-1] <= n:
            self.bounds.append(max(self.bounds[-1] * 3 // 2, self.bounds[-1] * 100 // self.percent + 2))
        return int(np.searchsorted(self.bounds, n, side="right")) - 1

    def parts(self, size_class: int) -> tuple[int, int]:
        """For pairs with the larger set in this class: the shingles that may differ, and the number of parts; some more
        than needed, as some parts of a set are empty."""
        differ = 2 * (self.bounds[size_class + 1] - 1) * self.miss // (100 + self.percent)
        return differ, differ + 2 + differ // 16

    def of(self, s: np.ndarray) -> np.ndarray:
        """The cells of one set, 64 bits each."""
        if len(s) < self.least:
            return np.zeros(0, _U)
        own = self.size_class(len(s))
        # a larger partner may be in the next class
        tags = (own, own + 1) if len(s) * 100 >= self.percent * self.bounds[own + 1] else (own,)
        out, scrambled = [], mix(s + _U(0x632BE59BD9B4E019))
        self.size_class(self.bounds[tags[-1]])
        for tag in tags:
            differ, m = self.parts(tag)
            part = ((s >> _U(17)) % _U(m)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            sorted_part = part[order]
            starts = np.flatnonzero(np.r_[True, sorted_part[1:] != sorted_part[:-1]])
            present = sorted_part[starts]
            total = np.add.reduceat(scrambled[order], starts)
            if len(present) <= differ:   # every part with shingles may differ: an empty one may be the one agreed on
                empty = np.setdiff1d(np.arange(m), present)
                present, total = np.r_[present, empty], np.r_[total, np.zeros(len(empty), _U)]
            out.append(mix(total + present.astype(_U) * _U(0xD6E8FEB86659FD93) + _U(tag * 0xA0761D6478BD642F % (1 << 64))))
        return np.concatenate(out)


def _read(shingle: int, percent: int):
    """(id, text, ...) -> (id, ..., n, key, cells): the set's size, its SHA-256 and its cells."""
    def run(batches):
        of = Cells(percent).of
        for b in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in b.column(1)]
            cells = [of(s).view(np.int64) for s in sets]
            ends = np.cumsum([0, *map(len, cells)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.sha256(s.tobytes()).digest() for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*cells, np.zeros(0, np.int64)])))],
                names=["id", *b.schema.names[2:], "n", "key", "cells"])
    return run


def _sets(shingle: int):
    """(node, text) -> (node, its set)."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([shingle_set(t.as_py(), shingle).tobytes() for t in b.column(1)], pa.binary())],
                names=["node", "members"])
    return run


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _distances(batches):
    """(a, b, set of a, set of b) -> (a, b, size of the intersection, of the union)."""
    for b in batches:
        both, union = [], []
        for x, y in zip(b.column(2), b.column(3)):
            x, y = np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U)
            both.append(shared(x, y))
            union.append(len(x) + len(y) - both[-1])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both, pa.int64()), pa.array(union, pa.int64())],
                                         names=["a", "b", "common", "every"])


def common_counts(sets: list[np.ndarray], most: int = 1 << 15) -> np.ndarray:
    """Sizes of the intersections of each two sets (off the diagonal), by products of 0/1 matrices over slices of the
    shingles that are in more than one."""
    n = len(sets)
    which = np.repeat(np.arange(n), [len(s) for s in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, which = every[order], which[order]
    place = np.cumsum(np.r_[False, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
    often = np.bincount(place)[place] > 1 if len(place) else np.zeros(0, bool)
    place, which = place[often], which[often]
    place = np.cumsum(np.r_[False, place[1:] != place[:-1]]) if len(place) else place
    out = np.zeros((n, n), np.float64)
    total = int(place[-1]) + 1 if len(place) else 0
    for lo in range(0, total, most):
        a, b = np.searchsorted(place, (lo, lo + most))
        m = np.zeros((n, min(most, total - lo)), np.float32)
        m[which[a:b], place[a:b] - lo] = 1
        out += m @ m.T
    return out.astype(np.int64)


def region_links(nodes, roots, far, sets, percent: int):
    """Links within one region between nodes of different components: a window over the distances to the pivot (triangle
    inequality) picks the nodes with a possible partner, then their intersections are counted exactly."""
    reach = 1 - percent / 100 + 1e-9
    nodes, far = np.array(nodes, np.int64), np.array(far)
    root = np.unique(np.array(roots, np.int64), return_inverse=True)[1]
    size = np.array([len(s) for s in sets], np.int64)
    may = (np.abs(far[:, None] - far[None, :]) <= reach) & (root[:, None] != root[None, :]) \
        & (100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :]))
    some = np.flatnonzero(may.any(axis=1))
    if not len(some):
        return []
    common = common_counts([sets[i] for i in some])
    every = size[some][:, None] + size[some][None, :] - common
    x, y = np.nonzero(np.triu(may[np.ix_(some, some)] & (100 * common >= percent * every), 1))
    a, b = nodes[some[x]], nodes[some[y]]
    return list(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist()))


def _join_regions(percent: int):
    """(cell, node, root, far, set), sorted by cell -> links."""
    def run(batches):
        cell, rows = None, []

        def links(rows):
            nodes, roots, far, raw = zip(*rows)
            return region_links(nodes, roots, far, [np.frombuffer(r, _U) for r in raw], percent)
        for b in batches:
            out = []
            for c, *row in zip(*(col.to_pylist() for col in b.columns)):
                if c != cell:
                    if rows:
                        out.extend(links(rows))
                    cell, rows = c, []
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])
        if rows and (out := links(rows)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])
    return run


def _once(members: DataFrame, name: str) -> DataFrame:
    """Members (cell, node, far, before) of cells with two nodes or more, one cell for each set of members, with the cell's
    size.  Members are compared by their number, the smallest and two 64-bit sums."""
    each = members.groupBy("cell").agg(F.count("*").alias("size"), F.min("node").alias("least"),
                                       F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    one = each.filter("size > 1").groupBy("size", "least", "x", "y").agg(F.min("cell").alias("cell"))
    return materialise(members.join(one.select("cell", "size"), "cell"), name)


class JaccardJoin:
    """Links between nodes, sets as (node, members)."""

    def __init__(self, sets: DataFrame, percent: int, local: int, pivots: int, stars: int):
        self.sets, self.percent, self.local, self.pivots, self.stars = sets, percent, local, pivots, stars
        self.partitions = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.links = None

    def add(self, links: DataFrame) -> None:
        """Take further links (a, b); they also renew the components."""
        links = links.select("a", "b")
        self.links = materialise(links if self.links is None else self.links.unionAll(links).distinct(), "jaccard-links")
        self.roots = components(self.links)

    def distances(self, pairs: DataFrame) -> DataFrame:
        """(a, b, common, every, far) for distinct pairs."""
        left = self.sets.select(F.col("node").alias("a"), F.col("members").alias("of_a"))
        right = self.sets.select(F.col("node").alias("b"), F.col("members").alias("of_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
        return materialise(both.mapInArrow(_distances, "a long, b long, common long, every long").withColumn(
            "far", 1 - F.col("common") / F.col("every")), "jaccard-distances")

    def open_cells(self, members: DataFrame) -> DataFrame:
        """Members with their component (root), of the cells with two components at least."""
        named = materialise(members.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node")),
                            "jaccard-named")
        still = named.groupBy("cell").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
        return named.join(still.select("cell"), "cell", "left_semi")

    def choose(self, members: DataFrame, number: int) -> DataFrame:
        """(cell, pivot, rank): in the first round the least node, which names the region; then the first members by how
        few their component has in the cell."""
        if not number:
            return members.select("cell", F.col("cell").alias("pivot"), F.lit(1).alias("rank")).distinct()
        rare = members.groupBy("cell", "root").agg(F.count("*").alias("own"))
        order = Window.partitionBy("cell").orderBy("own", F.xxhash64("node", F.lit(number)))
        first = members.join(rare, ["cell", "root"]).withColumn("rank", F.row_number().over(order))
        first = first.filter((F.col("rank") == 1) | ((F.col("rank") <= self.pivots) & (F.col("size") > self.local)))
        return materialise(first.select("cell", F.col("node").alias("pivot"), "rank"), "jaccard-pivots")

    def regions(self, members: DataFrame, number: int) -> DataFrame:
        """Steps 1 and 2: (cell, node, far, before) of the regions."""
        chosen = self.choose(members, number)
        low, high = F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")
        pairs = members.join(chosen, "cell").filter("node <> pivot")
        known = self.distances(pairs.select(low, high).distinct())
        self.add(known.filter(100 * F.col("common") >= self.percent * F.col("every")))
        done = chosen.select("cell", F.col("pivot").alias("node"))
        left = members.select("cell", "node", "size").join(done, ["cell", "node"], "left_anti").join(chosen, "cell")
        far = left.select("cell", "node", "size", "rank", low, high).join(known.select("a", "b", "far"), ["a", "b"])
        near = far.groupBy("cell", "node").agg(F.min("far").alias("nearest"))
        window = 2 * (1 - self.percent / 100) + 1e-9
        far = materialise(far.join(near, ["cell", "node"]).select(
            "cell", "node", "size", "rank", "far", (F.col("far") <= F.col("nearest") + window).alias("inside")), "jaccard-far")
        split = far.groupBy("cell").agg((F.sum(F.col("inside").cast("long")) <= 2 * F.max("size")).alias("split"))
        here = F.when(F.col("split"), F.col("inside")).otherwise(F.col("rank") == 1)
        return far.join(split, "cell").filter(here).select(
            F.xxhash64("cell", F.when(F.col("split"), F.col("rank")).otherwise(0), F.lit(number)).alias("cell"), "node", "far",
            F.col("size").alias("before"))

    def blocks(self, members: DataFrame, number: int) -> DataFrame:
        """Large cells that kept more than three quarters of their members: pairs of hashed blocks instead."""
        stuck = (F.col("size") > self.local) & (4 * F.col("size") > 3 * F.col("before"))
        many = F.when(stuck, F.ceil(3 * F.col("size") / self.local)).otherwise(1).cast("int")
        mine = F.pmod(F.xxhash64("node", F.lit(-1)), F.col("many")).cast("int")
        dealt = members.withColumn("many", many).withColumn("mine", mine).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
        pair = F.xxhash64("cell", F.lit(number), F.least("mine", "other"), F.greatest("mine", "other"))
        return dealt.withColumn("cell", F.when(F.col("many") > 1, pair).otherwise(F.col("cell"))).drop("many", "mine", "other", "size")

    def run(self, cells: DataFrame) -> DataFrame:
        """The links of cells (cell, node) of two nodes or more, or None where there is none."""
        least = cells.groupBy("cell").agg(F.min("node").alias("least"))
        region = cells.join(least, "cell").select(F.col("least").alias("cell"), "node").distinct()
        members, number = _once(region.withColumns({"far": F.lit(0.0), "before": F.lit(None).cast("long")}), "jaccard-members"), 0
        while not members.isEmpty():
            members = _once(self.open_cells(self.regions(members, number)).drop("size"), "jaccard-members")
            number += 1
            if number < self.stars:
                continue
            large = members.filter(F.col("size") > self.local)
            if not large.filter(4 * F.col("size") > 3 * F.col("before")).isEmpty():
                members = _once(self.open_cells(self.blocks(members.drop("root"), number)), "jaccard-members")
                large = members.filter(F.col("size") > self.local)
            rows = members.filter(F.col("size") <= self.local).join(self.sets, "node").select(
                "cell", "node", "root", "far", "members")
            self.add(rows.repartition(self.partitions, "cell").sortWithinPartitions("cell").mapInArrow(
                _join_regions(self.percent), "a long, b long"))
            members = large
        return self.links


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90,
                   local: int = 256, pivots: int = 8, stars: int = 3, salts: int = 64) -> DataFrame:
    """(id, n_shingles, component_id) per row."""
    bound_arrow_batches(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("sha"))
    wide = materialise(docs.mapInArrow(_read(shingle, percent), f"id {id_type}, sha binary, n long, key binary, cells array<long>")
                       .withColumn("row", F.monotonically_increasing_id()), "jaccard-read")
    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt")
    rows = materialise(wide.select("id", "n", "key", "sha", "row", salt), "jaccard-rows")
    some = rows.filter("n > 0")
    # one row of each set stands for it
    stands = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "sha"))
    first = materialise(some.groupBy("key", "salt").agg(stands.alias("one"), F.max("n").alias("n")), "jaccard-first")
    nodes = materialise(first.groupBy("key").agg(F.min("one").alias("one"), F.max("n").alias("n")).select(
        "key", "n", F.col("one.id").alias("low"), F.col("one.row").alias("node"), F.col("one.sha").alias("sha")), "jaccard-nodes")
    one = nodes.filter(F.col("n") >= Cells(percent).least).select("node")
    listed = materialise(wide.select(F.col("row").alias("node"), "cells").join(one, "node", "left_semi"), "jaccard-cells")
    discard(wide)
    cells = listed.select("node", F.explode("cells").alias("cell"))
    shared_cells = cells.groupBy("cell").count().filter("count > 1").select("cell")
    met = materialise(cells.join(shared_cells, "cell", "left_semi"), "jaccard-met")
    discard(listed)
    wanted = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", F.col("low").alias("id"), "sha")
    again = docs.join(wanted, same(docs, wanted, ["id", "sha"])).select("node", "text")
    sets = materialise(again.mapInArrow(_sets(shingle), "node long, members binary").groupBy("node").agg(
        F.first("members").alias("members")), "jaccard-sets")
    join = JaccardJoin(sets, percent, local, pivots, stars)
    named = nodes.withColumn("root", F.col("node"))
    if join.run(met) is not None:
        named = nodes.join(join.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = materialise(named.select("key", "low", "root"), "jaccard-roots")
    discard(met, sets)
    best = named.groupBy("root").agg(F.min("low").alias("component"))
    of = named.join(best, "root").select("key", "component")
    keyed = first.select("key", "salt").join(of, "key")
    linked = some.join(keyed, ["key", "salt"]).select("id", "n", "component")
    alone = rows.filter("n = 0").select("id", "n", F.col("id").alias("component"))
    return linked.unionAll(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                         F.col("component").alias("component_id"))
