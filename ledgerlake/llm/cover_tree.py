"""A cover tree over integer vectors, for inner products.

Every vector x gets one more component, sqrt(M^2 - |x|^2), M being the largest norm: all augmented vectors have norm M, so
an inner product is a matter of angle only, and the angle is a metric.  A node has a centre (one of its vectors) and its
covering radius; its children's centres are picked farthest first until every vector lies within the radius divided by
``base`` of one, or ``fan`` are picked, and each vector goes to its nearest centre.  A node's angle from the query bounds
all inner products below it from both sides.

Many queries descend together, each as far as its own windows and bounds allow: a node is visited once, with those that may
find a row below it, and a leaf is one matrix product.
"""

from __future__ import annotations

import heapq

import numpy as np

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def augment(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Float vectors of one norm, and that norm."""
    x = x.astype(np.float64)
    sq = np.einsum("ij,ij->i", x, x)
    top = float(sq.max(initial=0.0))
    return np.hstack([x, np.sqrt(np.maximum(top - sq, 0.0))[:, None]]), top ** 0.5


def cover(points: np.ndarray, radius: float, fan: int) -> tuple[list[int], np.ndarray]:
    """Farthest-first centres (the first point is one) until all points lie within ``radius`` of one, or ``fan`` are picked;
    with each point's nearest centre, by its place in the list."""
    sq = np.einsum("ij,ij->i", points, points)
    centres, near = [0], np.zeros(len(points), np.int64)
    dist = np.maximum(sq - 2 * (points @ points[0]) + sq[0], 0.0)
    while len(centres) < fan:
        far = int(dist.argmax())
        if dist[far] <= radius * radius:
            break
        d = np.maximum(sq - 2 * (points @ points[far]) + sq[far], 0.0)
        d[far] = 0.0
        closer = d < dist
        near[closer] = len(centres)
        dist = np.minimum(dist, d)
        centres.append(far)
    return centres, near


def angle_bounds(dots: np.ndarray, norms: np.ndarray, top: float, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of inner products (queries x nodes) from those with the centres, the queries' norms, the common
    norm and the nodes' covering angles; widened by more than rounding can cost."""
    scale = (norms * top)[:, None]
    angle = np.arccos(np.clip(dots / np.maximum(scale, 1e-300), -1.0, 1.0))
    slack = 1e-6 * scale + 1e-3
    return (scale * np.cos(np.maximum(angle - turn, 0.0)) + slack,
            scale * np.cos(np.minimum(angle + turn, np.pi)) - slack)


def covering_angle(radius: np.ndarray, top: float) -> np.ndarray:
    """The angle at which a chord of the given length is seen from the centre of a sphere of radius ``top``."""
    return 2 * np.arcsin(np.clip(radius / max(2 * top, 1e-300), 0.0, 1.0)) + 1e-7


def exact_type(bound: float) -> type:
    """A type in which sums of products of integers are exact while they stay below ``bound``."""
    return np.float32 if bound < 2.0 ** 24 else np.float64 if bound < 2.0 ** 52 else np.int64


def by_window(w: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The order by window (a small number), then greater scores, then smaller ids."""
    if not len(w) or score.min() < -(1 << 31) or score.max() >= 1 << 31:
        return np.lexsort((ids, ~score, w))
    key = (w << 32) - score
    order = np.argsort(key)
    equal = np.diff(key[order]) == 0
    if equal.any():   # ids decide among these alone
        at = np.flatnonzero(np.r_[equal, False] | np.r_[False, equal])
        some = order[at]
        order[at] = some[np.lexsort((ids[some], key[some]))]
    return order


class Best:
    """The k best rows so far for each window (query row, uid, label, number, least score, greatest score) of a block of
    queries: rows of the same (``same``) or any other label but the query's own row, greater scores first, then smaller ids.
    Windows are in the order of their query rows."""

    def __init__(self, queries: np.ndarray, windows: np.ndarray, k: int, same: bool):
        self.windows, self.k, self.same = windows, k, same
        rows, self.first, of = np.unique(windows[:, 0], return_index=True, return_inverse=True)
        self.q, self.many = queries[rows], np.bincount(of, minlength=len(rows))
        self.uid, self.label = windows[self.first, 1], windows[self.first, 2]
        self.most, self.least = windows[:, 5], windows[:, 4].copy()
        self.last = np.full(len(windows), HIGHEST)   # of the rows that score ``least``, ids up to this one still count
        self.ceiling = np.maximum.reduceat(self.most, self.first)
        f = self.q.astype(np.float64)
        self.norms = np.sqrt(np.einsum("ij,ij->i", f, f))
        self.unit = (f / np.maximum(self.norms, 1e-300)[:, None]).astype(np.float32)
        self.typed = {}
        self.kept = tuple(np.zeros(0, np.int64) for _ in range(4))   # window, score, id, row's uid
        self.new, self.waiting, self.narrowed = [], 0, 0
        self.some = min(4 * k * len(windows), 20_000)   # rows worth sorting
        self._narrow()

    def _narrow(self):
        """Each query's least score that some window may still take, and up to which id."""
        self.narrowed += 1
        self.floor = np.minimum.reduceat(self.least, self.first)
        ties = np.where(self.least == np.repeat(self.floor, self.many), self.last, LOWEST)
        self.floor_last = np.maximum.reduceat(ties, self.first)

    def of_type(self, kind: type) -> np.ndarray:
        if kind not in self.typed:
            self.typed[kind] = self.q.astype(kind)
        return self.typed[kind]

    def offer(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, uids: np.ndarray, labels: np.ndarray):
        fit = (labels == self.label[query]) == self.same
        if self.same:
            fit &= uids != self.uid[query]
        at = np.flatnonzero(fit)
        many = self.many[query[at]]
        at = np.repeat(at, many)
        w = self.first[query[at]] + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        s, i = score[at], ids[at]
        ok = (s <= self.most[w]) & ((s > self.least[w]) | ((s == self.least[w]) & (i <= self.last[w])))
        at = at[ok]
        if len(at):
            self.new.append((w[ok], s[ok], i[ok], uids[at]))
            self.waiting += len(at)
            if self.waiting > max(len(self.kept[0]), self.some):
                self.settle()

    def settle(self) -> tuple:
        """The best rows (window, score, id, row's uid), in order."""
        if self.new:
            w, s, i, u = (np.concatenate(c) for c in zip(self.kept, *self.new))
            order = by_window(w, s, i)
            w = w[order]
            start = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            rank = np.arange(len(w)) - np.repeat(start, np.diff(np.r_[start, len(w)]))
            keep = rank < self.k
            order, w, rank = order[keep], w[keep], rank[keep]
            self.kept, self.new, self.waiting = (w, s[order], i[order], u[order]), [], 0
            full = np.flatnonzero(rank == self.k - 1)
            self.least[w[full]] = self.kept[1][full]
            self.last[w[full]] = np.maximum(self.kept[2][full], LOWEST + 1) - 1
            self._narrow()
        return self.kept


class CoverTree:
    """Vectors (integers, one a row) with their ids and labels."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, uids: np.ndarray, labels: np.ndarray, leaf: int = 512, base: float = 2.0,
                 fan: int = 64):
        unit, self.top = augment(x)
        unit = (unit / max(self.top, 1e-300)).astype(np.float32)
        centres, radii, self.children, self.members, self.only, order, placed = [], [], [], [], [], [], 0
        stack = [(np.arange(len(x)), -1)] if len(x) else []
        while stack:
            at, parent = stack.pop()
            node = len(centres)
            if parent >= 0:
                self.children[parent].append(node)
            pts = unit[at]
            gap = pts - pts[0]
            radius = float(np.sqrt(np.einsum("ij,ij->i", gap, gap).max()))
            centres.append(at[0])
            radii.append(radius)
            lab = labels[at]
            self.only.append(int(lab[0]) if (lab == lab[0]).all() else None)
            self.children.append([])
            self.members.append(None)
            picked = []
            if len(at) > leaf and radius > 0.0:
                # leaves worth a matrix product, whatever the vectors' spread
                picked, near = cover(pts, radius / base, max(4, min(fan, 2 * len(at) // leaf)))
            if len(picked) < 2:   # few, or equal but for rounding
                self.members[node] = np.arange(placed, placed + len(at))
                order.append(at)
                placed += len(at)
                continue
            for i, c in enumerate(picked):
                mine = at[near == i]
                head = at[c]
                stack.append((np.concatenate(([head], mine[mine != head])), node))
        order = np.concatenate([np.zeros(0, np.int64), *order])
        self.x = x[order].astype(exact_type(self.top ** 2))
        self.ids, self.uids, self.labels = ids[order], uids[order], labels[order]
        self.centres = unit[np.array(centres, np.int64), :-1]
        # in single precision a chord is off by some 1e-7, an angle near 0 by its root
        turn = covering_angle(np.array(radii), 1.0) + 1e-5 + 1e-7 * x.shape[1]
        self.cos, self.sin = np.cos(turn).astype(np.float32), np.sin(turn).astype(np.float32)
        self.slack = 1e-4 + 1e-6 * x.shape[1], 1e-3 + 2 * (1.2e-7 * x.shape[1]) ** 0.5

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products (rows x queries) with adjacent rows."""
        return self.x[at[0]:at[0] + len(at)].astype(q.dtype, copy=False) @ q.T

    def _worth(self, best: Best, nodes: list, asked: np.ndarray, floor: np.ndarray, ceiling: np.ndarray):
        """For each node the queries that may find a row below it, and the cosine of their best angle there; floor and ceiling
        are cosines too."""
        c = best.unit[asked] @ self.centres[nodes].T
        s = np.sqrt(np.maximum(1 - c * c, 0))
        cos, sin = self.cos[nodes], self.sin[nodes]
        up = np.where(c >= cos, np.float32(1), c * cos + s * sin)
        may = up >= floor[asked, None]
        if not best.same:
            may &= np.where(c <= -cos, np.float32(-1), c * cos - s * sin) <= ceiling[asked, None]
        for i, node in enumerate(nodes):
            mine = may[:, i]
            if self.only[node] is not None:
                mine = mine & ((best.label[asked] == self.only[node]) == best.same)
            mine = np.flatnonzero(mine)
            if len(mine):
                yield node, asked[mine], up[mine, i]

    def look(self, best: Best, rows: int = 256):
        """Offers ``best`` all rows that may be among its windows' best."""
        if not len(self.x):
            return
        kind = exact_type(float(best.norms.max()) * self.top)
        q = best.of_type(kind)
        scale = np.maximum(best.norms * self.top, 1e-300)

        def cosine(limit, slack):
            with np.errstate(over="ignore"):
                return (limit / scale + slack).astype(np.float32)
        floor, ceiling, narrowed = cosine(best.floor, -self.slack[0]), cosine(best.ceiling, self.slack[1]), best.narrowed
        heap = [(0.0, *found) for found in self._worth(best, [0], np.arange(len(q)), floor, ceiling)]
        hits, held = [], 0
        while heap or held:
            if held > best.some // 2 or not heap:
                query, score, at = (np.concatenate(c) for c in zip(*hits))
                best.offer(query, score, self.ids[at], self.uids[at], self.labels[at])
                hits, held = [], 0
                if best.narrowed != narrowed:
                    floor, narrowed = cosine(best.floor, -self.slack[0]), best.narrowed
                continue
            _, node, asked, up = heapq.heappop(heap)
            still = up >= floor[asked]   # the windows may have narrowed since
            if not still.all():
                asked = asked[still]
                if not len(asked):
                    continue
            members = self.members[node]
            if members is None:
                for found in self._worth(best, self.children[node], asked, floor, ceiling):
                    heapq.heappush(heap, (-float(found[2].max()), *found))
                continue
            mine = q if len(asked) == len(q) else q[asked]
            least, last, most = best.floor[asked], best.floor_last[asked], best.ceiling[asked].astype(kind)
            for lo in range(0, len(members), rows):
                at = members[lo:lo + rows]
                s = self.scores(at, mine)
                # of rows that score the floor only those with smaller ids than the ones found count
                floors = (least + ((last < self.ids[at].min()) & (least < HIGHEST))).astype(kind)
                some = np.flatnonzero(s.max(axis=0) >= floors)
                if not len(some):
                    continue
                s = np.take(s, some, axis=1, mode="clip")   # far faster than s[:, some]
                ok = s >= floors[some]
                if not best.same:
                    ok &= s <= most[some]
                of_row, of_query = np.divmod(np.flatnonzero(ok), len(some))
                if len(of_row):
                    hits.append((asked[some[of_query]], s[of_row, of_query].astype(np.int64), at[of_row]))
                    held += len(of_row)

    def search(self, queries: np.ndarray, windows: np.ndarray, k: int, same: bool):
        """For each window (see :class:`Best`) its k best rows: yields (uid, number, score, id, row's uid)."""
        if not len(self.x) or not len(windows):
            return
        best = Best(queries, windows, k, same)
        self.look(best)
        w, s, i, u = best.settle()
        yield from zip(windows[w, 1].tolist(), windows[w, 3].tolist(), s.tolist(), i.tolist(), u.tolist())
