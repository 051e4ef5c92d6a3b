"""Hard negatives over many anchors: shared matrix products, ties, many labels, lanes."""

import random

import numpy as np
from pyspark.sql import functions as F
from test_negatives import SCHEMA, answers, brute

from ledgerlake.llm.cover_tree import Best, CoverTree, by_window
from ledgerlake.llm.hard_negatives import _lanes, hard_negatives


def test_anchors_share_the_products_of_a_leaf():
    rng = np.random.default_rng(8)
    x = np.floor(256 * rng.normal(size=(4096, 32)) / 32 ** 0.5).astype(np.int64)   # no clusters: bounds prune little
    ids, labels = rng.permutation(4096), rng.integers(0, 10, 4096)
    tree = CoverTree(x, ids, np.arange(4096), labels)
    looked = []
    plain = tree.scores
    tree.scores = lambda at, *a: looked.append(len(at)) or plain(at, *a)
    windows = np.array([[i, i, labels[i], w, 2000 * w, 40000 - 9000 * w] for i in range(300) for w in range(3)])
    got = list(tree.search(x[:300], windows, 10, same=False))
    want = []
    for i, _, lab, w, least, most in windows.tolist():
        s = x @ x[i]
        fit = np.flatnonzero((labels != lab) & (s >= least) & (s <= most))
        want += [(i, w, a, b) for a, b in sorted(zip(s[fit].tolist(), ids[fit].tolist()), key=lambda t: (-t[0], t[1]))[:10]]
    assert [(u, n, s, i) for u, n, s, i, _ in got] == want
    assert len(looked) <= 100   # a product for each leaf, not for each leaf and anchor


def test_what_is_found_narrows_the_next_tree():
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (3000, 12))
    trees = [CoverTree(x[i:i + 500], np.arange(i, i + 500), np.arange(i, i + 500), np.zeros(500, np.int64)) for i in range(0, 3000, 500)]
    best = Best(x[:1], np.array([[0, 0, 0, 0, -10 ** 9, 10 ** 9]]), 5, True)
    floors = []
    for tree in trees:
        tree.look(best)
        best.settle()
        floors.append(int(best.floor[0]))
    s = x @ x[0]
    want = sorted(range(1, 3000), key=lambda i: (-s[i], i))[:5]
    assert best.settle()[2].tolist() == want and floors == sorted(floors) and floors[-1] == s[want[-1]]


def test_order_by_window():
    rng = np.random.default_rng(1)
    for size in (10, 1 << 40):   # beyond what one key holds too
        w, s, i = (rng.integers(-n, n, 2000) for n in (9, size, 4))
        w += 9
        got, want = by_window(w, s, i), np.lexsort((i, -s, w))
        assert all((c[got] == c[want]).all() for c in (w, s, i))


def test_copies_and_many_labels(spark):
    rng = random.Random(6)
    ids = list(range(900))
    rng.shuffle(ids)
    rows = [(i, [7, -3, 2, 1], rng.choice([-5, 2 ** 40])) for i in ids[:500]]   # copies: ids alone tell them apart
    rows += [(i, [rng.randint(-9, 9) for _ in range(4)], rng.randint(-80, 80)) for i in ids[500:]]
    rows += [(i, [8, -3, 2, 1], -5) for i in ids[:40]]
    df = spark.createDataFrame([(*r, "u", "t", 1, 2) for r in rows], SCHEMA).repartition(5)
    got = hard_negatives(df, F.col("vec_id") % 4 == 0, tops=6, sample_rows=100, shard_rows=40)
    want = brute(rows, lambda i: i % 4 == 0)
    assert answers(got) == want and len(want) > 500


def test_lanes_hold_all_cells_and_split_large_ones():
    cells = [{"grp": g, "top": t, "n": n} for g, t, n in ((1, 0, 30), (0, 1, 250), (0, 0, 40), (2, 3, 90), (1, 2, 70), (2, 0, 1))]
    got = [(c["grp"], c["top"], c["lane"], c["parts"]) for c in _lanes(cells, 100)]
    assert got == [(0, 0, 0, 1), (0, 1, 1, 3), (1, 0, 4, 1), (1, 2, 4, 1), (2, 0, 5, 1), (2, 3, 5, 1)]
