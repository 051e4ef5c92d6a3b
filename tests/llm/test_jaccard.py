"""The Jaccard join against all pairs of sets."""

import random
from collections import Counter

import numpy as np
import pytest
from brute import WORD, lower

from ledgerlake.llm import queries
from ledgerlake.llm.jaccard_join import Cells, common_counts, jaccard_groups, region_links, shingle_set

SCHEMA = "doc_id long, text string, node string, cell int, far string"


def grams(text, k=3):
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset()


def groups(rows, percent=90):
    """(doc_id, n_shingles, component_id) of all rows, by all pairs."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    return Counter((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def some_rows():
    rng = random.Random(8)
    rows = [(1, None), (2, ""), (None, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (None, "one two"), (None, None),
            (6, "one"), (7, "one two three"), (8, "One Two Three"), (9, "ß two three"), (10, "a " * 500), (11, "a a a")]
    long = words(rng, 6000)
    rows += [(20, " ".join(long)), (21, " ".join(long[:5900])), (22, " ".join(long[:3000]))]
    d = 100
    for size in (9, 11, 12, 13, 20, 40, 60, 130, 400):
        for _ in range(2):
            base = words(rng, size + 2)
            for changes in (0, 0, 1, 1, 2, 4, 8):   # copies, near copies, at the border and beyond
                text = list(base)
                for at in rng.sample(range(len(text)), min(changes, len(text))):
                    text[at] = f"x{rng.randrange(10 ** 6)}"
                cut = rng.randint(0, 1 + size // 12)
                rows.append((d, " ".join(text[:len(text) - cut])))
                d += 1
    rows += [(d + i, "the same text in many rows and in many places " * 3) for i in range(60)]   # a hot group of copies
    rows += [(None, "a text without an id " * 4), (None, "a text without an id " * 4), (4, "one two")]
    rng.shuffle(rows)
    return rows


def blob(n, size=70, spread=3):
    """Near copies of one text, most of them a little too far from one another."""
    rng = random.Random(1)
    base, rows = words(rng, size), []
    for i in range(n):
        text = list(base)
        for at in rng.sample(range(size), spread if i % 5 else 1):
            text[at] = f"y{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, "f") for r in rows], SCHEMA).repartition(5)


def got(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("local,pivots,stars", [(256, 8, 3), (4, 2, 1)])
def test_equals_all_pairs(spark, local, pivots, stars):
    rows = some_rows()
    want = groups(rows)
    assert got(jaccard_groups(frame(spark, rows), local=local, pivots=pivots, stars=stars)) == want
    assert len({c for _, _, c in want}) < len({d for d, _, _ in want})


def test_dense_region_is_dealt_into_blocks(spark):
    rows = blob(260)
    want = groups(rows)
    assert 5 < len({c for _, _, c in want}) < 250
    assert got(jaccard_groups(frame(spark, rows), local=40, pivots=3, stars=1)) == want


def test_other_threshold(spark):
    rows = blob(60) + [(1000 + d, t) for d, t in some_rows() if d is not None]
    assert got(jaccard_groups(frame(spark, rows), percent=80)) == groups(rows, 80)


def test_empty_table(spark):
    assert jaccard_groups(frame(spark, some_rows()).filter("false")).collect() == []
    assert got(jaccard_groups(frame(spark, [(1, None), (2, "")]))) == Counter([(1, 0, 1), (2, 0, 2)])


@pytest.mark.parametrize("percent", [90, 80, 95])
def test_linked_sets_share_a_cell(percent):
    """Any two sets at the border agree on a cell, whatever their sizes."""
    rng, cells = np.random.default_rng(percent), Cells(percent)
    for _ in range(1500):
        n = int(rng.integers(4, 260))
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        gone = int(rng.integers(0, n * (100 - percent) // 100 + 1))
        add = int(rng.integers(0, n * (100 - percent) // 100 + 1))
        a, b = np.unique(base), np.unique(np.r_[base[gone:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert np.intersect1d(cells.of(a), cells.of(b)).size


def test_counts_and_links_of_a_region():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200), dtype=np.uint64)) for _ in range(30)] + [np.zeros(0, np.uint64)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    assert (common_counts(sets, most=37) * (1 - np.eye(31, dtype=int)) == want * (1 - np.eye(31, dtype=int))).all()
    links = region_links(list(range(31)), list(range(31)), [0.0] * 31, sets, 30)
    size = np.array([len(s) for s in sets])
    every = size[:, None] + size[None, :] - want
    assert sorted(links) == [(i, j) for i in range(31) for j in range(i + 1, 31)
                             if size[i] and size[j] and 100 * want[i, j] >= 30 * every[i, j]]


def test_shingle_set():
    assert len(shingle_set("a b c d")) == 2 and len(shingle_set("A b\tc")) == 1 and len(shingle_set("a b")) == 1
    assert len(shingle_set(None)) == len(shingle_set(" \n")) == 0
    assert (shingle_set("X y z") == shingle_set("x  y z")).all() and (shingle_set("x y") != shingle_set("y x")).all()


def test_query_covers_every_document(spark):
    out = queries.op12_jaccard_join(spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got(out) == groups(rows)
