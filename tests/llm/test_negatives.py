"""Hard negatives and the cover tree against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries
from ledgerlake.llm.cover_tree import HIGHEST, LOWEST, CoverTree, cover
from ledgerlake.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, vec array<long>, label long, uid string, top string, id int, rank int"


def usable(rows):
    dim = max((len(v) for _, v, _ in rows if v), default=0)
    return [(i, tuple(v) + (0,) * (dim - len(v)), lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and None not in v]


def brute(rows, anchor, positives=5, negatives=10, least=30, most=90):
    rows, out = usable(rows), []
    for n, (aid, a, alab) in enumerate(rows):
        if not anchor(aid):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, lab, m) for m, (i, v, lab) in enumerate(rows))
        best = [(-s, i) for s, i, lab, m in scored if lab == alab and m != n][:positives]
        for p, pid in best:
            hits = [(-s, i) for s, i, lab, _ in scored if lab != alab and least * p <= -100 * s <= most * p][:negatives]
            out += [(aid, pid, r + 1, i, p, s) for r, (s, i) in enumerate(hits)]
    return sorted(out)


def answers(df):
    return sorted(tuple(r) for r in df.collect())


def some_rows(n=700, dim=6):
    rng = random.Random(11)
    centres = [[rng.randint(-200, 200) for _ in range(dim)] for _ in range(9)]
    rows = []
    for i in range(n):
        if i % 3 == 0:   # a third of all rows: one hot group of copies
            rows.append((i, [90, 10, -40, 5, 0, 60], i % 4))
        else:
            c = rng.choice(centres)
            rows.append((i, [x + rng.randint(-40, 40) for x in c], rng.randint(0, 3)))
    rows += [(None, [1] * dim, 0), (n, None, 0), (n + 1, [1] * dim, None), (n + 2, [1, None] + [0] * (dim - 2), 0)]
    rows += [(n + 3, [0] * dim, 1), (n + 4, [5, 5], 2), (n + 5, [], 2), (17, [1] * dim, 3), (100, [9] * dim, 1), (100, [9] * dim, 1)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(*r, "u", "t", 1, 2) for r in some_rows()], SCHEMA).repartition(6)


@pytest.mark.parametrize("tops,sample_rows,shard_rows", [(64, 2048, 4096), (3, 20, 50)])
def test_equals_brute_force(vectors, tops, sample_rows, shard_rows):
    got = hard_negatives(vectors, F.col("vec_id") % 20 == 0, tops=tops, sample_rows=sample_rows, shard_rows=shard_rows)
    want = brute(some_rows(), lambda i: i % 20 == 0)
    assert answers(got) == want and len(want) > 500


def test_large_values_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randint(-10 ** 9, 10 ** 9) for _ in range(4)], i % 3) for i in range(120)]
    df = spark.createDataFrame([(*r, "u", "t", 1, 2) for r in rows], SCHEMA)
    assert answers(hard_negatives(df, F.col("vec_id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_empty_and_lonely(spark, vectors):
    assert hard_negatives(vectors.filter("false"), F.col("vec_id") % 20 == 0).collect() == []
    assert hard_negatives(vectors, F.lit(None).cast("boolean")).collect() == []
    one_label = vectors.withColumn("label", F.lit(1))
    assert hard_negatives(one_label, F.col("vec_id") % 20 == 0).collect() == []


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 4, (3000, 8)) + 200 * rng.normal(size=(12, 8))[rng.integers(0, 12, 3000)]).astype(np.int64)
    labels = rng.integers(0, 3, 3000)
    tree = CoverTree(x, np.arange(3000), np.arange(3000), labels)
    assert sorted(np.concatenate([m for m in tree.members if m is not None]).tolist()) == list(range(3000))
    looked = []
    plain = tree.scores
    tree.scores = lambda at, *a: looked.append(len(at)) or plain(at, *a)
    windows = np.array([[0, 5, labels[5], 0, LOWEST, HIGHEST]])
    got = [(s, i) for _, _, s, i, _ in tree.search(x[5:6], windows, 5, same=True)]
    s = x @ x[5]
    want = sorted(((int(s[i]), i) for i in range(3000) if labels[i] == labels[5] and i != 5), key=lambda t: (-t[0], t[1]))[:5]
    assert got == want and sum(looked) < 1000


def test_cover_reaches_every_point():
    pts = np.random.default_rng(0).normal(size=(400, 3))
    centres, near = cover(pts, 0.5, 400)
    gap = np.linalg.norm(pts - pts[np.array(centres)[near]], axis=1)
    assert gap.max() <= 0.5 + 1e-9
    apart = np.linalg.norm(pts[centres][:, None] - pts[centres][None], axis=2) + 9 * np.eye(len(centres))
    assert apart.min() > 0.5


def test_query_leaves_out_what_is_not_finite(spark, tmp_path):
    rows = [(i, [float(i % 7), 1.0, -0.5], i % 3) for i in range(300)]
    rows += [(700, [float("nan"), 1.0, 1.0], 0), (800, [float("inf"), 1.0, 1.0], 0), (900, [1.0, None, 1.0], 0), (1000, None, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    ints = [(i, None if v is None else [None if x is None or not np.isfinite(x) else int(np.floor(256 * x)) for x in v],
             (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    assert answers(queries.op13_hard_negatives(spark, str(tmp_path))) == brute(ints, lambda i: i % 100 == 0)
