"""The pipeline against brute force, stage by stage, each on the rows that the stage before it left."""

import os
import sys
from collections import Counter

import brute
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
cols = ("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import corpus_pipeline as P
    out, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    out.append(docs.collect())
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_quality_stage(spark, stages):
    from ledgerlake.llm import quality
    before, after = stages[0], stages[1]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    verdict = {r["doc_id"]: r["kept"] for r in quality.score_quality(docs, model).collect()}
    assert Counter(after) == Counter(r for r in before if verdict[r["doc_id"]])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r for r in before if labels.get(r["doc_id"]) == 1 and not brute.base_counts(r["text"])[-1]]
    assert sum(verdict[r["doc_id"]] for r in clean) >= 0.98 * len(clean)


def test_exact_stage(stages):
    groups = brute.exact([(r["doc_id"], r["text"]) for r in stages[1]])
    assert Counter((r["text"], r["doc_id"]) for r in stages[2]) == Counter((t, k) for t, (k, _) in groups.items())


def test_near_stage(stages):
    ids = [r["doc_id"] for r in stages[2]]
    comp = brute.components(ids, [brute.fingerprint(r["text"]) for r in stages[2]])
    assert Counter(stages[3]) == Counter(r for r in stages[2] if r["doc_id"] in set(comp))


def test_mix_stage(stages):
    want = brute.mix_targets([(r["doc_id"], r["text"], r["source"]) for r in stages[3]])
    size = {r["doc_id"]: len(brute.WORD.findall(r["text"])) for r in stages[3]}
    copies = Counter(stages[4])
    assert set(copies) <= set(stages[3]) and max(copies.values()) <= 3
    taken, largest = Counter(), Counter()
    for r in stages[3]:
        taken[r["source"]] += copies[r] * size[r["doc_id"]]
        largest[r["source"]] = max(largest[r["source"]], size[r["doc_id"]])
    for s, (_, target) in want.items():
        assert abs(taken[s] - target) <= 2 * largest[s]


def test_pack_stage(stages):
    words, bins = Counter(), {}
    for r in stages[5]:
        words[r["doc_id"]] += r["size"]
        bins.setdefault(r["bin_id"], []).append(r)
    want = Counter()
    for r in stages[4]:
        want[r["doc_id"]] += len(brute.WORD.findall(r["text"]))
    assert words == want
    for b in bins.values():
        assert sum(r["size"] for r in b) <= 2048 and len({r["cluster"] for r in b}) == len(b)
        assert max(Counter(r["source"] for r in b).values()) <= 3
    # one shard at this size: the bins are those of the plain search
    pieces = sorted(stages[5], key=lambda r: (-r["size"], r["doc_id"], r["cluster"], r["piece"]))
    assert len(bins) == 1 + max(brute.best_fit([(r["size"], r["cluster"], r["source"]) for r in pieces], 2048, 3))


def test_run_and_columns(spark, stages):
    import corpus_pipeline as P
    assert [n for n, _ in P.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "mix_sources",
                                        "best_fit_packing"]
    for rows in stages[:5]:
        assert tuple(rows[0].asDict()) == cols
    key = lambda rows: Counter((r["doc_id"], r["piece"], r["size"]) for r in rows)
    assert key(P.run(spark, SF).collect()) == key(stages[5])
