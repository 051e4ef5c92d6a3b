"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries
from ledgerlake.llm.prefix_trie import NAMES, conversation_trie, prefix_trie, turn_sequences, with_other_heads

SCHEMA = "conv_id long, turn long, role string, text string, head string, seq int, n long"


def said(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32] + f"{len(text.encode()):016X}"


def sequences(rows):
    """conv -> its (role, text) in order."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, said(role, text), role or "", text or ""))
    return {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}


def trie(seqs):
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(list)
    for conv, turns in seqs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[b] for b in below[node]) or 1
        saved[node] = sum(saved[b] for b in below[node]) + \
            (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return Counter((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(below[node]), leaves[node],
                    saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
                   for node, m in members.items())


def nodes(df):
    return Counter(tuple(r[c] for c in NAMES) for r in df.collect())


def some_rows():
    """Copies, prefixes of one another, null and repeated turns, ties, a long conversation, a hot first turn."""
    rng, rows = random.Random(3), []
    for conv in range(60):   # a third and more are copies
        rows += [(conv, t, "user" if t % 2 == 0 else "assistant", f"copy {t}") for t in range(6)]
    for conv in range(60, 110):
        rows += [(conv, t, "user", "hot" if t == 0 else rng.choice("abc")) for t in range(rng.randint(1, 7))]
    for conv in range(110, 130):   # each a prefix of the next
        rows += [(conv, t, "user", f"chain {t}") for t in range(conv - 109)]
    rows += [(-7, None, None, None), (-7, None, "user", None), (-7, 0, None, ""), (-7, 0, "user", "ß" * 3000), (-7, 0, "user", "a")]
    rows += [(131, 3, "user", "same"), (131, 3, "user", "same"), (None, 0, "user", "no id"), (None, None, None, None)]
    rows += [(132, t, "user", f"long {t % 5}") for t in range(700)] + [(133, t, "user", f"long {t % 5}") for t in range(650)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in some_rows()], SCHEMA).repartition(5)


@pytest.mark.parametrize("convs,turns", [(1, 1), (7, 50), (128, 65_536)])
def test_trie_equals_all_prefixes(conversations, convs, turns):
    assert nodes(conversation_trie(conversations, convs=convs, turns=turns)) == trie(sequences(some_rows()))


def test_long_chain_of_prefixes(spark):
    rows = [(c, t, "u", f"{t}") for c in range(12) for t in range(c)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert nodes(conversation_trie(df, convs=2)) == trie(sequences(rows))


def test_other_heads(spark):
    rows = [(c, t, "u", f"{c} {t}") for c in (-6, 0, 1, 2, 7, 10) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own, conv = sequences(rows), F.col("conv")
    got = with_other_heads(turn_sequences(df), conv - conv % 5, F.abs(conv) % 7, most=6)
    n = {c: abs(c) % 7 for c in own}
    base = {-6: -5, 0: 0, 1: 0, 2: 0, 7: 5, 10: 10}
    assert nodes(prefix_trie(got)) == trie({c: own.get(base[c], [])[:n[c]] + own[c][n[c]:] for c in own})


def test_empty_table(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert conversation_trie(spark.createDataFrame([(None, 1, "u", "t", "", 1, 1)], SCHEMA)).collect() == []


def test_query_has_one_root(spark):
    out = queries.op11_prefix_trie(spark, "/root/testdata/sf0.001")
    root = [r for r in out.collect() if r["depth"] == 0]
    n = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id").distinct().count()
    assert len(root) == 1 and root[0]["n_convs"] == n and root[0]["parent_conv_id"] is None
