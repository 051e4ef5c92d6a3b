import hashlib
import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import chat, grouping_sa, licenses, packing, quality, token_counts, url_filter
from ledgerlake.llm.exact_dedup import drop_exact, exact_groups
from ledgerlake.llm.gbdt import train
from ledgerlake.llm.graph import components
from ledgerlake.llm.mixing import mix_documents, systematic_mix
from ledgerlake.llm.simhash import drop_near, links, simhash_groups
from ledgerlake.llm.suffix_dedup import remove_repeats
from ledgerlake.llm.url_filter import judge_urls


def counted(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# 1 quality -----------------------------------------------------------------------------------------------------------
def test_quality_counts(docs, rows, empty):
    got = counted(quality.score_quality(docs, None), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                  "n_repeat_words", "base_failed")
    assert got == Counter((d, *brute.base_counts(t)) for d, t, _ in rows)
    assert quality.score_quality(empty, None).count() == 0


def test_quality_without_model_keeps_by_base_rules(docs, rows):
    out = quality.keep_quality(docs, None)
    assert out.columns == docs.columns
    assert counted(out, "doc_id", "text") == Counter((d, t) for d, t, _ in rows if not brute.base_counts(t)[-1])


def test_quality_fit(spark):
    """Held-out: the model learns the labels of one half and is tested on the other; clean documents stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit_quality(docs, labels.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0))
    held = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 1)
    out = quality.score_quality(docs, model).join(held, "doc_id").filter("not base_failed").collect()
    good = [r["kept"] for r in out if r["quality"] == 1]
    bad = [r["kept"] for r in out if r["quality"] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2
    assert quality.fit_quality(docs, labels.filter("false")) is None


def test_gbdt_is_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.5 * np.sin(9 * x[:, 1]) + rng.normal(0, 0.3, 3000)) > 0.7).astype(float)
    model = train(x, y, [1, 0, -1])
    grid = np.repeat(rng.random((50, 3)), 40, 0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(model.margin(grid).reshape(50, 40), axis=1) >= -1e-12).all()
    grid = np.repeat(rng.random((50, 3)), 40, 0)
    grid[:, 2] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(model.margin(grid).reshape(50, 40), axis=1) <= 1e-12).all()
    assert ((model.probability(x) > 0.5) == (y > 0)).mean() > 0.8


# 2 suffix dedup ------------------------------------------------------------------------------------------------------
def test_suffix_arrays_random():
    rng = random.Random(1)
    for _ in range(150):
        lanes = [[rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, rng.choice([3, 30, 90])))] + [0]
                 for _ in range(rng.randint(1, 6))]
        ends = np.cumsum([len(x) for x in lanes])
        sa, base = grouping_sa.suffix_arrays(np.array(sum(lanes, [])), ends), 0
        for x, end in zip(lanes, ends):
            assert (sa[base:end] - base).tolist() == sorted(range(len(x)), key=lambda i: x[i:])
            base = end


@pytest.mark.parametrize("window,anchor,lane_max", [(200, 40, 512), (200, 40, 1), (24, 8, 512), (24, 8, 3), (200, 100, 16)])
def test_suffix_dedup(docs, rows, window, anchor, lane_max):
    """Also with anchors over the lane bound, whose fragments are cut again by longer anchors."""
    out = remove_repeats(docs, window=window, anchor=anchor, lane_max=lane_max).collect()
    got = Counter((r["doc_id"], r["n_bytes"], sum(x["len"] for x in r["removed"]), len(r["removed"]),
                   hashlib.sha256(r["kept"]).hexdigest()) for r in out)
    want = brute.suffix_dedup([t for _, t, _ in rows], window)
    assert got == Counter((d, *w) for (d, _, _), w in zip(rows, want))


def test_suffix_dedup_long_text_in_pieces(spark, monkeypatch):
    from ledgerlake.llm import suffix_dedup
    monkeypatch.setattr(suffix_dedup, "BUFFER", 500)
    rng = random.Random(2)
    part = "".join(rng.choice("abcd") for _ in range(900))
    texts = [part + "".join(rng.choice("abcd") for _ in range(1500)) + part, "zz" + part[100:500]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], sum(x["len"] for x in r["removed"])) for r in remove_repeats(df).collect()}
    assert got == {i: w[:2] for i, w in enumerate(brute.suffix_dedup(texts))}


@pytest.mark.parametrize("lane_max", [1, 4, 512])
def test_suffix_dedup_dense_anchor(spark, lane_max):
    """A passage, a line shorter than the window and a near copy, each in many contexts, and a text of one letter."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, line, near = word(260), word(150), word(500)
    texts = [word(rng.randint(0, 90)) + passage + word(rng.randint(0, 90)) for _ in range(30)]
    texts += [word(70) + line + word(70) for _ in range(30)]
    texts += [near[:i * 15] + "X" + near[i * 15:] for i in range(30)] + ["a" * 450, "b" + "a" * 230, passage, passage[:199]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], sum(x["len"] for x in r["removed"]), len(r["removed"]),
                         hashlib.sha256(r["kept"]).hexdigest()) for r in remove_repeats(df, lane_max=lane_max).collect()}
    assert got == dict(enumerate(brute.suffix_dedup(texts)))


def test_suffix_dedup_plan_holds_no_level(spark):
    """The driver's last query reads the written ranges; it does not carry the joins of every level of anchors."""
    rng = random.Random(5)
    shared = "".join(rng.choices("abcdefgh", k=260))
    rows = [(i, "".join(rng.choices("stuvwxyz", k=60)) + shared[i % 40:] + "".join(rng.choices("stuvwxyz", k=60)))
            for i in range(60)]
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), lane_max=1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    got = {r["doc_id"]: (r["n_bytes"], sum(x["len"] for x in r["removed"]), len(r["removed"]),
                         hashlib.sha256(r["kept"]).hexdigest()) for r in out.collect()}
    assert got == dict(enumerate(brute.suffix_dedup([t for _, t in rows])))


def test_suffix_dedup_empty(empty):
    assert remove_repeats(empty).count() == 0


# 3 mixing ------------------------------------------------------------------------------------------------------------
def test_mixing(docs, rows, empty):
    out = systematic_mix(docs).collect()
    want = brute.mix_targets(rows)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in out) == Counter(
        (d, s, len(brute.WORD.findall(t or ""))) for d, t, s in rows)
    taken, largest = Counter(), Counter()
    for r in out:
        size, target = want[r["source"]]
        assert r["source_size"] == size and abs(r["target"] - target) < 1e-6 * max(1, target)
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, (_, target) in want.items():
        assert abs(taken[s] - target) <= 2 * largest[s]
    again = systematic_mix(docs.repartition(7)).collect()
    key = lambda x: Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in x)
    assert key(again) == key(out)
    assert systematic_mix(empty).count() == 0 and mix_documents(empty).count() == 0


def test_mix_documents_repeats_rows(docs):
    plan = Counter()
    for r in systematic_mix(docs).collect():
        plan[(r["doc_id"], r["source"])] += r["copies"]
    out = mix_documents(docs)
    assert out.columns == docs.columns
    got = counted(out, "doc_id", "source")
    assert {k: v for k, v in plan.items() if v} == dict(got)


def test_mixing_caps_small_sources(spark):
    rows = [(i, "w " * 50, "big") for i in range(40)] + [(100 + i, "w " * 10, "tiny") for i in range(2)]
    out = systematic_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    tiny = [r for r in out if r["source"] == "tiny"]
    assert all(r["target"] == 60 and r["copies"] == 3 for r in tiny)
    assert sum(r["target"] for r in {r["source"]: r for r in out}.values()) == pytest.approx(2020)


# 4 token counts ------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizer_json():
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.mark.parametrize("hot", [0, 20, 1 << 18])
def test_token_counts(spark, docs, rows, tokenizer_json, hot):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(tokenizer_json)
    extra = [(400, "a  b\n c <|endoftext|> d<|endoftext|>", "a"), (401, " lead 's don't \x1c x\x85 y ", "a"),
             (402, "日本 語👍 １２", None), (403, "x" * 5000, "a"), (403, "x" * 5000, "a")]
    df = docs.select("doc_id", "text", "source").union(spark.createDataFrame(extra, "doc_id long, text string, s string"))
    got = counted(token_counts.count_tokens(df, tokenizer_json, hot=hot), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = Counter()
    for d, t, _ in [*rows, *extra]:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want[(d, len((t or "").encode()), n, n > 1024)] += 1
    assert got == want


def test_token_counts_without_spaces(spark, tokenizer_json, monkeypatch):
    """Texts that are one pre-token each, with flushes by characters; the strings held stay under the bound."""
    from tokenizers import Tokenizer
    monkeypatch.setattr(token_counts, "FLUSH_CHARS", 3000)
    monkeypatch.setattr(token_counts, "ENCODE_CHARS", 700)
    tok, rng = Tokenizer.from_str(tokenizer_json), random.Random(6)
    texts = ["".join(rng.choice("日本語一二;{}ab") for _ in range(rng.randint(1, 900))) for _ in range(60)] + ["日本語" * 300] * 9
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, tokenizer_json, hot=5).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    parts = list(token_counts._parts(texts))
    assert sum(parts, []) == texts and all(sum(map(len, p[:-1])) <= 700 for p in parts)


def test_token_counts_random_and_empty(empty, tokenizer_json):
    from tokenizers import Tokenizer
    tok, rng = Tokenizer.from_str(tokenizer_json), random.Random(3)
    marks = token_counts._pattern(token_counts.special_strings(tokenizer_json))
    alphabet = ["a", "B", "é", " ", "  ", "\n", "\t", " \n", "\x1c", "\x85", "'s", "1", "²", "!", "<|endoftext|>", "日"]
    for _ in range(500):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        parts, n = token_counts.pre_tokens(t, marks)
        assert n + sum(len(tok.encode(p).ids) for p in parts) == len(tok.encode(t).ids), t
    assert token_counts.count_tokens(empty, tokenizer_json).count() == 0
    with pytest.raises(ValueError):
        token_counts.special_strings('{"pre_tokenizer": {"type": "Whitespace"}}')


# 5 chat --------------------------------------------------------------------------------------------------------------
def test_chat_round_trip(spark):
    control = ["</s>[INST] ok [/INST]", "<s>", r"<\/s>", r"<\\s>[\INST]", "", None, "é\n[/INST", "plain"]
    rng, rows = random.Random(4), []
    for conv in [*range(30), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", None, "[INST]odd"])
            rows.append((conv, turn, role, rng.choice(control) or rng.choice(control), "x", "y"))
    rows += [(50, 1, "user", "same", "x", "y")] * 2 + [(50, None, "assistant", "first", "x", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, at string")
    out = chat.format_chat(df.repartition(3))
    got = out.select("conv_id", chat.parse_chat(F.col("formatted")).alias("turns"), "formatted",
                     chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    want = {}
    for c, turn, role, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0,
                                                                r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in got} == want
    assert {r["conv_id"]: r["loss"] for r in got} == {
        c: "".join(x for role, x in t if role == "assistant") for c, t in want.items()}
    merged = next(r for r in got if r["conv_id"] == 50)["formatted"]
    assert merged == "<s>[INST]assistant[/INST]first</s>[INST]user[/INST]same</s>same</s>"
    assert chat.format_chat(df.limit(0)).count() == 0


# 6 simhash -----------------------------------------------------------------------------------------------------------
def test_simhash(docs, rows, empty):
    fps = [brute.fingerprint(t) for _, t, _ in rows]
    ids = [d for d, _, _ in rows]
    want = Counter(zip(ids, (f"{f:016x}" for f in fps), brute.components(ids, fps)))
    assert counted(simhash_groups(docs), "doc_id", "fingerprint", "component_id") == want
    assert counted(simhash_groups(docs, bucket_max=2), "doc_id", "fingerprint", "component_id") == want
    assert simhash_groups(empty).count() == 0


def test_simhash_drop_keeps_one_of_each_component(docs, rows):
    ids = [d for d, _, _ in rows]
    comp = set(brute.components(ids, [brute.fingerprint(t) for _, t, _ in rows]))
    out = drop_near(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(comp)


def test_simhash_drop_tells_rows_with_null_and_repeated_ids_apart(spark):
    rng = random.Random(16)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(8)]
    near = texts[0].upper()   # another text with the same fingerprint
    fps = [brute.fingerprint(t) for t in texts]
    assert min((a ^ b).bit_count() for i, a in enumerate(fps) for b in fps[:i]) > 2 and brute.fingerprint(near) == fps[0]
    rows = [(None, t) for t in texts[4:]] + [(None, texts[4])]      # unrelated texts without an id, one row twice
    rows += [(7, texts[1]), (7, texts[2]), (1, texts[0]), (9, texts[3]), (9, near), (None, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(None, t) for t in texts[4:]] + [(7, texts[1]), (7, texts[2]), (1, texts[0]), (9, texts[3])]
    assert counted(drop_near(df), "doc_id", "text") == Counter(want)


@pytest.mark.parametrize("bucket_max", [2, 64])
def test_simhash_links_dense(spark, bucket_max):
    """A dense ball of fingerprints, chains, the sign bit: components equal those of all pairs."""
    rng, fps = random.Random(6), {0, 1 << 63, (1 << 63) | 1}
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    comp = components(links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, bucket_max)).collect()
    root = {r["node"]: r["root"] for r in comp}
    want, got = brute.components(list(range(len(fps))), fps), [root.get(s, s) for s in signed]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_components_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(301)}) == 1 and got[1000] == got[1001] != got[0]


# 7 exact dedup -------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("n_runs,fan_in", [(256, 4), (1, 4), (5, 2)])
def test_exact(docs, rows, empty, n_runs, fan_in):
    groups = brute.exact([(d, t) for d, t, _ in rows])
    out = exact_groups(docs, n_runs=n_runs, fan_in=fan_in)
    want = Counter((d, *groups[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in rows)
    assert counted(out, "doc_id", "keep_id", "group_size", "text_sha256") == want
    kept = [r for r in out.collect() if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_groups(empty).count() == 0


def test_exact_drop(docs, rows):
    groups = brute.exact([(d, t) for d, t, _ in rows])
    out = drop_exact(docs)
    assert out.columns == docs.columns
    got = [(r["text"] or "", r["doc_id"]) for r in out.collect()]
    assert Counter(got) == Counter((t, k) for t, (k, _) in groups.items())


# 8 licences ----------------------------------------------------------------------------------------------------------
def test_licenses(spark, docs, rows, empty):
    extra = [(500, "cc by cc by. CC-BY the general public license General, Public LICENSE", "a"),
             (501, "Redistribution and use in source and binary forms, with or without modification, are permitted", "b"),
             (502, "by all rights all rights reserved reserved", "b")]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string, s string")
                                             .select("doc_id", "text"))
    out = licenses.scan_licenses(df).collect()
    every = [*rows, *extra]
    assert len(out) == len(every)
    want = Counter()
    for d, t, _ in every:
        n, found = brute.license_places(t, licenses.BASE)
        at = [i for _, i in found]
        want[(d, n, len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in found})))] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                   for r in out) == want
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[14]["labels"] == "apache-2.0" and by_id[14]["score"] == 1.0
    assert by_id[501]["labels"] == "bsd" and by_id[4]["score"] == 0.0
    assert by_id[500]["n_base"] == 5 and by_id[502]["first_word"] == 3
    assert licenses.scan_licenses(empty).count() == 0


# 9 packing -----------------------------------------------------------------------------------------------------------
def test_best_fit_equals_plain_search():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(0, 60)
        pieces = sorted(((rng.randint(0, 20), rng.randint(0, 15), rng.randint(0, 3)) for _ in range(n)), reverse=True)
        k = rng.randint(1, 4)
        assert packing.best_fit(pieces, 20, k) == brute.best_fit(pieces, 20, k)


@pytest.mark.parametrize("shard_rows", [4096, 20])
def test_packing(docs, rows, empty, shard_rows):
    out = packing.pack(docs, capacity=100, max_per_source=2, shard_rows=shard_rows).collect()
    words, bins = Counter(), {}
    for r in out:
        words[(r["doc_id"], r["source"])] += r["size"]
        bins.setdefault(r["bin_id"], []).append(r)
        assert r["first_word"] == 100 * r["piece"]
    want = Counter()
    for d, t, s in rows:
        want[(d, s)] += len(brute.WORD.findall(t or ""))
    assert words == want
    for b in bins.values():
        assert sum(r["size"] for r in b) <= 100
        assert len({r["cluster"] for r in b}) == len(b)
        assert max(Counter(r["source"] for r in b).values()) <= 2
        at = 0
        for r in sorted(b, key=lambda r: (r["bin_start"], r["size"])):
            assert r["bin_start"] == at
            at += r["size"]
    assert packing.pack(empty).count() == 0


def test_packing_does_not_depend_on_the_layout(docs):
    bins = [Counter(packing.pack(d, capacity=100, max_per_source=2, shard_rows=20).collect())
            for d in (docs.repartition(1), docs.repartition(7, "text"), docs.orderBy(F.desc("text")))]
    assert bins[0] == bins[1] == bins[2]


def test_packing_packs_loose_bins_again(spark):
    """Ten shards of about 20 pieces leave a loose bin each; the loose pieces share bins in later rounds."""
    data = [(i, f"w{i} " * 9, f"s{i}") for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    once, more = (packing.pack(df, capacity=100, shard_rows=20, full=f).collect() for f in (0.0, 0.9))
    fill = Counter()
    for r in more:
        fill[r["bin_id"]] += r["size"]
    assert sorted(r["doc_id"] for r in more) == list(range(200)) and max(fill.values()) <= 100
    assert len(fill) < len({r["bin_id"] for r in once})


# 10 URLs -------------------------------------------------------------------------------------------------------------
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


@pytest.mark.parametrize("n_blocks", [1 << 16, 1])
def test_url_filter(spark, n_blocks):
    """With one block every page is a possible hit, and the exact join still decides."""
    urls = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com/en/x",
            "http://a.example.com/en/", "http://badexample.com/en/x", "http://example.com?x/en/", "http://x.net/es/1#a",
            "http://bad.org/p.html", "https://www.bad.org/p?q=1", "https://m.bad.org/p/", "http://bad.org/p2",
            "http://ok.org/p", "http://com/x", "http://ÉX.com/"] + [f"http://h.org/{i}" for i in range(300)]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(7, urls[7], "x", "y")],
                                  "page_id long, url string, host string, verdict string")
    listed = spark.createDataFrame([("http://bad.org/p",), ("http://h.org/5/",), (None,), ("http://example.com/en/x",)],
                                   "url string")
    out = judge_urls(pages, listed, RULES, n_blocks=n_blocks).collect()
    assert len(out) == len(urls) + 1
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}
    assert by[0] == by[1] == by[2] == by[3] == by[4] == ("", "", None, "allow")
    assert by[5] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert by[6][2:] == by[7][2:] == ("example.com/en/", "block")
    assert by[8][2:] == ("com/", "allow") and by[9] == ("example.com", "", None, "allow")
    assert by[10][2:] == ("net/es/", "block")
    assert [by[i][3] for i in range(11, 16)] == ["block", "block", "block", "allow", "allow"]
    assert by[16][2] == "com/" and by[17][0] == "Éx.com"
    assert [i for i in range(300) if by[18 + i][3] == "block"] == [5]
    assert judge_urls(pages, listed.limit(0), RULES).filter("verdict = 'block'").count() == 4
    assert judge_urls(pages.limit(0), listed, RULES).count() == 0


def test_url_filter_grows_with_the_list(spark, monkeypatch):
    assert url_filter.blocks_for(0) == url_filter.blocks_for(10) == url_filter.LEAST_BLOCKS
    assert url_filter.blocks_for(10 ** 7) == 1 << 20 and url_filter.blocks_for(10 ** 12) == url_filter.MOST_BLOCKS
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(
        F.when(F.col("id") % 50 == 0, "no url ").otherwise("http://"), F.lit("h.org/"), F.col("id") % 100).alias("url"))
    listed = spark.range(0, 100, 3).select(F.concat(F.lit("https://www.h.org/"), "id", F.lit(".html")).alias("url"))
    want = Counter((i, "block" if i % 50 and i % 100 % 3 == 0 else "allow") for i in range(400))
    monkeypatch.setattr(url_filter, "LEAST_BLOCKS", 1)
    for most in (1 << 16, 1, 0):   # the filter is broadcast, then joined
        monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", most)
        out = judge_urls(pages, listed, RULES)
        assert counted(out, "page_id", "verdict") == want


def test_list_decides_verdicts_of_the_given_pages(spark):
    """Pages of the listed sites that no rule fits are blocked, and there are such pages; no other page is."""
    from ledgerlake.llm import queries
    for sf in ("sf0.01", "sf0.1"):
        out = queries.op10_url_filter(spark, f"/root/testdata/{sf}")
        by_list = out.filter("rule is null and verdict = 'block'")
        sites = "|".join(queries.LISTED_SITES)
        assert by_list.count() >= 3 and by_list.filter(~F.col("host").rlike(rf"(^|\.)({sites})\.")).count() == 0
        assert out.filter(F.col("host").rlike(rf"(^|\.)({sites})\.") & (F.col("verdict") == "allow")
                          & F.col("rule").isNull()).count() == 0


def test_long_conversation(spark):
    """Spans of a conversation of many stretches of turns."""
    n = 2 * chat.STRETCH + 77
    said = [("user" if i % 3 else "assistant", f"ß{i} </s>" * (i % 4)) for i in range(n)]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(said)], "conv_id long, turn long, role string, text string")
    out = chat.format_chat(df).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).first()
    assert len(out["loss_spans"]) == sum(r == "assistant" for r, _ in said)
    assert out["loss"] == "".join(t for r, t in said if r == "assistant")
