"""Token counts without token ids: pieces per distinct pre-token, joined to each document's pre-token frequencies.

A pre-token here is a run of text up to the next space that a non-space follows.  The byte-level tokenizer never
merges over such a place, so a text's count is the sum over its pre-tokens, each with its leading space.  Special
strings split a text first and count as one token each, as the library does by default.

1. Each task gathers its distinct pre-tokens with the number of documents that have them; they are summed over the table.
2. The tokenizer counts the pieces of every distinct pre-token once; the counts are written as a table.
3. Each document becomes pre-token frequencies.  The most frequent short pre-tokens are broadcast: at most ``hot``
   strings of at most HOT_CHARS characters, a bound that does not grow with the data.  Frequencies of all others
   are joined to the table and summed per document.

Defined cases: a null text is empty and has 0 tokens; repeated rows are separate rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_arrow_batches, materialise

HOT_CHARS = 32
FLUSH = 150_000     # distinct pre-tokens held by a task at most
FLUSH_CHARS = 1 << 25   # and, within one text, their characters
ENCODE_CHARS = 1 << 20  # characters encoded together, within one pre-token
SLICE = 500         # documents turned into frequencies together
_GLUED = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")


def special_strings(tokenizer_json: str) -> list[str]:
    """Special strings of a byte-level BPE tokenizer; raises for a tokenizer that this operator can't split."""
    spec = json.loads(tokenizer_json)
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or \
            not pre.get("use_regex", True):
        raise ValueError("only byte-level BPE without a normalizer or prefix space splits at spaces")
    added = spec.get("added_tokens", [])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError("added tokens that strip white space or match single words are not supported")
    return [t["content"] for t in added]


def pre_tokens(text: str, special: re.Pattern | None) -> tuple[list[str], int]:
    """The pre-tokens of a text and its number of special strings."""
    parts = special.split(text) if special else [text]
    out = []
    for part in parts:
        words = _CUT.split(part) if _GLUED.search(part) else part.split(" ")
        if words[0]:
            out.append(words[0])
        out.extend([" " + w for w in words[1:]])
    return out, len(parts) - 1


def _pattern(strings: list[str]) -> re.Pattern | None:
    by_length = sorted(strings, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, by_length))) if strings else None


def _parts(words: list[str], n: int = 2000):
    """``words`` in lists of at most ``n`` strings and, within one string, ENCODE_CHARS characters."""
    part, chars = [], 0
    for w in words:
        part.append(w)
        chars += len(w)
        if len(part) == n or chars > ENCODE_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def piece_table(texts: DataFrame, tokenizer_json: str) -> DataFrame:
    """(pre, docs, pieces) of the distinct pre-tokens in column ``__text``."""
    specials = special_strings(tokenizer_json)

    def gather(batches):
        pattern, seen, read = _pattern(specials), Counter(), 0
        batch = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["pre", "docs"])
        for b in batches:
            for t in b.column(0):
                t = t.as_py()
                seen.update(set(pre_tokens(t, pattern)[0]))
                read += len(t)
                full = len(seen) > FLUSH
                if read > FLUSH_CHARS:      # the strings held are measured only when they could exceed the bound
                    read = sum(map(len, seen))
                    full = full or 2 * read > FLUSH_CHARS
                if full:
                    yield batch()
                    seen.clear()
                    read = 0
        yield batch()

    def count(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(tokenizer_json)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for b in batches:
            pieces = []
            words = b.column(0).to_pylist()
            for part in _parts(words):              # ids of few pre-tokens exist at a time
                pieces += [len(e) for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pieces, pa.int64())],
                                             names=["pre", "docs", "pieces"])
    distinct = texts.mapInArrow(gather, "pre string, docs long").groupBy("pre").agg(F.sum("docs").alias("docs"))
    return materialise(distinct.mapInArrow(count, "pre string, docs long, pieces long"), "pieces")


def frequent(table: DataFrame, hot: int) -> dict[str, int]:
    """Pieces of the most frequent short pre-tokens, ``hot`` at most: those from the lowest class of document frequency
    (eight classes per power of two) at which no more than ``hot`` are at or above it."""
    short = table.filter(F.char_length("pre") <= HOT_CHARS).withColumn(
        "class", F.floor(8 * F.log2(F.col("docs").cast("double"))).cast("int"))
    total, lowest = 0, None
    for r in short.groupBy("class").count().orderBy(F.col("class").desc()).collect():
        total += r["count"]
        if total > hot:
            break
        lowest = r["class"]
    if lowest is None:
        return {}
    got = short.filter(F.col("class") >= lowest).select("pre", "pieces").toArrow()
    return dict(zip(got["pre"].to_pylist(), got["pieces"].to_pylist()))


def count_tokens(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, hot: int = 1 << 17) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row.  ``tokenizer_json``: content of the tokenizer's file."""
    spark = df.sparkSession
    bound_arrow_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    table = piece_table(df.select(text.alias("__text")), tokenizer_json)
    known = spark.sparkContext.broadcast(frequent(table, hot))
    specials = special_strings(tokenizer_json)
    rows = df.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), text.alias("__text"))
    id_field = rows.schema["__id"].dataType.simpleString()

    def frequencies(batches):
        pattern, pieces = _pattern(specials), known.value
        for b in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            at, pre, n, tokens, sizes = [], [], [], [], []
            row_ids = b.column(0).to_pylist()
            for row, t in zip(row_ids, b.column(2)):
                t = t.as_py()
                words, total = pre_tokens(t, pattern)
                for w, f in Counter(words).items():
                    p = pieces.get(w)
                    if p is None:
                        at.append(row)
                        pre.append(w)
                        n.append(f)
                    else:
                        total += p * f
                tokens.append(total)
                sizes.append(len(t.encode()))
            k = len(tokens)
            ids = pa.concat_arrays([b.column(1), pa.nulls(len(at), b.column(1).type)])
            # a document's own row has kind = row + 1 and joins nothing; kind 0 joins the pieces of its pre-token
            yield pa.RecordBatch.from_arrays(
                [pa.array(row_ids + at, pa.int64()), ids, pa.array([r + 1 for r in row_ids] + [0] * len(at), pa.int64()),
                 pa.array([""] * k + pre, pa.string()), pa.array(tokens + n, pa.int64()),
                 pa.array(sizes + [None] * len(at), pa.int64())],
                names=["__row", "__id", "kind", "pre", "n", "n_bytes"])
    freq = rows.mapInArrow(frequencies, f"__row long, __id {id_field}, kind long, pre string, n long, n_bytes long")
    cold = table.select("pre", "pieces", F.lit(0).cast("long").alias("kind"))
    out = freq.join(cold, ["pre", "kind"], "left").groupBy("__row").agg(
        F.max("__id").alias("__id"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"))
    return out.select(F.col("__id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
