"""Quality rules: gradient-boosted trees over document statistics.

Every whole text is reduced to counts (one Arrow pass, no shuffle); the counts' ratios are the features of a small
boosted model with monotonic constraints (more symbols, shouting or repetition never raise the score), trained on the
driver from at most ``sample_rows`` labelled documents.  Scoring runs in the same pass as the counts, over flattened
node arrays, for all rows of a batch at once.

Defined cases: a null text counts as empty; a text without words fails the base rules; repeated rows are separate
rows; without labelled documents of both classes no model is fitted and only the base rules decide; an empty table gives
an empty result; other columns are ignored by :func:`score_quality` and kept by :func:`keep_quality`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, same
from .gbdt import Trees, train

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_exclaim", "n_distinct"]
FEATURES = ["log_words", "word_length", "symbols_per_char", "dup_line_share", "repeat_share", "upper_share",
            "exclaims_per_word", "digit_share", "distinct_share", "words_per_line"]
MONOTONE = [0, 0, -1, -1, -1, -1, -1, 0, 0, 0]
_SYMBOLS, _SPACE, _UPPER, _DIGITS = b"#*$%&|<>", b" \t\n\x0b\x0c\r", bytes(range(65, 91)), b"0123456789"


def repeated_words(ids: np.ndarray, window: int = 5) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text, the first included."""
    n, v = len(ids) - window + 1, int(ids.max(initial=0)) + 1
    if n < 2 or v == len(ids):
        return 0
    key, most = ids[:n].astype(np.int64), v
    for j in range(1, window):
        if most * v >= 1 << 62:   # rename the keys so far by rank: exact, no hashing
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            most = int(key.max()) + 1
        key = key * v + ids[j:j + n]
        most *= v
    order = np.argsort(key, kind="stable")
    equal = key[order[1:]] == key[order[:-1]]
    if not equal.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    starts = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(starts, at, 1)
    np.add.at(starts, at + window, -1)
    return int((np.cumsum(starts)[:-1] > 0).sum())


def counts(text: str | None) -> tuple:
    b = (text or "").encode("utf-8", "surrogatepass")
    words = b.split()                       # splits at space and U+0009 to U+000D only
    lines = [x for x in b.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    without = lambda chars: len(b) - len(b.translate(None, chars))
    return (len(words), len(text or "") - without(_SPACE), without(_SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(ids), len(lines), without(_UPPER), without(_DIGITS), b.count(b"!"), len(seen))


def features(c: np.ndarray) -> np.ndarray:
    """(rows, counts) -> (rows, features)."""
    words, chars, symbols, dup, rep, lines, upper, digits, exclaim, distinct = c.astype(float).T
    w, ch, ln = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.stack([np.log1p(words), chars / w, symbols / ch, dup / ln, rep / w, upper / ch, exclaim / w, digits / ch,
                     distinct / w, words / ln], 1)


def _scan(rows: DataFrame, model: Trees | None) -> DataFrame:
    """rows (__id, __text, ...) -> counts and score; further columns are carried through."""
    carried = [f for f in rows.schema.fields if f.name != "__text"]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in carried] + [f"{c} long" for c in COUNTS]
                    + ["score double"])
    text_at = rows.columns.index("__text")

    def run(batches):
        for b in batches:
            c = np.array([counts(t.as_py()) for t in b.column(text_at)], np.int64).reshape(-1, len(COUNTS))
            score = np.ones(len(c)) if model is None else model.probability(features(c))
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(b.num_columns) if i != text_at]
                + [pa.array(c[:, i]) for i in range(len(COUNTS))] + [pa.array(score)],
                names=[f.name for f in carried] + COUNTS + ["score"])
    return rows.mapInArrow(run, ddl)


def fit_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", sample_rows: int = 20_000, **kw) -> Trees | None:
    """Trees fitted on at most ``sample_rows`` labelled documents (the first by hash of the id)."""
    spread = F.xxhash64("__id", F.lit(11))
    lab = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__y"))
    lab = lab.filter("__id is not null and __y is not null").orderBy(spread, "__y").limit(sample_rows)
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(lab), "__id")
    got = _scan(rows, None).orderBy(spread, "__y", *COUNTS).limit(sample_rows).select("__y", *COUNTS).collect()
    data = np.array([tuple(r) for r in got], float).reshape(-1, 1 + len(COUNTS))
    if len(np.unique(data[:, 0])) < 2:
        return None
    return train(features(data[:, 1:]), data[:, 0], MONOTONE, **kw)


def score_quality(df: DataFrame, model: Trees | None, id_col: str = "doc_id", text_col: str = "text",
                  min_score: float = 0.5) -> DataFrame:
    """(id, counts, base_failed, score, kept) per row."""
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return _scan(rows, model).select(F.col("__id").alias(id_col), *COUNTS, failed.alias("base_failed"), "score",
                                     (~failed & (F.col("score") >= min_score)).alias("kept"))


def keep_quality(df: DataFrame, model: Trees | None, id_col: str = "doc_id", text_col: str = "text",
                 min_score: float = 0.5) -> DataFrame:
    """The rows of ``df`` that are kept, columns unchanged.  The decision depends on the text alone, so rows with an equal
    (id, text hash) share it."""
    src = df.withColumns({"__id": F.col(id_col), "__fp": F.xxhash64(text_col)})
    rows = src.select("__id", "__fp", F.col(text_col).alias("__text"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stay = materialise(_scan(rows, model).filter(~failed & (F.col("score") >= min_score)).select("__id", "__fp"),
                       "quality-kept")
    return src.join(stay, same(src, stay, ["__id", "__fp"]), "left_semi").select(*[f"`{c}`" for c in df.columns])
