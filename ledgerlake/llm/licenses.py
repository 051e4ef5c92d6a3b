"""Licence scan with a positional rare-token index (Spark expressions only).

A template is a licence notice as a word sequence with mandatory key phrases.  Document frequencies of all template
words are counted over the whole table; each template is indexed under its ``rare`` words of highest IDF, as postings
(word, position in the template).  A file's words that are in the index are looked up with their positions; for
each template the positions, less the word's place in the template, are intersected, so only starts that all its rare
words agree on are left, and there every mandatory phrase is compared word by word.  Which words are rare only
decides the cost, never the places found, because the indexed words are words of the mandatory phrases.

Defined cases: a null text is empty (no words); repeated rows are separate rows; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
# label -> (notice, mandatory phrases as (first word in the notice, length))
TEMPLATES = {
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", [(2, 5)]),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", [(2, 5)]),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", [(6, 6)]),
    "apache-2.0": ("licensed under the apache license version 2 0", [(3, 5)]),
    "mit": ("released under the mit license", [(3, 2)]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",
            [(0, 8), (11, 3)]),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", [(6, 3)]),
}
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Maximal runs of digits, letters A-Z and characters outside ASCII, lower-cased.

    The templates are ASCII, so it does not matter that other letters are lower-cased too, but for the Kelvin sign, the
    one character whose lower case is a plain a-z; it is replaced first."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.array_remove(F.split(plain, SEPARATOR, -1), "")


def _templates():
    out = {label: (phrase.split(), [(0, len(phrase.split()))]) for label, phrase in BASE.items()}
    return out | {label: (notice.split(), must) for label, (notice, must) in TEMPLATES.items()}


def document_frequencies(tokens: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of rows, and for each template word the rows that have it (as many entries as template words)."""
    vocabulary = sorted({w for words, _ in _templates().values() for w in words})
    found = tokens.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(
        "__words", F.array(*[F.lit(w) for w in vocabulary])))).alias("w")).groupBy("w").count()
    counts = {r["w"]: r["count"] for r in found.collect()}
    return counts.pop("", 0), counts


def rare_words(n_docs: int, df: dict[str, int], rare: int) -> dict[str, list[int]]:
    """label -> places, in the template, of its highest-IDF words within the mandatory phrases."""
    idf = lambda w: math.log((n_docs + 1) / (df.get(w, 0) + 1))
    out = {}
    for label, (words, must) in _templates().items():
        places = [i for start, n in must for i in range(start, start + n)]
        out[label] = sorted(places, key=lambda i: (-idf(words[i]), i))[:rare]
    return out


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = 2) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches) per row.

    ``matches`` lists the places found: array<struct<label, start, matched>>, matched being the share of the
    notice's words that stand in their place.  ``score`` is the largest share (0 without a match).
    """
    tokens = df.select(F.col(id_col).alias("__id"), words_of(F.col(text_col)).alias("__words"))
    index = rare_words(*document_frequencies(tokens), rare)
    templates = _templates()
    indexed = sorted({templates[label][0][i] for label, places in index.items() for i in places})

    hits = F.filter(F.transform("__words", lambda w, i: F.when(w.isin(indexed), F.struct(
        w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
    rows = tokens.select("__id", F.size("__words").cast("long").alias("__n"), "__words", hits.alias("__hits"))

    def places(label: str) -> Column:
        words, must = templates[label]
        starts = None
        for at in index[label]:
            one = F.transform(F.filter("__hits", lambda h: h["w"] == words[at]), lambda h: h["i"] - at)
            starts = one if starts is None else F.array_intersect(starts, one)

        def stands(s):
            ok = F.lit(True)
            for first, n in must:
                for k in range(first, first + n):
                    ok = ok & F.coalesce(F.get("__words", s + k) == words[k], F.lit(False))
            return ok

        def share(s):
            hit = F.lit(0)
            for k, w in enumerate(words):
                hit = hit + F.coalesce(F.get("__words", s + k) == w, F.lit(False)).cast("int")
            return hit / len(words)
        return F.transform(F.filter(starts, stands), lambda s: F.struct(
            F.lit(label).alias("label"), s.cast("long").alias("start"), share(s).alias("matched")))

    none = F.array().cast("array<struct<label:string,start:bigint,matched:double>>")
    found = F.when(F.size("__hits") > 0, F.concat(*[places(x) for x in templates])).otherwise(none)
    rows = rows.select("__id", "__n", found.alias("__found"))
    base = F.filter("__found", lambda m: m["label"].isin(list(BASE)))
    rows = rows.withColumn("__base", base)
    starts = F.transform("__base", lambda m: m["start"])
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda m: m["label"]))), ",")
    return rows.select(
        F.col("__id").alias(id_col), F.col("__n").alias("n_words"), F.size("__base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("__base").alias("base_labels"), labels("__found").alias("labels"),
        F.coalesce(F.array_max(F.transform("__found", lambda m: m["matched"])), F.lit(0.0)).alias("score"),
        F.col("__found").alias("matches"))
