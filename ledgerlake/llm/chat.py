"""Relational chat formatting (Spark expressions only).

One conversation becomes one training text::

    <s>[INST]role[/INST]text</s>text</s>[INST]role[/INST]text</s>

Its turns are collected as structs, sorted, and adjacent turns of one role are merged into a run with one role header;
every turn of the run keeps its own end mark, so the turns can be read back.  The control strings are
``<s> </s> [INST] [/INST]``.  Inside a role or text, a control string gets one more backslash after its first character
(``</s>`` becomes ``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``), which is undone exactly by taking one away.

``loss_spans`` are the byte ranges (start from 0, length; UTF-8) of the assistant turns' texts in the formatted text:
the loss mask.

Defined cases: a null text or role is empty; a null turn sorts first; turns with the same number are ordered by role,
then text, and repeated rows are separate turns; a null conversation id is a conversation of its own; an empty table
gives an empty result; other columns are ignored.  A conversation is one output value, so it must fit one row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END, ROLE, END_ROLE = "<s>", "</s>", "[INST]", "[/INST]"
_MARK = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _MARK, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPED, "$1$2$3")


def _quoted(mark: str) -> str:
    return mark.replace("[", r"\[").replace("]", r"\]")


def format_chat(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """(conv id, formatted, loss_spans array<struct<start,len>>), one row per conversation."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    conv = df.select(F.col(conv_col).alias("__conv"), turn.alias("__t")).groupBy("__conv").agg(
        F.sort_array(F.collect_list("__t")).alias("__turns"))
    # a run starts where the role differs from the turn before
    starts = F.filter(F.sequence(F.lit(1), F.size("__turns")), lambda i: (i == 1) | (
        F.element_at("__turns", i)["role"] != F.element_at("__turns", F.greatest(i - 1, F.lit(1)))["role"]))
    conv = conv.withColumn("__starts", starts)
    runs = F.transform("__starts", lambda s, k: F.slice(
        "__turns", s, F.coalesce(F.get("__starts", k + 1), F.size("__turns") + 1) - s))
    conv = conv.withColumn("__runs", F.transform(runs, lambda r: F.struct(
        F.element_at(r, 1)["role"].alias("role"), F.transform(r, lambda t: escape(t["text"])).alias("texts"))))
    # the pieces of the output: a header per run, then the run's texts, each with its end mark
    piece = lambda s, gap, loss: F.struct(s.alias("s"), gap.alias("gap"), loss.alias("loss"))
    pieces = F.flatten(F.transform("__runs", lambda r: F.concat(
        F.array(piece(F.concat(F.lit(ROLE), escape(r["role"]), F.lit(END_ROLE)), F.lit(0), F.lit(False))),
        F.transform(r["texts"], lambda x: piece(F.concat(x, F.lit(END)), F.lit(len(END)),
                                                r["role"] == F.lit(loss_role))))))
    conv = conv.select("__conv", pieces.alias("__pieces"))
    conv = conv.select("__conv", F.concat(F.lit(BEGIN), F.array_join(F.transform("__pieces", lambda p: p["s"]), ""))
                       .alias("formatted"),
                       F.transform("__pieces", lambda p: F.struct(
                           F.octet_length(p["s"]).cast("long").alias("n"), p["gap"].cast("long").alias("gap"),
                           p["loss"].alias("loss"))).alias("__lens"))
    return conv.select(F.col("__conv").alias(conv_col), "formatted", _spans("__lens").alias("loss_spans"))


STRETCH = 256   # pieces whose lengths are added up at once


def _spans(lens: str) -> Column:
    """The pieces under the loss mask as (start, len).  A piece starts where the lengths before it end: the sum of whole
    stretches, made once, and of the pieces before it in its own stretch."""
    add = lambda at, p: at + p["n"]
    zero, size = F.lit(0).cast("long"), F.size(lens)
    stretches = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / STRETCH).cast("int")),
                            lambda c: F.aggregate(F.slice(lens, c * STRETCH + 1, F.lit(STRETCH)), zero, add))

    def spans(bases):
        def placed(p, k):
            own = F.aggregate(F.slice(lens, k - k % STRETCH + 1, k % STRETCH), zero, add)
            start = F.element_at(bases, F.floor(k / STRETCH).cast("int") + 1) + own
            return F.struct(p["loss"].alias("loss"), start.alias("start"), (p["n"] - p["gap"]).alias("len"))
        masked = F.filter(F.transform(lens, placed), lambda s: s["loss"])
        return F.transform(masked, lambda s: F.struct(s["start"].alias("start"), s["len"].alias("len")))
    first = F.array(F.lit(len(BEGIN)).cast("long"))
    return F.aggregate(stretches, first, lambda b, n: F.array_append(b, F.element_at(b, -1) + n), spans)


def parse_chat(formatted: Column) -> Column:
    """The turns of a formatted text: array<struct<role,text>>."""
    body = F.substr(formatted, F.lit(len(BEGIN) + 1))
    runs = F.filter(F.split(body, _quoted(ROLE), -1), lambda _, i: i > 0)

    def turns(run):
        role = F.split(run, _quoted(END_ROLE), -1)
        texts = F.split(F.element_at(role, 2), END, -1)
        return F.transform(F.slice(texts, F.lit(1), F.size(texts) - 1), lambda t: F.struct(
            unescape(F.element_at(role, 1)).alias("role"), unescape(t).alias("text")))
    return F.flatten(F.transform(runs, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    raw = F.encode(formatted, "UTF-8")
    return F.array_join(F.transform(spans, lambda s: unescape(F.decode(
        F.substr(raw, (s["start"] + 1).cast("int"), s["len"].cast("int")), "UTF-8"))), "")
