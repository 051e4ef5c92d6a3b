"""URL filter: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

A listed URL sets one bit in each of the four 64-bit words of one block; the block is picked by the low bits of its
hash.  The filter is built by Spark (bit_or per block).  It gets a block for every ``PER_BLOCK`` listed URLs, as a power
of two from ``LEAST_BLOCKS`` to ``MOST_BLOCKS``: rows of 40 bytes, 160 MB (4,194,304 blocks) at most.  Up to
``BROADCAST_BLOCKS`` (2.6 MB) it is broadcast; a larger one is joined by block, salted like the list.  A page whose four bits are all set is a possible hit; only possible hits
are joined with the list by the whole canonical URL, which removes the false positives.  A fuller filter lets more
pages through to the exact join and never changes a verdict.

A canonical URL drops the scheme, a leading ``www.`` or ``m.`` label, the query, the fragment, a final ``.html`` and
final slashes.

Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and is never listed; repeated
pages are separate rows; an empty list blocks nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise

_URL = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
WORDS = ["__w0", "__w1", "__w2", "__w3"]
PER_BLOCK = 16   # of 64 bits in a word about a fifth are set: one page in 400 or so is a false hit
LEAST_BLOCKS, MOST_BLOCKS, BROADCAST_BLOCKS = 1 << 10, 1 << 22, 1 << 16


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host and path of a page without what varies between copies of it; null for an empty host."""
    page = F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html)?/*$", ""))
    return F.when(host != "", page)


def fits(host: Column, path: Column, rule: str) -> Column:
    """The rule ``host/path`` fits its host and all subdomains, if the path starts with the rule's."""
    rule_host, slash, rest = rule.partition("/")
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)


def blocks_for(n_listed: int) -> int:
    """Blocks of the filter for a list of so many canonical URLs."""
    want = max(1, -(-n_listed // PER_BLOCK))
    return min(MOST_BLOCKS, max(LEAST_BLOCKS, 1 << (want - 1).bit_length()))


def bloom(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(__block, four words) of the distinct canonical URLs in column ``__url``."""
    keyed = listed.select("__url", F.xxhash64("__url").alias("__h"))
    return keyed.select(_block(n_blocks), *_bits()).groupBy("__block").agg(
        *[F.bit_or(w).alias(w) for w in WORDS])


def _block(n_blocks: int) -> Column:
    return F.pmod(F.col("__h"), F.lit(n_blocks)).cast("int").alias("__block")


def _bits() -> list[Column]:
    second = F.xxhash64("__url", F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")).alias(w)
            for i, w in enumerate(WORDS)]


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
               url_col: str = "url", listed_col: str = "url", n_blocks: int | None = None,
               salts: int = 8) -> DataFrame:
    """(id, host, path, rule, verdict, listed) per page.  ``rules``: (verdict, "host/path"); the longest that fits wins.

    ``listed``: URLs to block where no rule fits, any variant of the same canonical URL.  One canonical URL may be the
    page of a third of all rows: the exact join deals it over ``salts`` keys.  ``n_blocks``: by the list's count if None.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    page = pages.select(F.col(id_col).alias("__id"), host.alias("__host"), path.alias("__path"))
    page = page.withColumn("__url", canonical(F.col("__host"), F.col("__path")))
    bad = listed.select(canonical(host_of(F.col(listed_col)), path_of(F.col(listed_col))).alias("__url"))
    bad = materialise(bad.filter("__url is not null").distinct(), "url-list")
    n_blocks = blocks_for(bad.count()) if n_blocks is None else n_blocks

    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):   # the longest is tested first
        hit = fits(F.col("__host"), F.col("__path"), r)
        rule, verdict = F.when(hit, F.lit(r)).otherwise(rule), F.when(hit, F.lit(says)).otherwise(verdict)
    page = page.withColumns({"__rule": rule, "__says": verdict, "__h": F.xxhash64("__url")})
    page = page.withColumn("__block", _block(n_blocks))
    blocks = bloom(bad, n_blocks).withColumnsRenamed({w: f"{w}f" for w in WORDS})
    page = page.withColumn("__salt", F.pmod(F.xxhash64("__id", "__host", "__path"), F.lit(salts)))
    every_salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("__salt")
    if n_blocks <= BROADCAST_BLOCKS:
        probe = page.join(F.broadcast(blocks), "__block", "left")
    else:   # pages without a URL or with a rule need no block
        asks = F.col("__url").isNotNull() & F.col("__rule").isNull()
        asked = page.filter(asks).join(blocks.select("*", every_salt), ["__block", "__salt"], "left")
        none = page.filter(~asks).withColumns({f"{w}f": F.lit(None).cast("long") for w in WORDS})
        probe = asked.unionByName(none)
    maybe = F.lit(True)
    for w, bit in zip(WORDS, _bits()):
        maybe = maybe & (F.col(f"{w}f").bitwiseAND(bit) != 0)
    probe = probe.withColumn("__maybe", F.coalesce(maybe & F.col("__url").isNotNull(), F.lit(False)))
    # only possible hits carry a join key; all others keep a null key and need no partner
    probe = probe.withColumn("__key", F.when(F.col("__maybe") & F.col("__rule").isNull(), F.col("__url")))
    rest = probe.filter("__key is null").withColumn("__listed", F.lit(False))
    salted = bad.select(F.col("__url").alias("__key"), F.lit(True).alias("__listed"), every_salt)
    hits = probe.filter("__key is not null").join(salted, ["__key", "__salt"], "left")
    out = rest.unionByName(hits.withColumn("__listed", F.coalesce("__listed", F.lit(False))))
    return out.select(F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"),
                      F.col("__rule").alias("rule"),
                      F.coalesce("__says", F.when(F.col("__listed"), F.lit("block")).otherwise(F.lit("allow")))
                      .alias("verdict"), F.col("__listed").alias("listed"))
