"""Column expressions for the warehouse functions the models use.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (reference semantics)
AMOUNT_TYPE = "decimal(28,9)"        # NUMERIC money amounts
RATE_TYPE = "decimal(18,9)"          # NUMERIC FX rates
RESULT_AMOUNT_TYPE = "decimal(38,9)"  # NUMERIC result of division
FAR_FUTURE = "9999-12-31 00:00:00"   # open end of an SCD2 interval
VERSION_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c, to: str) -> Column:
    """FS1: cast that yields NULL instead of failing (ANSI mode is on)."""
    return col(c).try_cast(to)


def strip_prefix(c, prefix: str = "fraud_") -> Column:
    """FS4: regexp_replace(m, '^fraud_', '')."""
    return F.regexp_replace(col(c), "^" + prefix, "")


def surrogate_key(*parts) -> Column:
    """FS9/AG11: hex md5 of parts joined by '|'; NULL when any part is NULL."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(col(p).cast("string"))
    return F.md5(F.concat(*pieces))


def full_name(first, last) -> Column:
    """FS6: nullif(trim(concat(coalesce(first,''), ' ', coalesce(last,''))), '')."""
    s = F.trim(F.concat(F.coalesce(col(first), F.lit("")), F.lit(" "), F.coalesce(col(last), F.lit(""))))
    return F.nullif(s, F.lit(""))


def time_key(ts) -> Column:
    """FD7: HHMMSS as an integer."""
    t = col(ts)
    return (F.hour(t) * 10000 + F.minute(t) * 100 + F.second(t)).cast("bigint")


def epoch_seconds(ts) -> Column:
    """Whole seconds since epoch (floor) of a timestamp or timestamp_ntz."""
    return F.floor(F.unix_micros(col(ts).cast("timestamp")) / F.lit(1_000_000)).cast("bigint")


def seconds_diff(a, b) -> Column:
    """FD10: timestamp_diff(a, b, SECOND), truncated toward zero."""
    return F.timestamp_diff("SECOND", col(b).cast("timestamp"), col(a).cast("timestamp"))


def year_boundaries(a, b) -> Column:
    """FD11: date_diff(a, b, YEAR) counts year boundaries, not full years."""
    return F.year(col(a)) - F.year(col(b))


def safe_divide(a, b) -> Column:
    """FM3/AG3: NULL on division by zero."""
    return F.try_divide(col(a), col(b))


def numeric_divide(a, b) -> Column:
    """NUMERIC division ``a / b``, exact and rounded once, half away from zero, to 9 digits.

    ``decimal(29,9) / decimal(18,9)`` has result type decimal(38,9).  Spark cuts
    the quotient to at least 34 significant digits before it rounds to that
    type.  With b below 10^4 no quotient comes nearer than 5e-23 to a rounding
    boundary without being on it, so below 10^10, where 23 or more digits after
    the point are left, both roundings give the one of the exact quotient.
    Other pairs are divided by hand, in a lambda: it runs for them alone, and
    its many steps are not part of the generated code of every row.
    """
    x, y = col(a).cast(AMOUNT_TYPE), col(b).cast(RATE_TYPE)
    ay = F.abs(y.cast("double"))
    near = (ay < 1e4) & (F.abs(x.cast("double")) < 1e10 * ay)
    by_hand = F.transform(F.array(F.struct(x.alias("a"), y.alias("b"))), lambda p: _long_division(p["a"], p["b"]))
    return F.when(near, x.cast("decimal(29,9)") / y).otherwise(by_hand[0])


def _long_division(a, b) -> Column:
    """``numeric_divide`` of any a and b.

    Long division on whole numbers of 1e-9: the quotient and remainder of A by
    B give the digits before the point, the remainder times 10^9 by B the nine
    after it, and twice the last remainder against B the rounding.  Each Spark
    division below has a whole quotient.  Spark's decimal arithmetic keeps 34
    significant digits, which every step fits; the result may have 37, so its
    two halves are put together as text.
    """
    nano = F.lit(10 ** 9).cast("decimal(10,0)")
    whole = lambda x: F.abs(x * nano).cast("decimal(28,0)")
    x, y = whole(col(a).cast(AMOUNT_TYPE)), whole(col(b).cast(RATE_TYPE)).cast("decimal(18,0)")
    rest = (x % y).cast("decimal(18,0)")
    units = ((x - rest) / y).cast("decimal(28,0)")
    scaled = (rest * nano).cast("decimal(28,0)")
    last = (scaled % y).cast("decimal(18,0)")
    digits = ((scaled - last) / y).cast("bigint") + F.when(2 * last >= y, 1).otherwise(0)
    units = (units + F.when(digits == 10 ** 9, 1).otherwise(0)).cast("string")
    sign = F.when((col(a) < 0) != (col(b) < 0), "-").otherwise("")
    text = F.concat(sign, units, F.lit("."), F.lpad((digits % 10 ** 9).cast("string"), 9, "0"))
    return text.cast(RESULT_AMOUNT_TYPE)


def decimal_avg(total, n) -> Column:
    """NUMERIC average: a decimal sum over a count, rounded once (half away
    from zero) to 9 digits, like AVG of a NUMERIC column; NULL when n is 0.

    ``decimal(38,9) / decimal(20,0)`` has result type decimal(38,9), so the
    quotient is rounded a single time (Spark's own ``avg`` would give 13
    digits).
    """
    return F.try_divide(col(total).cast(RESULT_AMOUNT_TYPE), col(n).cast("decimal(20,0)"))


def numeric_avg(x) -> Column:
    """AVG of a NUMERIC column (aggregate or, with ``.over``, window)."""
    return decimal_avg(F.sum(col(x)), F.count(col(x)))


def to_usd(currency, amount, rate) -> Column:
    """FM4 + CND1: USD passes through, missing/zero rate gives NULL."""
    return (F.when(col(currency) == "USD", col(amount).cast(RESULT_AMOUNT_TYPE))
            .when(col(rate).isNull() | (col(rate) == 0), F.lit(None).cast(RESULT_AMOUNT_TYPE))
            .otherwise(numeric_divide(amount, rate)))


def gender_label(g) -> Column:
    """CND1 in user staging: M/F (any case) to Male/Female, else NULL."""
    u = F.upper(col(g))
    return F.when(u == "M", "Male").when(u == "F", "Female").otherwise(F.lit(None).cast("string"))


def age_band(day, dob) -> Column:
    """CND1 in the segment mart; branch order matters (NULL day falls to 55+)."""
    y = year_boundaries(day, dob)
    return (F.when(col(dob).isNull(), "Unknown")
            .when(y < 25, "<25")
            .when(y.between(25, 34), "25-34")
            .when(y.between(35, 44), "35-44")
            .when(y.between(45, 54), "45-54")
            .otherwise("55+"))


def part_of_day(hour) -> Column:
    h = col(hour)
    return (F.when(h.between(0, 5), "Night").when(h.between(6, 11), "Morning")
            .when(h.between(12, 17), "Afternoon").otherwise("Evening"))


def is_business_hours(hour) -> Column:
    """T14: 9 to 16 inclusive."""
    return F.coalesce(col(hour).between(9, 16), F.lit(False))


def uuid5(namespace_hex: str, name) -> Column:
    """FS10: RFC 4122 version-5 UUID of ``name`` in ``namespace`` (built-ins only).

    sha1(namespace bytes || utf8(name)), first 16 bytes, version nibble 5,
    variant bits 10.
    """
    ns = F.unhex(F.lit(namespace_hex.replace("-", "")))
    h = F.sha1(F.concat(ns, F.encode(col(name), "UTF-8")))   # 40 hex chars
    h32 = F.substring(h, 1, 32)
    version = F.concat(F.lit("5"), F.substring(h32, 14, 3))
    variant_nibble = F.lower(F.hex(
        (F.conv(F.substring(h32, 17, 1), 16, 10).cast("int").bitwiseAND(0x3)).bitwiseOR(0x8)))
    clock = F.concat(variant_nibble, F.substring(h32, 18, 3))
    return F.concat_ws("-", F.substring(h32, 1, 8), F.substring(h32, 9, 4), version, clock,
                       F.substring(h32, 21, 12))


NAMESPACE_DNS = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"   # RFC 4122 fixed value
