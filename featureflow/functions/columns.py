"""Native Column builders for the scalar features (B-family, §2.2 of the survey).

All of these are plain Catalyst expressions: they stay inside whole-stage codegen,
never start a Python worker, and can be pushed through projections and filters.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag_count(cols: Iterable, value: str = "Yes") -> Column:
    """B2: how many of ``cols`` equal ``value``; a null counts as "not equal"; bigint."""
    terms = [F.coalesce(_c(c) == F.lit(value), F.lit(False)).cast("bigint") for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def recode_expr(col, mapping: Mapping[str, str]) -> Column:
    """Value map on the text form of ``col``; unmapped values and nulls -> null."""
    c = _c(col).cast("string")
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr if expr is not None else F.lit(None).cast("string")


# Text that counts as blank and as a number: any white space around, no type suffix such as 1.5d.
WHITE = " \t\n\x0b\f\r"
BLANK = r"^[\x20\x09-\x0D]*$"
NUMBER = r"^[\x20\x09-\x0D]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[\x20\x09-\x0D]*$"


def parse_number_expr(col, blank: float = 0.0) -> Column:
    """Text -> double; blank/whitespace -> ``blank``; unparsable or null -> null."""
    c = _c(col).cast("string")
    return F.when(c.rlike(BLANK), F.lit(blank)).when(c.rlike(NUMBER), F.btrim(c, F.lit(WHITE)).try_cast("double"))


def parse_rejected(col) -> Column:
    """True where the text is neither blank nor a number (counted, never hidden)."""
    c = _c(col).cast("string")
    return c.isNotNull() & ~c.rlike(BLANK) & parse_number_expr(c).isNull()


def coerce_numeric_expr(col) -> Column:
    """Anything -> double, errors -> null."""
    return _c(col).cast("string").try_cast("double")


def price_increase(monthly, tenure, total) -> Column:
    """Last monthly charge minus the mean charge; 0 when tenure <= 0; FLOAT.

    The guard comes before the division, so ANSI mode never sees a zero divisor.
    Null inputs give null (as a Python function returning on None would).
    """
    m, t, tot = _c(monthly).cast("double"), _c(tenure).cast("double"), _c(total).cast("double")
    return (F.when(t > 0, m - tot / F.when(t > 0, t))
            .when(t.isNotNull(), F.lit(0.0))
            .cast("float"))


def ceil_timestamp(col, minutes: int) -> Column:
    """Ceil a timestamp to a ``minutes`` grid (exact in integer microseconds).

    Works for TIMESTAMP and TIMESTAMP_NTZ (the grid is anchored at the epoch, in
    the session time zone, which this library pins to UTC). Returns TIMESTAMP; cast
    to ``timestamp_ntz`` to keep zone-less data zone-less.
    """
    c = _c(col)
    step = minutes * 60 * 1_000_000
    us = F.unix_micros(c.cast("timestamp"))
    # integer ceil, no floating point: x - pmod(x, step) with x = us + step - 1
    x = us + F.lit(step - 1)
    up = F.timestamp_micros(x - F.pmod(x, F.lit(step)))
    return up


def ceil_unix_seconds(col, minutes: int) -> Column:
    """Ceiled time as unix seconds (bigint; the reference's int32 overflows in 2038)."""
    return F.unix_seconds(ceil_timestamp(col, minutes))


def decode_label(col, positive: str = "Yes") -> Column:
    """label/prediction text -> 1.0 / 0.0; null -> 0.0."""
    return F.when(_c(col) == F.lit(positive), F.lit(1.0)).otherwise(F.lit(0.0))


def round_metric(col, digits: int = 4) -> Column:
    """Half-up rounding of a stored metric.

    Implemented as floor(x * 10^d + 0.5) / 10^d in IEEE doubles, which is what any
    engine computes identically; Spark's decimal-based ``round`` can differ by one
    unit in the last place from engines that scale in floating point. NaN, infinities
    and values of 2^52 units or more, which have no digits left to round, stay as they are.
    """
    s, x = float(10 ** digits), _c(col).cast("double")
    small = ~F.isnan(x) & (F.abs(x * F.lit(s)) < F.lit(float(2**52)))
    return F.when(x.isNull() | ~small, x).otherwise((F.floor(x * F.lit(s) + F.lit(0.5)) / F.lit(s)).cast("double"))


def to_time(col, fmt: str | None = None) -> Column:
    """Epoch seconds (numeric) or text -> TIMESTAMP_NTZ."""
    c = _c(col)
    if fmt is not None:
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt)).cast("timestamp_ntz")
    return F.timestamp_seconds(c).cast("timestamp_ntz")


def text_to_time(col) -> Column:
    return F.try_to_timestamp(_c(col).cast("string")).cast("timestamp_ntz")


def key_hash32(key, salt: str) -> Column:
    """Integer in [0, 2^32) from md5(key ':' salt) -- stable under any partitioning."""
    h = F.md5(F.concat(_c(key).cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
