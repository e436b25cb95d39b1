"""Numeric column expressions: tolerant parsing, safe ratios, score arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

NUMERIC_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_float(c) -> Column:
    """Strip, '' -> NULL, ',' -> '.', then a plain decimal/scientific number or NULL.
    ("1,234.56" therefore gives NULL.)"""
    s = F.replace(strip(_c(c).cast("string")), F.lit(","), F.lit("."))
    return F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))


def round_half_up(x, digits: int = 2) -> Column:
    """Half-away-from-zero rounding of a double without binary-noise surprises: the value
    is fixed to 10 decimals first (so 1.005 rounds to 1.01 like exact numeric would). Values
    beyond 28 digits have no cents to round and stay as they are."""
    x = _c(x)
    exact = F.round(x.try_cast("decimal(38,10)"), digits).cast("double")
    return F.coalesce(exact, x.cast("double"))


def safe_pct(num, den, digits: int = 2) -> Column:
    """round(100 * num / den, 2); NULL when den is 0 or NULL."""
    ratio = F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))
    return round_half_up(ratio, digits)


def interest_value(c) -> Column:
    """Interest text -> int 0..100: '<1' -> 0, number truncated toward zero, clamped.
    Unparseable (including NaN / Infinity) -> NULL, i.e. the point is skipped."""
    return interest_reading(interest_number(interest_text(c)))


def interest_text(c) -> Column:
    """The text of a reading without blanks and quotes around it."""
    return F.regexp_replace(strip(_c(c).cast("string")), '^"+|"+$', "")


def interest_number(text) -> Column:
    """The number of an ``interest_text``; 0 for '<1', NULL for what is no number."""
    s = _c(text)
    return F.when(s == "<1", F.lit(0.0)).when(s.rlike(NUMERIC_RE), s.try_cast("double"))


def interest_reading(number) -> Column:
    """An ``interest_number`` as the reading it stands for."""
    return clamp(number, 0.0, 100.0).cast("int")


def clamp(c, lo, hi) -> Column:
    """lo <= c <= hi; NULL stays NULL (least/greatest alone would skip the NULL and
    return a bound)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def price_value(c) -> Column:
    """A price stored as a number, numeric text, or a JSON scalar / {"price": x} text
    -> double (NULL when none of these parse)."""
    t = strip(_c(c).cast("string"))
    return F.coalesce(safe_float(t),
                      safe_float(F.get_json_object(t, "$.price")),
                      safe_float(F.regexp_replace(t, '^"|"$', "")))
