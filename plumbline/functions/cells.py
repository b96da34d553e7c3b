"""Expressions over a single cell. All of them keep a missing cell missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text cells a CSV reader takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Normalised keys that stand for "no key".
BAD_KEYS = ("", "nan", "none", "null")

# Fixed pattern: plain decimal and exponent notation. Spark's own cast also
# takes 1.5d, 0x1p3, nan and inf, which are not numbers in the input format.
NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

WHITESPACE = " \t\r\n\f\u000b"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def missing_to_null(c: Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    return F.when(~stripped(c).isin(*tokens), c)


def finite_or_null(c: Column) -> Column:
    """NaN and infinities become null: Spark orders NaN above every number."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def text_to_number(c: Column) -> Column:
    text = stripped(c)
    return finite_or_null(F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double")))


def normalised_key(c: Column) -> Column:
    return F.lower(stripped(c.cast("string")))


def is_bad_key(c: Column, tokens: Sequence[str] = BAD_KEYS) -> Column:
    return c.isNull() | c.isin(*tokens)


def has_prefix(c: Column, prefixes: Sequence[str]) -> Column:
    matched = F.lit(False)
    for prefix in prefixes:
        matched = matched | c.startswith(prefix)
    return F.coalesce(matched, F.lit(False))


def null_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def null_outside(c: Column, lo: float | None, hi: float | None) -> Column:
    return F.when(inside(c, lo, hi), c)


def inside(c: Column, lo: float | None, hi: float | None) -> Column:
    ok = c.isNotNull()
    if lo is not None:
        ok = ok & (c >= F.lit(float(lo)))
    if hi is not None:
        ok = ok & (c <= F.lit(float(hi)))
    return ok


def snap_binary(c: Column, tolerance: float = 0.1) -> Column:
    # The bounds are rounded so that 1 + 0.1 is compared as 1.1.
    near_one = c.between(round(1.0 - tolerance, 12), round(1.0 + tolerance, 12))
    near_zero = c.between(-tolerance, tolerance)
    return F.when(near_zero, F.lit(0.0)).when(near_one, F.lit(1.0))


def clip(c: Column, lo: float | None, hi: float | None) -> Column:
    # greatest/least skip nulls, so an unguarded clip would invent a bound.
    bounded = c
    if hi is not None:
        bounded = F.least(F.lit(float(hi)), bounded)
    if lo is not None:
        bounded = F.greatest(F.lit(float(lo)), bounded)
    return F.when(c.isNotNull(), bounded)


def rescue_proportion(c: Column) -> Column:
    """Proportions recorded a thousand or ten times too large, then clipped to 0..1."""
    thousandth = F.when((c > 1) & (c <= 1000), c / 1000.0).otherwise(c)
    tenth = F.when(thousandth > 1, thousandth / 10.0).otherwise(thousandth)
    return clip(tenth, 0.0, 1.0)


def close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def repaired_abs(target: Column, source: Column) -> Column:
    """``target`` replaced by ``abs(source)`` where it differs from it or is missing."""
    wrong = source.isNotNull() & (target.isNull() | ~close(target, F.abs(source)))
    return F.when(wrong, F.abs(source)).otherwise(target)


def six_digits(c: Column) -> Column:
    """Six significant digits, as a number (so that trailing zeros are not padded)."""
    # A missing cell would be printed as the word null.
    return F.when(c.isNotNull(), F.format_string("%.5e", c).try_cast("double"))


def target_forward(c: Column, method: str) -> Column:
    if method == "log1p":
        return F.log1p(c)
    if method in ("none", "", None):
        return c
    raise ValueError(f"unsupported target transform: {method}")


def target_inverse(c: Column, method: str) -> Column:
    if method == "log1p":
        return F.expm1(c)
    if method in ("none", "", None):
        return c
    raise ValueError(f"unsupported target transform: {method}")
