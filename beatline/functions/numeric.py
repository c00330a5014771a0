"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent_of_count(part, total, digits: int = 2) -> Column:
    """Percent of two integer counts rounded half-up to ``digits`` decimals,
    in exact integer arithmetic (no binary rounding at the boundary):
    ``(part * 2 * 10^(digits+2) + total) div (2 * total) / 10^digits``, with
    ``div`` on 64-bit integers, so up to counts of about 4e14 at two digits.
    A zero total gives null."""
    scale = 2 * 10 ** (digits + 2)
    part, total = _c(part).cast("bigint"), _c(total).cast("bigint")
    quotient = F.call_function("div", part * scale + total, total * 2)
    return F.when(total != 0, quotient.cast("double") / F.lit(float(10 ** digits)))


def ratio_percent(num, den) -> Column:
    """num / den * 100; a zero denominator gives null."""
    den = _c(den)
    return F.when(den != 0, _c(num) / den * 100.0)


def argmax_index(arr) -> Column:
    """0-based position of the first largest element of an array column."""
    arr = _c(arr)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def round_half_even(c, digits: int = 0) -> Column:
    """Banker's rounding, as numpy's ``round``."""
    return F.bround(_c(c), digits)
