"""Figures for manifests and run reports."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

MIB = 1024 * 1024


def _tenths(fraction: Column) -> Column:
    """0..10: a fraction in [0, 1) rounded to tenths on its exact binary value, ties to even."""
    total = F.lit(0)
    for digit in range(10):
        exact = Fraction(2 * digit + 1, 20)
        nearest = float(exact)
        upward = Fraction(nearest) > exact or (Fraction(nearest) == exact and digit % 2 == 1)
        passed = fraction >= nearest if upward else fraction > nearest
        total = total + passed.cast("int")
    return total


def compression_ratio(raw: Column, compressed: Column) -> Column:
    """Share of bytes saved, as text with one digit: `87.5%`.

    `format_string` would round half up on the shortest decimal form of the double. This
    rounds the exact double half to even, which is what manifest consumers compare with.
    """
    raw, compressed = raw.cast("double"), compressed.cast("double")
    saved = (F.lit(1.0) - F.try_divide(compressed, raw)) * 100.0
    size = F.abs(saved)
    tenths = _tenths(size - F.floor(size))
    whole = F.floor(size) + F.when(tenths == 10, 1).otherwise(0)
    text = F.concat(
        F.when(saved < 0, "-").otherwise(""),
        whole.cast("string"),
        F.lit("."),
        F.pmod(tenths, F.lit(10)).cast("string"),
        F.lit("%"),
    )
    return F.when(raw > 0, text).when(compressed > 0, "-inf%").otherwise("NaN%")


def ratio_text(raw: int, compressed: int) -> str:
    """`compression_ratio` of one file, for the writer task."""
    if raw == 0:
        return "-inf%" if compressed else "NaN%"
    return f"{(1.0 - compressed / raw) * 100.0:.1f}%"


def rate(count: Column, seconds: Column) -> Column:
    """Events per second to two digits; 0 where no time has passed."""
    per_second = F.try_divide(count.cast("double"), seconds.cast("double"))
    return F.when(seconds > 0, F.round(per_second * 100.0, 0) / 100.0).otherwise(F.lit(0.0))
