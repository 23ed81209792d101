"""Small numeric expressions with exactly defined edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(c: Column) -> Column:
    """Nearest integer as long, ties to even."""
    return F.rint(c).cast("long")


def or_else(a: Column, b: Column) -> Column:
    """``a`` unless it is missing or zero, else ``b``."""
    return F.coalesce(F.nullif(a, F.lit(0)), b)


def clamp(c: Column, low: Column | float, high: Column | float) -> Column:
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.greatest(lo, F.least(c, hi))


def parabolic_shift(left: Column, mid: Column, right: Column) -> Column:
    """Sub-sample place of a peak relative to its middle sample."""
    bend = left - 2 * mid + right
    return F.when(F.abs(bend) < 1e-12, F.lit(0.0)).otherwise(0.5 * (left - right) / bend)
