"""Rounded ratios.

Values are scaled before they are rounded, as binary doubles: rounding their decimal text
would treat 36.325, which is a little more than that, as a tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even2(value: Column) -> Column:
    """Two places, ties to the even neighbour."""
    return F.rint(value * 100) / 100


def half_up2(value: Column) -> Column:
    """Two places, ties away from zero."""
    return F.round(value * 100, 0) / 100


def percent(part: Column, whole: Column, when_empty: float) -> Column:
    """100 * part / whole to two places."""
    ratio = half_even2(part / F.nullif(whole, F.lit(0)) * 100)
    return F.coalesce(ratio, F.lit(when_empty)).cast("double")


def mean2(value: Column) -> Column:
    return half_even2(F.avg(value))
