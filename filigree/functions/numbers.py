"""Numeric helpers whose results do not depend on the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int = 0) -> Column:
    """Round the binary double half away from zero.

    Spark's ``round`` works on the shortest decimal form of a double, so 1.005
    becomes 1.01; SQL engines that scale the binary value give 1.0.
    """
    scale = float(10**digits)
    x = value.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / F.lit(scale)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero."""
    return round_half_away(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded quotient; null when ``whole`` is zero."""
    return round_half_away(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def with_unit(value: Column, unit: str) -> Column:
    """Report text such as ``12.5M``."""
    return F.concat(F.format_string("%.2f", round_half_away(value, 2)), F.lit(unit))
