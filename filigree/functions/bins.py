"""Temporal bins and threshold labels."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bin(NamedTuple):
    """An inclusive range of years."""

    label: str
    first: int
    last: int


# The year ranges of the published three-bin and five-bin tables.
THREE_BINS = (
    Bin("bin_2006_2009", 2006, 2009),
    Bin("bin_2010_2015", 2010, 2015),
    Bin("bin_2016_2020", 2016, 2020),
)
FIVE_BINS = (
    Bin("bin_1993_2000", 1993, 2000),
    Bin("bin_2001_2005", 2001, 2005),
    Bin("bin_2006_2010", 2006, 2010),
    Bin("bin_2011_2015", 2011, 2015),
    Bin("bin_2016_2020", 2016, 2020),
)


def temporal_bin(year: Column, bins: Sequence[Bin], other: str | None = None) -> Column:
    """The label of the bin that holds ``year``; ``other`` (or null) outside all bins."""
    label = F.lit(other).cast("string")
    for b in reversed(bins):
        label = F.when(year.between(b.first, b.last), F.lit(b.label)).otherwise(label)
    return label


def year_span(bins: Sequence[Bin]) -> tuple[int, int]:
    """First and last year covered by ``bins``."""
    return min(b.first for b in bins), max(b.last for b in bins)


def iso_in_years(iso_date: Column, first: int, last: int) -> Column:
    """Year window on ISO date text, written as a text range so the scan can prune row groups."""
    return (iso_date >= F.lit(f"{first:04d}-01-01")) & (iso_date < F.lit(f"{last + 1:04d}-01-01"))


def label_by_threshold(value: Column, steps: Sequence[tuple[float, str]], other: str) -> Column:
    """First label whose threshold ``value`` reaches; thresholds are given high to low."""
    label = F.lit(other)
    for floor, name in reversed(steps):
        label = F.when(value >= F.lit(floor), F.lit(name)).otherwise(label)
    return label
