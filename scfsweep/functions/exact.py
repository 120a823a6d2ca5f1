"""Sums and means of doubles that are the same to the last bit in whatever order rows arrive.

A value becomes two whole numbers: its floor in steps of 2**-20, and the rest in steps of 2**-50. Whole
numbers add up exactly, so partial aggregation, partition counts and retries leave no trace, and a value
can be taken out again. Values of 2**24 and more, infinities and NaN are added as doubles beside them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COARSE, FINE, LARGE = 2.0**20, 2.0**50, 2.0**24


def _small(value: Column) -> Column:
    return F.abs(value) < LARGE


def _coarse(value: Column) -> Column:
    return F.floor(value * COARSE)


def coarse(value: Column) -> Column:
    return F.when(_small(value), _coarse(value))


def fine(value: Column) -> Column:
    return F.when(_small(value), F.floor((value - _coarse(value) / COARSE) * FINE + 0.5))


def wide(value: Column) -> Column:
    return F.when(~_small(value), value)


def joined(coarse_sum: Column, fine_sum: Column, wide_sum: Column) -> Column:
    """The sum that the three sums make."""
    zero = F.lit(0)
    return F.coalesce(coarse_sum, zero).cast("double") / COARSE + F.coalesce(fine_sum, zero).cast("double") / FINE + F.coalesce(wide_sum, F.lit(0.0))


def exact_mean(value: Column) -> Column:
    """Aggregate: the mean of the values that aren't NULL; NULL where there are none."""
    total = joined(F.sum(coarse(value)), F.sum(fine(value)), F.sum(wide(value)))
    return F.when(F.count(value) > 0, total / F.count(value))
