"""Range parts of a column by bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bounds_over(value: Column, bounds: list[float]) -> Column:
    """How many of the bounds are larger than value; null counts as less than all. One flat array: a sum of one comparison each would nest as deep as there are bounds."""
    return F.when(value.isNull(), len(bounds)).otherwise(_count(bounds, lambda b: value < b))


def bounds_under(value: Column, bounds: list[float]) -> Column:
    """How many of the bounds are less than value; none for null."""
    return F.when(value.isNull(), 0).otherwise(_count(bounds, lambda b: value > b))


def _count(bounds: list[float], keep) -> Column:
    return F.size(F.filter(F.array(*(F.lit(float(b)) for b in bounds)), keep)) if bounds else F.lit(0)
