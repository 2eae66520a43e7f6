"""Vector arithmetic and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_norm(vector: Column) -> Column:
    """Euclidean norm of an array column."""
    squares = F.aggregate(
        vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def threshold_mask(value: Column, limit: float, below: bool = False) -> Column:
    """True above the limit, or below it."""
    return value < limit if below else value > limit


def outside_box(x: Column, y: Column, bound: float) -> Column:
    """True outside the square of half-width ``bound`` around the origin."""
    return (x < -bound) | (x > bound) | (y < -bound) | (y > bound)


def any_nan(vector: Column) -> Column:
    """True if an element of the array is NaN."""
    return F.exists(vector, F.isnan)
