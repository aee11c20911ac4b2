"""Expressions over dense vectors held in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathkin.functions.scalars import zero_safe_div


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(
        F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda total, v: total + v,
    )


def magnitude(x: Column) -> Column:
    return F.sqrt(dot(x, x))


def cosine(x: Column, y: Column) -> Column:
    """Cosine of two arrays of equal length; 0.0 if either is all zeros."""
    return zero_safe_div(dot(x, y), magnitude(x) * magnitude(y))


def cosine_from_sums(dot_sum: Column, x_squares: Column, y_squares: Column) -> Column:
    """Cosine from whole-number sums; 0.0 if either vector is all zeros."""
    length = F.sqrt(x_squares.cast("double")) * F.sqrt(y_squares.cast("double"))
    return zero_safe_div(dot_sum.cast("double"), length)
