"""Array expressions; each works inside one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def linspace(start: Column, stop: Column, n: int) -> Column:
    """``n`` evenly spaced doubles with both ends included."""
    step = (stop - start) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: start + i * step)


def with_scalar(a: Column, op, scalar) -> Column:
    """``op(x, scalar)`` on every element."""
    return F.transform(a, lambda x: op(x, F.lit(scalar)))


def pairwise(a: Column, b: Column, op) -> Column:
    """``op(x, y)`` on elements at the same place; the lengths must agree."""
    zipped = F.zip_with(a, b, op)
    unequal = F.raise_error(F.lit("arrays of different length"))
    return F.when(F.size(a) == F.size(b), zipped).otherwise(unequal)


def dot(a: Column, weights: Sequence[float] | Column) -> Column:
    """Weighted sum of an array of doubles."""
    w = weights if isinstance(weights, Column) else F.array(*[F.lit(float(x)) for x in weights])
    return F.aggregate(pairwise(a, w, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def every_nth(a: Column, n: int) -> Column:
    return F.filter(a, lambda x, i: i % n == 0)


def last(a: Column, n: int) -> Column:
    """The last ``n`` elements, or all of a shorter array."""
    return F.slice(a, F.greatest(F.size(a) - n + 1, F.lit(1)), n)


def reshape(a: Column, rows: int, columns: int) -> Column:
    """One level into ``rows`` arrays of ``columns``; any other length is an error."""
    split = F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: F.slice(a, r * columns + 1, columns))
    wrong = F.raise_error(F.lit("the array does not fill the shape"))
    return F.when(F.size(a) == rows * columns, split).otherwise(wrong)


def zip_to_map(keys: Column, values: Column) -> Column:
    """A map from two arrays of equal length."""
    unequal = F.raise_error(F.lit("arrays of different length"))
    return F.when(F.size(keys) == F.size(values), F.map_from_arrays(keys, values)).otherwise(unequal)


def zip_rows(a: Column, b: Column) -> Column:
    """Pairs by position; the shorter array must not be padded, so lengths must agree."""
    unequal = F.raise_error(F.lit("arrays of different length"))
    return F.when(F.size(a) == F.size(b), F.arrays_zip(a, b)).otherwise(unequal)
