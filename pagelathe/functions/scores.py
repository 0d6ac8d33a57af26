"""Agreement of line sets, as column expressions over arrays of line numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sizes(a: Column, b: Column) -> tuple[Column, Column, Column]:
    return F.size(F.array_intersect(a, b)), F.size(F.array_distinct(a)), F.size(F.array_distinct(b))


def _part(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(0.0)


def iou(found: Column, truth: Column) -> Column:
    """Common lines over all lines; 1 if both are empty, null if either is null."""
    both, a, b = _sizes(found, truth)
    return F.when(found.isNull() | truth.isNull(), None).when((a == 0) & (b == 0), 1.0).otherwise(_part(both, a + b - both))


def precision(found: Column, truth: Column) -> Column:
    both, a, b = _sizes(found, truth)
    return F.when(found.isNull() | truth.isNull(), None).when((a == 0) & (b == 0), 1.0).otherwise(_part(both, a))


def recall(found: Column, truth: Column) -> Column:
    both, a, b = _sizes(found, truth)
    return F.when(found.isNull() | truth.isNull(), None).when((a == 0) & (b == 0), 1.0).otherwise(_part(both, b))


def cut_to_lines(truth: Column, lines: Column) -> Column:
    """The truth without numbers that no line has; null for null."""
    return F.when(truth.isNull() | lines.isNull(), None).otherwise(F.array_intersect(truth, lines))


def missed(found: Column, truth: Column) -> Column:
    """Lines of the truth that were not found, in ascending order; null if either is null."""
    return F.when(found.isNull() | truth.isNull(), None).otherwise(F.array_sort(F.array_except(truth, found)))


def f_beta(found: Column, truth: Column, beta: float = 2.0) -> Column:
    """Weighted harmonic mean of precision and recall; 0 for an answer that could not be read (null)."""
    p, r = precision(found, truth), recall(found, truth)
    square = beta * beta
    return (
        F.when(found.isNull(), 0.0)
        .when((F.size(found) == 0) & (F.size(truth) == 0), 1.0)
        .when(p + r == 0, 0.0)
        .otherwise((1 + square) * p * r / (square * p + r))
    )
