"""Exact numbers: truncation toward zero, tolerance, counting totals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths(x: Column) -> Column:
    """Hundredths of a number, cut toward zero (never rounded)."""
    return (x.cast("double") * 100).cast("long")


def close(a: Column, b: Column, tolerance: int, both_null: bool) -> Column:
    """Equality within a tolerance; two nulls are equal or not as told, one null is not."""
    return F.when(a.isNull() & b.isNull(), F.lit(both_null)).when(a.isNull() | b.isNull(), F.lit(False)).otherwise(F.abs(a - b) <= tolerance)


def total(marks: Column) -> Column:
    return F.aggregate(marks, F.lit(0).cast("long"), lambda a, x: a + x)


def counting_total(marks: Column, trimmed: Column) -> Column:
    """Without the highest and the lowest mark where the rule says so and five or more judges marked."""
    return total(marks) - F.when(trimmed & (F.size(marks) >= 5), F.array_max(marks) + F.array_min(marks)).otherwise(0)
