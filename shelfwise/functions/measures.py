"""Sums, ratios and fallbacks used by the gold measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_money(column: Column) -> Column:
    """Sum a double column of amounts so that the result does not depend on row order.

    Amounts with at most two decimals add up exactly, as whole cents in a long. If any amount in
    the group is not such a value (sub-cent, NaN, infinite, out of range), the plain double sum is
    used, so no amount is rounded or lost.
    """
    cents = F.rint(column * 100).try_cast("bigint")
    inexact = column.isNotNull() & ~F.coalesce(cents / F.lit(100.0) == column, F.lit(False))
    total = (F.try_sum(cents).cast("decimal(20,0)") / 100).cast("double")
    exact_sum = F.coalesce(total, F.sum(column))
    return F.when(F.coalesce(F.bool_or(inexact), F.lit(False)), F.sum(column)).otherwise(exact_sum)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator."""
    return F.try_divide(numerator, denominator)


def first_known(*candidates) -> Column:
    return F.coalesce(*[c if isinstance(c, Column) else F.lit(c) for c in candidates])
