"""Exact sums and means over amounts that are stored as doubles.

Adding doubles gives a result that depends on the order of the rows, hence on partitioning. Amounts are added
as decimals instead and turned back into doubles at the end, so every plan yields the same digits.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Ten decimals, and 28 digits before the point for single amounts and totals alike.
_EXACT = "decimal(38,10)"

# Means of up to this size are exact to the cent; beyond it a double has no cents.
_EXACT_MEAN = 9e15


def _or_fail(value: Column, what: str) -> Column:
    """A null that stands for too many digits ends the job, whether or not the session is in ANSI mode."""
    return F.coalesce(value, F.raise_error(F.lit(f"{what} of 1e28 or more")).cast(_EXACT))


def exact(amount: Column) -> Column:
    return F.when(amount.isNotNull(), _or_fail(amount.try_cast(_EXACT), "amount"))


def total(amount: Column, window: WindowSpec | None = None) -> Column:
    """The exact sum, over groups or a window; null only where there is nothing to add."""
    sums, rows = F.sum(exact(amount)), F.count(amount)
    if window is not None:
        sums, rows = sums.over(window), rows.over(window)
    return F.when(rows > 0, _or_fail(sums, "total"))


def as_amount(total: Column) -> Column:
    """An exact total at two decimals, as a double."""
    return F.round(total, 2).cast("double")


def mean_of(total: Column, rows: Column) -> Column:
    """total / rows, half up at two decimals, by whole-number division; null without rows."""
    size = F.abs(total).cast(_EXACT)
    whole = F.floor(size).cast("decimal(28,0)")
    each = F.call_function("div", whole, rows)
    left = (whole - each.cast("decimal(19,0)") * rows.cast("decimal(18,0)")).cast("decimal(19,0)")
    part = (left + (size - whole).cast("decimal(10,10)")).cast("decimal(30,10)")
    cents = each * 100 + F.call_function("div", part * 200 + rows, rows * 2)
    small = size.cast("double") < rows * F.lit(_EXACT_MEAN)
    mean = F.when(small, cents / F.lit(100.0)).otherwise(size.cast("double") / rows)
    return F.when(rows > 0, F.when(total < 0, -mean).otherwise(mean))
