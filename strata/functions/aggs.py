"""Aggregate expressions shared by the feature groups and reports.

Money is summed exactly: each amount is cast to a fixed-point decimal (``SCALE``
digits after the point) before the sum, so the result does not depend on the order in which partial sums are merged
(a double sum does, across partitionings and engines). Means divide that exact
sum by the count of non-null amounts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits after the point that are summed exactly; amounts below 1e28 fit beside them.
SCALE = 10


def money_sum(c: str | Column, scale: int = SCALE) -> Column:
    """Exact sum of amounts with up to ``scale`` digits after the point. A group with an amount that does
    not fit (1e28 and above, or not a number) is summed as doubles instead; nothing is dropped."""
    c = F.col(c) if isinstance(c, str) else c
    exact = c.cast("double").cast("string").try_cast(f"decimal(38,{scale})")
    return F.when(F.count(exact) == F.count(c), F.try_sum(exact).cast("double")).otherwise(F.sum(c.cast("double")))


def money_avg(c: str | Column, scale: int = SCALE) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_divide(money_sum(c, scale), F.count(c))


def std_samp(c: str | Column) -> Column:
    """Sample standard deviation (null for one row)."""
    return F.stddev_samp(c)


def any_flag(pred: Column) -> Column:
    """1 when any row of the group satisfies ``pred``, else 0."""
    return F.max(F.when(pred, 1).otherwise(0))


def count_where(pred: Column) -> Column:
    return F.sum(F.when(pred, 1).otherwise(0))


def present() -> Column:
    """Constant 1 for every group: the customer has at least one row."""
    return F.lit(1)
