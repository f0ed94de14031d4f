"""Aggregate expressions. Each is a partial (map-side) aggregate in Spark, so hot groups are combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero on the binary value.

    ``F.round`` on a double rounds its shortest decimal text instead, and the two differ on ties such as 1.005, which means
    over 40 or 200 rows do produce.
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * scale, 0) / scale


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """Rows that satisfy the condition; an unknown condition does not count."""
    return F.count_if(condition)


def rate_pct(condition: Column) -> Column:
    """Share of rows that satisfy the condition, in percent of *all* rows in the group, as a double; null when
    there are none."""
    return F.try_divide(F.count_if(condition).cast("double") * 100.0, count_rows())


def mean(value: Column, digits: int) -> Column:
    """Rounded mean of the known values."""
    return rounded(F.avg(value), digits)
