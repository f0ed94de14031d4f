"""Delay classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category names with their limits in minutes, day parts with their first and last hour.
SEVERE_OVER = 45
MODERATE_OVER = 15
MINOR_OVER = 0
EARLY_AT_MOST = -15
ON_TIME_CATEGORIES = ("ontime", "early")
DELAYED_CATEGORIES = ("moderate_delay", "severe_delay")
DAY_PARTS = (("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 21))
OTHER_DAY_PART = "Night"


def delay_category(delay: Column) -> Column:
    """Band of a delay. Every delay falls into exactly one band, so the tests run from the earliest band upwards."""
    return (
        F.when(delay.isNull(), F.lit("unknown"))
        .when(delay <= EARLY_AT_MOST, F.lit("early"))
        .when(delay <= MINOR_OVER, F.lit("ontime"))
        .when(delay <= MODERATE_OVER, F.lit("minor_delay"))
        .when(delay <= SEVERE_OVER, F.lit("moderate_delay"))
        .otherwise(F.lit("severe_delay"))
    )


def time_of_day(hour: Column) -> Column:
    """Day part of an hour; an unknown hour counts as night."""
    part = F.lit(OTHER_DAY_PART)
    for name, first, last in DAY_PARTS:
        part = F.when(hour.between(first, last), F.lit(name)).otherwise(part)
    return part


def is_delayed(delay: Column) -> Column:
    """More than a quarter of an hour late; an unknown delay is not late."""
    return F.coalesce(delay > MODERATE_OVER, F.lit(False))


def category_agrees(delay: Column, category: Column, strict: bool = False) -> Column:
    """Whether a stored category fits its delay.

    The default follows SQL's three-valued logic: on an unknown delay a *known* category name makes the answer null, and a
    filter for disagreement does not keep the row. ``strict`` compares null-safely and so finds those rows too.
    """
    if strict:
        return category.eqNullSafe(delay_category(delay))
    bands = {
        "severe_delay": delay > SEVERE_OVER,
        "moderate_delay": (delay > MODERATE_OVER) & (delay <= SEVERE_OVER),
        "minor_delay": (delay > MINOR_OVER) & (delay <= MODERATE_OVER),
        "ontime": (delay > EARLY_AT_MOST) & (delay <= MINOR_OVER),
        "early": delay <= EARLY_AT_MOST,
    }
    agrees = delay.isNull() & (category == "unknown")
    for name, in_band in bands.items():
        agrees = agrees | (in_band & (category == name))
    return agrees
