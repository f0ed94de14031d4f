"""Reusable column expressions. All are built-in Spark functions, so they stay inside whole-stage codegen."""

from .calendar import day_number, day_title, is_weekend, minutes_between, week_start
from .delays import (
    DELAYED_CATEGORIES,
    ON_TIME_CATEGORIES,
    category_agrees,
    delay_category,
    is_delayed,
    time_of_day,
)
from .keys import row_hash, surrogate_key
from .measures import count_rows, count_where, mean, rate_pct, rounded

__all__ = [
    "DELAYED_CATEGORIES",
    "ON_TIME_CATEGORIES",
    "category_agrees",
    "count_rows",
    "count_where",
    "day_number",
    "day_title",
    "delay_category",
    "is_delayed",
    "is_weekend",
    "mean",
    "minutes_between",
    "rate_pct",
    "rounded",
    "row_hash",
    "surrogate_key",
    "time_of_day",
    "week_start",
]
