"""Per-flight measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    day_number,
    day_title,
    delay_category,
    is_delayed,
    is_weekend,
    minutes_between,
    time_of_day,
)


def kpi_flights(flights: DataFrame) -> DataFrame:
    """Add the calendar, duration and delay measures. Row by row: no shuffle, and unused columns are pruned."""
    date, delay = F.col("flight_date"), F.col("dep_delay_min")
    hour = F.hour("dep_scheduled")
    planned = minutes_between(F.col("dep_scheduled"), F.col("arr_scheduled"))
    flown = minutes_between(F.col("dep_actual"), F.col("arr_actual"))
    return flights.select(
        "*",
        day_number(date).alias("day_of_week"),
        day_title(date).alias("day_of_week_name"),
        is_weekend(date).alias("is_weekend"),
        hour.cast("bigint").alias("dep_hour"),
        time_of_day(hour).alias("time_of_day"),
        planned.alias("scheduled_duration_min"),
        flown.alias("actual_duration_min"),
        (flown - planned).alias("duration_diff_min"),
        delay_category(delay).alias("delay_category"),
        is_delayed(delay).alias("is_delayed_15"),
        delay.alias("avg_delay"),
    )
