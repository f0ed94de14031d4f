"""The fact table and the three aggregate marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    DELAYED_CATEGORIES,
    ON_TIME_CATEGORIES,
    count_rows,
    count_where,
    day_number,
    day_title,
    mean,
    rate_pct,
    rounded,
    surrogate_key,
    week_start,
)
from ..operators.kpis import kpi_flights
from ..operators.silver import FLIGHT, MAX_GROUP_ROWS, silver_flights
from ..schemas import FACT_COLUMNS

ROUTE_DAILY_COLUMNS = (
    "flight_date", "route", "dep_iata", "arr_iata", "airline_iata", "total_flights", "avg_dep_delay_min", "delayed_pct",
)


def fact_flights(
    staged: DataFrame,
    run_date: str | Column,
    order_by: Sequence[str] | None = None,
    batch: str | None = None,
    rolling: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Staged flights → fact rows, stamped with the run date.

    The measures are added after dedup. They depend on their own row only, so the result is the same and the shuffles carry
    eleven columns less.
    """
    silver = silver_flights(staged, order_by, batch, rolling, max_group_rows)
    stamp = F.lit(run_date) if isinstance(run_date, str) else run_date
    keyed = kpi_flights(silver).withColumns(
        {"flight_key": surrogate_key(*[F.col(c) for c in FLIGHT]), "insert_date_ci": stamp.cast("date")}
    )
    return keyed.select(*[c for c in FACT_COLUMNS if rolling or c != "avg_delay_7d"])


def route_daily(fact: DataFrame) -> DataFrame:
    """Delay per date, route and airline.

    The route name follows from the two airports, so it is added after grouping and does not widen the key.
    """
    delayed = F.col("delay_category").isin(*DELAYED_CATEGORIES)
    return (
        fact.groupBy("flight_date", "dep_iata", "arr_iata", "airline_iata")
        .agg(
            count_rows().alias("total_flights"),
            mean(F.col("dep_delay_min"), 2).alias("avg_dep_delay_min"),
            rounded(rate_pct(delayed), 2).alias("delayed_pct"),
        )
        .withColumn("route", F.concat("dep_iata", F.lit("-"), "arr_iata"))
        .select(*ROUTE_DAILY_COLUMNS)
    )


def day_hours(fact: DataFrame) -> DataFrame:
    """Summable measures per date and departure hour: at most 25 rows a date.

    Both marts below add these up, so a stored copy lets them follow the fact by recomputing only the dates that changed.
    """
    dep, arr, category = F.col("dep_delay_min"), F.col("arr_delay_min"), F.col("delay_category")
    return fact.groupBy("flight_date", "dep_hour").agg(
        count_rows().alias("flights"),
        F.sum(dep).alias("dep_delay"),
        F.count(dep).alias("dep_known"),
        F.sum(arr).alias("arr_delay"),
        F.count(arr).alias("arr_known"),
        count_where(F.col("is_delayed_15")).alias("late"),
        count_where(category.isin(*ON_TIME_CATEGORIES)).alias("ontime"),
        count_where(category == "severe_delay").alias("severe"),
    )


def _mean_of(total: str, known: str) -> Column:
    return rounded(F.try_divide(F.sum(total).cast("double"), F.sum(known)), 2)


def _share_of(part: str) -> Column:
    return rounded(F.sum(part).cast("double") * 100.0 / F.sum("flights"), 2)


def heatmap_of_day_hours(hours: DataFrame) -> DataFrame:
    date = F.col("flight_date")
    return (
        hours.where(F.col("dep_hour").isNotNull())
        .groupBy(day_number(date).alias("day_of_week"), day_title(date).alias("day_of_week_name"), "dep_hour")
        .agg(
            F.sum("flights").alias("total_flights"),
            _mean_of("dep_delay", "dep_known").alias("avg_delay_min"),
            _mean_of("arr_delay", "arr_known").alias("avg_arr_delay_min"),
            F.sum("late").alias("delayed_flights"),
            _share_of("late").alias("delayed_pct"),
        )
    )


def weeks_of_day_hours(hours: DataFrame) -> DataFrame:
    return hours.groupBy(week_start(F.col("flight_date")).alias("week_start")).agg(
        F.sum("flights").alias("total_flights"),
        _mean_of("dep_delay", "dep_known").alias("avg_delay_min"),
        _mean_of("arr_delay", "arr_known").alias("avg_arr_delay_min"),
        F.sum("ontime").alias("ontime_flights"),
        F.sum("severe").alias("severe_delay_flights"),
        _share_of("ontime").alias("ontime_pct"),
        _share_of("severe").alias("severe_pct"),
    )


def delay_heatmap(fact: DataFrame) -> DataFrame:
    """Delay per weekday and departure hour, for flights whose hour is known."""
    return heatmap_of_day_hours(day_hours(fact))


def weekly_metrics(fact: DataFrame) -> DataFrame:
    """Volume, delay and punctuality per week."""
    return weeks_of_day_hours(day_hours(fact))


def compare_weeks(weeks: DataFrame) -> DataFrame:
    """Each week beside the one before it. The first week's changes are its own values.

    The window has no partition key, but it runs on aggregated rows: one per week of data.
    """
    previous = Window.orderBy(F.col("week_start").asc_nulls_last())
    compared = {
        "total_flights": ("prev_week_flights", "flights_change", 0),
        "avg_delay_min": ("prev_week_avg_delay", "delay_change", 2),
        "ontime_pct": ("prev_week_ontime_pct", "ontime_pct_change", 2),
        "severe_pct": ("prev_week_severe_pct", "severe_pct_change", 2),
    }
    before = {prev: F.lag(name).over(previous) for name, (prev, _, _) in compared.items()}
    changes = {}
    for name, (prev, change, digits) in compared.items():
        difference = F.col(name) - F.coalesce(F.col(prev), F.lit(0))
        changes[change] = rounded(difference, digits) if digits else difference
    return weeks.drop("ontime_flights", "severe_delay_flights").withColumns(before).withColumns(changes)


def weekly_comparison(fact: DataFrame) -> DataFrame:
    return compare_weeks(weekly_metrics(fact))
