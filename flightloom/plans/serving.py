"""The saved questions. Each takes the table it reads (F = fact, R = route_daily, H = delay_heatmap, W = weekly_comparison) and
returns the answer in the order it is shown. Fixed values: the column names are the ones the answers have always been shown
under.

Every ``limit`` is part of its question; the group key breaks ties, so the answer does not change between runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ON_TIME_CATEGORIES, count_rows, mean, rate_pct, rounded


def _exact_mean(hundredths: Column) -> Column:
    """Mean of a column that holds two decimals, summed in whole hundredths so that the order of rows cannot matter."""
    total = F.sum(F.round(hundredths * 100.0, 0).cast("bigint")).cast("double")
    return F.try_divide(total, F.count(hundredths)) / 100.0


def flights_by_date(fact: DataFrame) -> DataFrame:
    return fact.groupBy("flight_date").agg(count_rows().alias("total_flights")).orderBy(F.asc_nulls_last("flight_date"))


def delay_category_distribution(fact: DataFrame) -> DataFrame:
    return fact.groupBy("delay_category").agg(count_rows().alias("count")).orderBy(F.desc("count"), "delay_category")


def delay_by_time_of_day(fact: DataFrame) -> DataFrame:
    day_order = F.array_position(F.array(*map(F.lit, ("Morning", "Afternoon", "Evening", "Night"))), F.col("time_of_day"))
    return (
        fact.where(F.col("dep_delay_min").isNotNull())
        .groupBy("time_of_day")
        .agg(mean(F.col("dep_delay_min"), 2).alias("avg_delay_min"))
        .orderBy(day_order)
    )


def top_routes_by_delay(routes: DataFrame) -> DataFrame:
    return (
        routes.groupBy("route")
        .agg(
            rounded(_exact_mean(F.col("delayed_pct")), 2).alias("avg_delayed_pct"),
            F.sum("total_flights").alias("total_flights"),
        )
        .where(F.col("total_flights") >= 5)
        .orderBy(F.desc("avg_delayed_pct"), F.asc_nulls_last("route"))
        .limit(10)
    )


def flights_by_airline(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("airline_iata").isNotNull())
        .groupBy("airline_iata")
        .agg(count_rows().alias("total_flights"))
        .orderBy(F.desc("total_flights"), "airline_iata")
        .limit(15)
    )


def daily_delay_trend(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("dep_delay_min").isNotNull())
        .groupBy("flight_date")
        .agg(
            mean(F.col("dep_delay_min"), 2).alias("avg_delay_min"),
            mean(F.col("avg_delay_7d"), 2).alias("rolling_avg_7d"),
        )
        .orderBy(F.asc_nulls_last("flight_date"))
    )


def weekend_vs_weekday(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("is_weekend")
        .agg(
            count_rows().alias("total_flights"),
            mean(F.col("dep_delay_min"), 2).alias("avg_delay_min"),
            rounded(rate_pct(F.col("is_delayed_15")), 2).alias("delayed_pct"),
        )
        .select(
            F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
            "total_flights",
            "avg_delay_min",
            "delayed_pct",
        )
    )


def total_flights(fact: DataFrame) -> DataFrame:
    return fact.agg(count_rows().alias("total"))


def on_time_rate(fact: DataFrame) -> DataFrame:
    on_time = F.col("delay_category").isin(*ON_TIME_CATEGORIES)
    return fact.agg(rounded(rate_pct(on_time), 1).alias("ontime_pct"))


def average_delay(fact: DataFrame) -> DataFrame:
    return fact.agg(mean(F.col("dep_delay_min"), 1).alias("avg_delay"))


def flights_by_hour(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("dep_hour").isNotNull())
        .groupBy(F.col("dep_hour").cast("int").alias("hour"))
        .agg(count_rows().alias("flights"))
        .orderBy("hour")
    )


def top_departure_airports(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("dep_iata")
        .agg(count_rows().alias("flights"))
        .orderBy(F.desc("flights"), F.asc_nulls_last("dep_iata"))
        .limit(10)
    )


def severe_delay_rate(fact: DataFrame) -> DataFrame:
    return fact.agg(rounded(rate_pct(F.col("delay_category") == "severe_delay"), 1).alias("severe_pct"))


def heatmap(cells: DataFrame) -> DataFrame:
    return cells.orderBy("day_of_week", "dep_hour").select(
        F.col("day_of_week_name").alias("Day"),
        F.col("dep_hour").alias("Hour"),
        F.col("avg_delay_min").alias("Avg Delay (min)"),
        F.col("total_flights").alias("Flights"),
        F.col("delayed_pct").alias("Delayed %"),
    )


def heatmap_pivot(cells: DataFrame) -> DataFrame:
    """The same cells as a grid: a row per day, a column per hour, the mean delay inside. Naming the 24 hours saves the job
    that would look them up."""
    return (
        cells.groupBy("day_of_week", F.col("day_of_week_name").alias("Day"))
        .pivot("dep_hour", list(range(24)))
        .agg(F.first("avg_delay_min"))
        .orderBy("day_of_week")
        .drop("day_of_week")
    )


def category_trend(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("flight_date", "delay_category")
        .agg(count_rows().alias("count"))
        .orderBy(F.asc_nulls_last("flight_date"), "delay_category")
    )


def route_table(routes: DataFrame) -> DataFrame:
    delayed = _exact_mean(F.col("delayed_pct"))
    return (
        routes.groupBy(F.col("route").alias("Route"))
        .agg(
            F.sum("total_flights").alias("Total Flights"),
            rounded(_exact_mean(F.col("avg_dep_delay_min")), 1).alias("Avg Delay (min)"),
            rounded(F.lit(100.0) - delayed, 1).alias("On-Time %"),
            rounded(delayed, 1).alias("Delayed %"),
        )
        .where(F.col("Total Flights") >= 3)
        .orderBy(F.desc("Total Flights"), F.asc_nulls_last("Route"))
        .limit(15)
    )


def weekly_trend(weeks: DataFrame) -> DataFrame:
    return weeks.orderBy("week_start").select(
        F.col("week_start").alias("Week"),
        F.col("total_flights").alias("Flights"),
        F.col("avg_delay_min").alias("Avg Delay"),
        F.col("ontime_pct").alias("On-Time %"),
    )


def most_delayed_route(routes: DataFrame) -> DataFrame:
    return (
        routes.groupBy("route")
        .agg(F.sum("total_flights").alias("flights"), rounded(_exact_mean(F.col("delayed_pct")), 6).alias("delayed"))
        .where(F.col("flights") >= 3)
        .orderBy(F.desc("delayed"), F.asc_nulls_last("route"))
        .limit(1)
        .select("route")
    )


# Question name → (table it reads, function).
QUESTIONS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "k_flights_by_date": ("fact", flights_by_date),
    "k_delay_category": ("fact", delay_category_distribution),
    "k_time_of_day": ("fact", delay_by_time_of_day),
    "k_top_routes": ("route_daily", top_routes_by_delay),
    "k_airlines": ("fact", flights_by_airline),
    "k_daily_trend": ("fact", daily_delay_trend),
    "k_weekend": ("fact", weekend_vs_weekday),
    "k_total": ("fact", total_flights),
    "k_ontime": ("fact", on_time_rate),
    "k_avg_delay": ("fact", average_delay),
    "k_hours": ("fact", flights_by_hour),
    "k_airports": ("fact", top_departure_airports),
    "k_severe": ("fact", severe_delay_rate),
    "k_heatmap": ("delay_heatmap", heatmap),
    "k_heatmap_pivot": ("delay_heatmap", heatmap_pivot),
    "k_category_trend": ("fact", category_trend),
    "k_route_table": ("route_daily", route_table),
    "k_weekly": ("weekly_comparison", weekly_trend),
    "k_worst_route": ("route_daily", most_delayed_route),
}
