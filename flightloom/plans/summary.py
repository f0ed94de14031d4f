"""One small table that answers most saved questions without the fact.

``day_summary`` holds sums and counts per flight date, once for all flights and once by each of five columns (grouping sets), so some tens of rows a
date however many flights there are. All of it is summable, so it follows the fact by touched dates, like the marts, and a question over any span
adds rows up. ``ask_summary`` takes the coarsest grouping that a question needs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ON_TIME_CATEGORIES, count_rows, count_where, is_weekend, rounded
from ..sources import read_dates, read_fact, write_mart

#: The column that each grouping goes by, besides the flight date. ``date`` goes by none.
GRAINS = {"date": None, "category": "delay_category", "time_of_day": "time_of_day", "airline": "airline_iata", "airport": "dep_iata", "hour": "dep_hour"}
_COLUMNS = [c for c in GRAINS.values() if c]


def day_summary(fact: DataFrame) -> DataFrame:
    """Grouping sets over the fact: one scan, pre-aggregated before the shuffle. ``grain`` names the set a row belongs to."""
    sets = [["flight_date", c] if c else ["flight_date"] for c in GRAINS.values()]
    dep, category = F.col("dep_delay_min"), F.col("delay_category")
    # Categories are counted from a copy: in a set that does not group by it, the grouped column itself is null.
    narrow = fact.select("flight_date", *_COLUMNS, dep, "is_delayed_15", category.alias("_category"))
    grouped = narrow.groupingSets(sets, "flight_date", *_COLUMNS).agg(
        *[F.grouping(c).alias(f"_without_{c}") for c in _COLUMNS],
        count_rows().alias("flights"),
        F.sum(dep).alias("dep_delay"),
        F.count(dep).alias("dep_known"),
        count_where(F.col("is_delayed_15")).alias("late"),
        count_where(F.col("_category").isin(*ON_TIME_CATEGORIES)).alias("ontime"),
        count_where(F.col("_category") == "severe_delay").alias("severe"),
    )
    grain = F.coalesce(*[F.when(F.col(f"_without_{c}") == 0, F.lit(name)) for name, c in GRAINS.items() if c], F.lit("date"))
    return grouped.withColumn("grain", grain).drop(*[f"_without_{c}" for c in _COLUMNS])


def keep_summary(spark: SparkSession, fact_path: str, summary_path: str, touched: Sequence[date] | None = None) -> None:
    """Bring the stored summary up to date with the fact, for the dates an upsert touched or for all."""
    changed = read_fact(spark, fact_path) if touched is None else read_dates(spark, fact_path, touched)
    if changed is not None:
        write_mart(day_summary(changed), summary_path, ["flight_date"], only_touched=touched is not None)


def _mean_delay(digits: int) -> Column:
    return rounded(F.try_divide(F.sum("dep_delay").cast("double"), F.sum("dep_known")), digits)


def _share(part: str, digits: int) -> Column:
    return rounded(F.try_divide(F.sum(part).cast("double") * 100.0, F.sum("flights")), digits)


def _weekend(rows: DataFrame) -> DataFrame:
    day_type = F.when(is_weekend(F.col("flight_date")), "Weekend").otherwise("Weekday").alias("day_type")
    return rows.groupBy(day_type).agg(F.sum("flights").alias("total_flights"), _mean_delay(2).alias("avg_delay_min"), _share("late", 2).alias("delayed_pct"))


def _time_of_day(rows: DataFrame) -> DataFrame:
    day_order = F.array_position(F.array(*map(F.lit, ("Morning", "Afternoon", "Evening", "Night"))), F.col("time_of_day"))
    known = rows.where("dep_known > 0").groupBy("time_of_day").agg(_mean_delay(2).alias("avg_delay_min"))
    return known.orderBy(day_order)


def _total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.coalesce(F.sum("flights"), F.lit(0)).alias("total"))


def _counts(column: str, name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.groupBy(column).agg(F.sum("flights").alias(name))


#: Question → (grain, answer from that grain's rows). The names the answers are shown under.
ANSWERS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "k_flights_by_date": ("date", lambda r: r.select("flight_date", F.col("flights").alias("total_flights")).orderBy(F.asc_nulls_last("flight_date"))),
    "k_delay_category": ("category", lambda r: _counts("delay_category", "count")(r).orderBy(F.desc("count"), "delay_category")),
    "k_time_of_day": ("time_of_day", _time_of_day),
    "k_airlines": (
        "airline",
        lambda r: _counts("airline_iata", "total_flights")(r.where("airline_iata is not null")).orderBy(F.desc("total_flights"), "airline_iata").limit(15),
    ),
    "k_weekend": ("date", _weekend),
    "k_total": ("date", _total),
    "k_ontime": ("date", lambda r: r.agg(_share("ontime", 1).alias("ontime_pct"))),
    "k_avg_delay": ("date", lambda r: r.agg(_mean_delay(1).alias("avg_delay"))),
    "k_hours": (
        "hour",
        lambda r: r.where("dep_hour is not null").groupBy(F.col("dep_hour").cast("int").alias("hour")).agg(F.sum("flights").alias("flights")).orderBy("hour"),
    ),
    "k_airports": ("airport", lambda r: _counts("dep_iata", "flights")(r).orderBy(F.desc("flights"), F.asc_nulls_last("dep_iata")).limit(10)),
    "k_severe": ("date", lambda r: r.agg(_share("severe", 1).alias("severe_pct"))),
    "k_category_trend": (
        "category",
        lambda r: r.select("flight_date", "delay_category", F.col("flights").alias("count")).orderBy(F.asc_nulls_last("flight_date"), "delay_category"),
    ),
}


def ask_summary(summary: DataFrame, question: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Answer a saved question from the summary; with ``first`` and ``last``, over these flight dates only, which prunes the others."""
    grain, answer = ANSWERS[question]
    rows = summary.where(F.col("grain") == grain)
    if first:
        rows = rows.where(F.col("flight_date") >= F.lit(first))
    if last:
        rows = rows.where(F.col("flight_date") <= F.lit(last))
    return answer(rows)
