"""Boundary values of the per-flight measures and the aggregate expressions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flightloom.functions import (
    category_agrees,
    day_number,
    day_title,
    delay_category,
    is_delayed,
    is_weekend,
    mean,
    minutes_between,
    rate_pct,
    rounded,
    surrogate_key,
    time_of_day,
    week_start,
)
from flightloom.operators import kpi_flights, stage_flights
from flightloom.operators.flatten import whole_minutes


def values(spark, kind, inputs, expression):
    """The expression's value for each input, in input order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_time_of_day(spark):
    hours = [4, 5, 11, 12, 16, 17, 21, 22, None]
    assert values(spark, "int", hours, time_of_day) == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night",
    ]


def test_delay_category(spark):
    delays = [-16, -15, -14, 0, 1, 15, 16, 45, 46, None]
    assert values(spark, "int", delays, delay_category) == [
        "early", "early", "ontime", "ontime", "minor_delay", "minor_delay", "moderate_delay", "moderate_delay",
        "severe_delay", "unknown",
    ]
    assert values(spark, "int", delays, is_delayed) == [False] * 6 + [True] * 3 + [False]


def test_calendar(spark):
    days = [date(2024, 1, 7), date(2024, 1, 8), date(2024, 1, 13), None]
    assert values(spark, "date", days, day_number) == [0, 1, 6, None]
    assert values(spark, "date", days, day_title) == ["Sunday", "Monday", "Saturday", None]
    assert values(spark, "date", days, is_weekend) == [True, False, True, False]
    assert values(spark, "date", days, week_start) == [date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 8), None]


@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ((10, 0, 59), (10, 1, 0), 1),
        ((10, 0, 0), (10, 0, 59), 0),
        ((10, 1, 0), (10, 0, 59), -1),
        ((10, 0, 30), (12, 0, 29), 120),
    ],
)
def test_minutes_between_counts_boundaries(spark, start, end, minutes):
    pair = [(datetime(2024, 1, 1, *start), datetime(2024, 1, 1, *end))]
    rows = spark.createDataFrame(pair, "a timestamp_ntz, b timestamp_ntz")
    assert rows.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == minutes


def test_rounding_is_on_the_binary_value(spark):
    numbers = [1.005, 2.675, 0.125, -0.125, 66.665, 12.025, None]
    assert values(spark, "double", numbers, lambda v: rounded(v, 2)) == [1.0, 2.68, 0.13, -0.13, 66.67, 12.03, None]


def test_rates_of_nothing_are_null(spark):
    empty = spark.createDataFrame([], "v int")
    row = empty.agg(rate_pct(F.col("v") > 0), mean(F.col("v"), 1)).first()
    assert tuple(row) == (None, None)


def test_rate_counts_unknown_rows_in_the_whole(spark):
    rows = spark.createDataFrame([(1,), (None,), (0,), (1,)], "v int")
    assert rows.agg(rate_pct(F.col("v") > 0)).first()[0] == 50.0


def test_surrogate_key(spark):
    rows = spark.createDataFrame([("AA1", date(2024, 1, 1)), (None, date(2024, 1, 1))], "f string, d date")
    keys = [r[0] for r in rows.select(surrogate_key(F.col("f"), F.col("d"))).collect()]
    # md5 of 'AA1-2024-01-01' and of '_dbt_utils_surrogate_key_null_-2024-01-01'
    import hashlib

    assert keys == [
        hashlib.md5(text.encode()).hexdigest()
        for text in ("AA1-2024-01-01", "_dbt_utils_surrogate_key_null_-2024-01-01")
    ]


def test_whole_minutes(spark):
    texts = ["13", "13.0", "7.9", "-7.9", "n/a", "", None]
    assert values(spark, "string", texts, whole_minutes) == [13, 13, 7, -7, None, None, None]


def test_category_agreement(spark):
    pairs = [
        (None, "ontime"), (None, "severe_delay"), (None, "bogus"), (50, "ontime"), (None, "unknown"), (46, "severe_delay"),
        (45, "severe_delay"), (45, "moderate_delay"), (15, "minor_delay"), (0, "ontime"), (-15, "early"), (-15, "ontime"),
    ]
    rows = spark.createDataFrame(pairs, "d int, c string")

    def failing(strict):
        return {tuple(r) for r in rows.where(~category_agrees(F.col("d"), F.col("c"), strict)).collect()}

    wrong = {(None, "bogus"), (50, "ontime"), (45, "severe_delay"), (-15, "ontime")}
    assert failing(strict=False) == wrong
    assert failing(strict=True) == wrong | {(None, "ontime"), (None, "severe_delay")}


def test_kpis_of_a_known_flight(spark):
    flight = spark.createDataFrame(
        [("2024-03-05", "2024-03-05T18:20:00+00:00", "2024-03-05T20:15:00+00:00", None, 31)],
        "flight_date string, dep_scheduled string, arr_scheduled string, missing string, dep_delay_min int",
    )
    others = [
        "flight_status", "dep_airport", "dep_iata", "dep_actual", "arr_airport", "arr_iata", "arr_actual", "airline_iata",
        "flight_number", "arr_delay_min", "dep_scheduled_ts", "arr_scheduled_ts", "ingestion_date",
    ]
    bronze = flight.withColumns({c: F.col("missing") for c in others})
    row = kpi_flights(stage_flights(bronze)).first()
    assert (row.day_of_week, row.day_of_week_name, row.is_weekend) == (2, "Tuesday", False)
    assert (row.dep_hour, row.time_of_day) == (18, "Evening")
    assert (row.scheduled_duration_min, row.actual_duration_min, row.duration_diff_min) == (115, None, None)
    assert (row.delay_category, row.is_delayed_15, row.avg_delay) == ("moderate_delay", True, 31)
