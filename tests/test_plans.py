"""Physical plans: what must hold however large the tables grow."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flightloom.operators import incremental_window, flatten_flights, silver_flights, undated_flights
from flightloom.plans import marts, serving
from flightloom.plans.marts import fact_flights
from flightloom.session import shared_dir
from flightloom.sources import landing_audit, read_fact, read_flight_pages, write_mart
from flightloom.verification import derived
from flightloom.verification.derived import TIE_BREAK

SF_DIR = "/root/testdata/sf0.001"


def plan(df, executed=False):
    if executed:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def exchanges(text):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text)


@pytest.fixture(scope="module")
def flights(spark):
    return derived.flights(spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("k_") or n in ("fct_flights_cut",)))
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedup_is_limited_before_its_shuffle(flights):
    text = plan(silver_flights(flights, TIE_BREAK, rolling=False))
    assert text.count("WindowGroupLimit") == 2 and "row_number(), 1, Partial" in text
    assert exchanges(text) == ["hashpartitioning"]


def test_fact_shuffles_twice_and_without_unused_columns(flights):
    text = plan(fact_flights(flights, "2024-02-01", TIE_BREAK))
    assert exchanges(text) == ["hashpartitioning"] * 2
    assert "dep_airport" not in text and "dep_scheduled_ts" not in text


def test_unread_rolling_delay_costs_nothing(flights):
    text = plan(serving.flights_by_date(fact_flights(flights, "2024-02-01", TIE_BREAK, rolling=False)))
    assert "dep_delay" not in text and "6 preceding" not in text.lower()


def test_cut_groups_are_joined_where_they_already_lie(flights):
    """Large routes are worked on from a copy, without another scan of the source, and the carried values join rows that
    the window has already placed: each row is shuffled once for both."""
    text = plan(silver_flights(flights, TIE_BREAK, max_group_rows=50), executed=True)
    assert "events.parquet" not in text
    assert "SortMergeJoin" not in text and "BroadcastNestedLoopJoin" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(_group#\d+, _piece#\w+, 8\)", text)) == 2


def test_incremental_window_takes_its_last_date_from_the_directories(spark, flights, tmp_path):
    path = str(tmp_path / "fact")
    write_mart(fact_flights(flights.where("event_id % 2 = 0"), "2024-02-01", TIE_BREAK), path, ["flight_date"])
    text = plan(incremental_window(path, flights.where("event_id % 2 = 1"), TIE_BREAK))
    assert re.search(r"PartitionFilters: \[.*flight_date.*>=", text) and "max(flight_date" not in text


def test_marts_aggregate_before_they_shuffle(flights):
    fact = fact_flights(flights, "2024-02-01", TIE_BREAK, rolling=False)
    for build in (marts.route_daily, marts.delay_heatmap, marts.weekly_metrics):
        assert "partial_count" in plan(build(fact))


def test_top_k_never_sorts_everything(spark, flights, tmp_path):
    write_mart(marts.route_daily(fact_flights(flights, "2024-02-01", TIE_BREAK, rolling=False)), str(tmp_path / "r"))
    routes = read_fact(spark, str(tmp_path / "r"))
    for ask in (serving.top_routes_by_delay, serving.route_table, serving.most_delayed_route):
        assert "TakeOrderedAndProject" in plan(ask(routes))


def test_stored_fact_is_pruned(spark, flights, tmp_path):
    path = str(tmp_path / "fact")
    write_mart(fact_flights(flights, "2024-02-01", TIE_BREAK), path, ["flight_date"])
    fact = read_fact(spark, path)
    assert "ReadSchema: struct<>" in plan(serving.flights_by_date(fact))
    one_day = plan(serving.on_time_rate(fact.where("flight_date = date'2024-01-05'")))
    assert re.search(r"PartitionFilters: \[.*flight_date.*\]", one_day)
    assert "ReadSchema: struct<delay_category:string>" in one_day
    assert "IsNotNull(airline_iata)" in plan(serving.flights_by_airline(fact))


def test_each_page_is_parsed_once(spark):
    root = derived.land_pages(spark, SF_DIR, shared_dir(spark, "pages"))
    pages = read_flight_pages(spark, root)
    for df in (flatten_flights(pages), undated_flights(flatten_flights(pages)), landing_audit(pages)):
        assert plan(df).count("from_json(") == 1


def test_no_python_workers():
    """No query of the engine itself may leave the JVM, but for the state of the waiting stream, which Spark offers to Python as pandas only. The
    optional subpackage for training data has its own rules."""
    import pathlib

    source = "\n".join(p.read_text() for p in pathlib.Path("flightloom").rglob("*.py") if "llm" not in p.parts)
    assert source.count("applyInPandasWithState") == 1
    source = source.replace("applyInPandasWithState", "")
    for name in ("udf(", ".rdd", "toPandas", "mapInPandas", "applyInPandas", "crossJoin", "localCheckpoint"):
        assert name not in source
