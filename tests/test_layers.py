"""The summary, the named views, checks in one pass, the cast audit and the layout of the fact's files."""

import re
import uuid
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flightloom.operators import cast_failures, category_mismatches, check_fact, duplicate_keys, flatten_flights, upsert_fact
from flightloom.plans.daily import Layout, run_batches
from flightloom.plans.marts import fact_flights
from flightloom.plans.serving import QUESTIONS
from flightloom.plans.summary import ANSWERS, ask_summary, day_summary, keep_summary
from flightloom.plans.views import register_views
from flightloom.sources import read_fact, read_flight_pages, write_mart
from tests.test_landing import FULL, flight, land, page
from tests.test_silver import SCHEMA, make_flights


def rows(frame):
    return sorted(str(r.asDict()) for r in frame.select(*sorted(frame.columns)).collect())


@pytest.fixture(scope="module")
def fact(spark):
    flights = spark.createDataFrame(make_flights(31, n=300), SCHEMA)
    return fact_flights(flights, "2024-02-01", ["event_id"]).cache()


@pytest.mark.parametrize("question", sorted(ANSWERS))
def test_summary_answers_like_the_fact(spark, fact, question):
    table, ask = QUESTIONS[question]
    assert table == "fact"
    for part in (fact, fact.where("flight_date > '2024-01-02'"), fact.limit(0)):
        want, got = ask(part), ask_summary(day_summary(part), question)
        assert (got.columns, rows(got)) == (want.columns, rows(want))
    first = date(2024, 1, 2)
    assert rows(ask_summary(day_summary(fact), question, first, first)) == rows(ask(fact.where(F.col("flight_date") == first)))


def test_summary_is_small_and_read_alone(spark, fact, tmp_path):
    stored, kept = str(tmp_path / "fact"), str(tmp_path / "summary")
    _, touched = upsert_fact(spark, stored, fact)
    keep_summary(spark, stored, kept, touched)
    answer = ask_summary(read_fact(spark, kept), "k_hours", date(2024, 1, 2), date(2024, 1, 3))
    assert all("/summary/" in f for f in answer.inputFiles())
    assert re.search(r"PartitionFilters: \[.*flight_date.*>=", answer._jdf.queryExecution().executedPlan().toString())
    plan = day_summary(read_fact(spark, stored))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("FileScan") == 1


def test_one_pass_checks_equal_the_single_ones(spark, fact, tmp_path):
    wrong = F.when(F.col("dep_delay_min") % 3 == 0, "bogus").when(F.coalesce("dep_delay_min", F.lit(1)) % 3 == 1, "ontime").otherwise(F.col("delay_category"))
    broken = fact.withColumn("delay_category", wrong).unionByName(fact.where("dep_delay_min > 20"))
    for strict in (False, True):
        found = {r.name: r for r in check_fact(broken, str(tmp_path / str(strict)), strict)}
        assert found["delay_category"].failures == category_mismatches(broken, strict).count() > 0
        assert found["unique_flight_key"].failures == duplicate_keys(broken).count() > 0
        kept = spark.read.parquet(found["delay_category"].stored_at).select("row.*")
        assert rows(kept) == rows(category_mismatches(broken, strict))
        repeated = spark.read.parquet(found["unique_flight_key"].stored_at).select(F.col("key").alias("flight_key"), "occurrences")
        assert rows(repeated) == rows(duplicate_keys(broken))
    clean = check_fact(fact.limit(0), str(tmp_path / "clean"))
    assert [(r.status, r.failures) for r in clean] == [("pass", 0)] * 2
    broken.write.parquet(str(tmp_path / "broken"))
    by_key = spark.read.parquet(str(tmp_path / "broken")).groupBy("flight_key").agg(F.count("*"), F.collect_list(F.when(F.col("dep_hour") > 90, F.struct("*"))))
    assert by_key._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_cells_that_cannot_be_read_are_named(spark, tmp_path):
    late = {**FULL["departure"], "delay": "n/a", "actual": "soon"}
    good = flight(arrival={**FULL["arrival"], "delay": 13.0})
    land(tmp_path / "raw", "2024-01-01", page(FULL, good, flight(departure=late), flight(flight_date="2024-13-40"), flight(flight_date=None, departure=None)))
    bronze = flatten_flights(read_flight_pages(spark, str(tmp_path / "raw")), audit=True)
    assert sorted(map(tuple, bronze.select("failed_casts").where("size(failed_casts) > 0").collect())) == [(["dep_actual", "dep_delay_min"],), (["flight_date"],)]
    assert sorted(r["column"] for r in cast_failures(bronze).collect()) == ["dep_actual", "dep_delay_min", "flight_date"]
    layout = Layout.under(str(tmp_path))
    report = run_batches(spark, layout, ["2024-01-01"])
    assert report.cast_failures == 3
    assert spark.read.parquet(f"{layout.metadata}/cast_failures").count() == 3


def test_views_are_asked_by_name_and_prune(spark, tmp_path):
    database = f"flights_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    layout = Layout.under(str(tmp_path))
    for n in (1, 2, 3):
        land(tmp_path / "raw", f"2024-01-0{n}", page(FULL, flight(flight_date=f"2024-01-0{n}"), flight(flight_date=None)))
    run_batches(spark, layout, ["2024-01-01", "2024-01-02", "2024-01-03"])
    spark.createDataFrame([("Boeing", "B7", "B777"), ("Airbus", None, "A320")], "name string, iata_code string, icao_code string").write.parquet(str(tmp_path / "ref" / "planes.parquet"))
    names = register_views(spark, layout, str(tmp_path / "ref"), database)
    assert {"stg_lnd_flights", "stg_fct_flights", "stg_lnd_planes", "int_flights_kpis", "int_flights", "int_avg_flight_delays", "int_weekly_comparison"} == set(names)
    one = spark.sql(f"SELECT * FROM {database}.stg_lnd_flights WHERE insert_date = DATE'2024-01-02'")
    assert one.count() == 2 and len(one.columns) == 19
    text = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*insert_date", text)
    narrow = spark.sql(f"SELECT dep_iata FROM {database}.stg_lnd_flights")._jdf.queryExecution().executedPlan().toString()
    assert "arr_iata" not in narrow.split("ReadSchema")[1]
    assert [tuple(r) for r in spark.sql(f"SELECT aircraft_name, icao_code FROM {database}.stg_lnd_planes ORDER BY 1").collect()] == [("Airbus", "A320"), ("Boeing", "B777")]
    assert spark.sql("SELECT sum(total_flights) FROM int_avg_flight_delays").first()[0] == read_fact(spark, layout.fact).count()
    assert spark.sql("SELECT count(DISTINCT flight_key) FROM int_flights").first()[0] == spark.sql(f"SELECT count(*) FROM {database}.stg_fct_flights").first()[0]
    # Views hold no rows: a new date is seen at once.
    land(tmp_path / "raw", "2024-01-04", page(FULL))
    run_batches(spark, layout, ["2024-01-04"])
    assert spark.sql(f"SELECT count(*) FROM {database}.stg_lnd_flights").first()[0] == 7
    spark.sql(f"DROP DATABASE {database} CASCADE")


def scanned_rows(frame):
    """Rows that the scan handed on after skipping row groups."""
    frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark, tmp_path):
    """By route through sorted rows, by key through Bloom filters: of 40 row groups a few are read."""
    flights = spark.range(40_000).select(
        F.md5(F.col("id").cast("string")).alias("flight_key"), F.lit(date(2024, 1, 1)).alias("flight_date"), F.format_string("D%02d", F.col("id") * 7919 % 40).alias("dep_iata"),
        F.lit("X").alias("arr_iata"), F.sha2(F.col("id").cast("string"), 512).alias("filler"))
    path, plain = str(tmp_path / "fact"), str(tmp_path / "plain")
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(128 << 10))
    try:
        write_mart(flights.repartition(1), plain, ["flight_date"])
        write_mart(flights.repartition(1), path, ["flight_date"], cluster_by=["dep_iata", "arr_iata"], bloom=["flight_key"])
    finally:
        hadoop.unset("parquet.block.size")
    groups = sum(pq.ParquetFile(f).num_row_groups for f in (tmp_path / "fact").rglob("*.parquet"))
    assert groups >= 20
    route = lambda p: scanned_rows(read_fact(spark, p).where("dep_iata = 'D07'").select("filler"))
    key = lambda p: scanned_rows(read_fact(spark, p).where(F.col("flight_key") == F.md5(F.lit("123"))).select("filler"))
    assert route(path) <= 0.15 * route(plain)
    assert key(path) <= 0.15 * key(plain)
    assert read_fact(spark, path).where("dep_iata = 'D07'").count() == 1000
    # Upserts write the fact so.
    stored = str(tmp_path / "stored")
    upsert_fact(spark, stored, flights.limit(2000))
    first = next((tmp_path / "stored").rglob("*.parquet"))
    routes = pq.read_table(first, partitioning=None)["dep_iata"].to_pylist()
    assert routes == sorted(routes)
