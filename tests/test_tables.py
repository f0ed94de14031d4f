"""Sinks, upsert, checks, the daily run and the streaming pickup."""

import hashlib
import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from flightloom.operators import category_mismatches, check, duplicate_keys, finish_upsert, upsert_fact
from flightloom.plans import marts
from flightloom.plans.daily import Layout, QualityError, ask, register_tables, run_batches
from flightloom.plans.serving import QUESTIONS
from flightloom.sources import LandingError, failures_path, read_fact, store_failures, write_bronze, write_mart
from flightloom.streaming import changed_dates, watch_landing
from tests.test_landing import FULL, flight, land, page

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def fact_rows(spark, *rows):
    return spark.createDataFrame(rows, "flight_key string, flight_date date, v string")


def stored(spark, path):
    return sorted((r.flight_key, r.flight_date, r.v) for r in read_fact(spark, path).collect())


def digests(folder):
    return {f.name: hashlib.md5(f.read_bytes()).hexdigest() for f in sorted(folder.glob("*.parquet"))}


def test_upsert_replaces_and_inserts(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows, touched = upsert_fact(spark, path, fact_rows(spark, ("a", D1, "1"), ("b", D1, "1"), ("c", D2, "1")))
    assert (rows, sorted(touched)) == (3, [D1, D2])
    untouched = digests(tmp_path / "fact" / "flight_date=2024-01-02")
    batch = fact_rows(spark, ("a", D1, "2"), ("x", D1, "2"))
    expected = [("a", D1, "2"), ("b", D1, "1"), ("c", D2, "1"), ("x", D1, "2")]
    for _ in range(2):  # a repeated batch changes nothing
        rows, touched = upsert_fact(spark, path, batch)
        assert (rows, touched) == (2, [D1])
        assert stored(spark, path) == expected
    assert digests(tmp_path / "fact" / "flight_date=2024-01-02") == untouched

    upsert_fact(spark, path, fact_rows(spark, ("x", D1, "3"), ("y", D3, "3")))
    assert stored(spark, path) == sorted([*expected[:3], ("x", D1, "3"), ("y", D3, "3")])
    assert upsert_fact(spark, path, fact_rows(spark, ("z", D3, "4")).limit(0)) == (0, [])
    assert len(stored(spark, path)) == 5


def test_bronze_replaces_only_the_dates_it_is_given(spark, tmp_path):
    root = str(tmp_path / "bronze")
    rows = spark.createDataFrame([(1, D1), (2, D1), (3, D2)], "n int, insert_date date")
    assert write_bronze(rows, root) == 3
    assert write_bronze(rows.where("n = 2"), root, rebalance=False) == 1
    assert write_bronze(rows.where("n > 99"), root) == 0
    assert sorted(r.n for r in spark.read.parquet(root).collect()) == [2, 3]


def test_output_files_can_be_capped(spark, tmp_path):
    rows = spark.range(1000).repartition(8).withColumn("insert_date", F.lit(D1))
    write_bronze(rows, str(tmp_path / "b"), max_output_files=2)
    assert len(list((tmp_path / "b" / "insert_date=2024-01-01").glob("*.snappy.parquet"))) == 2
    write_bronze(rows, str(tmp_path / "z"), compression="zstd")
    assert list((tmp_path / "z" / "insert_date=2024-01-01").glob("*.zstd.parquet"))


def test_mart_is_rebuilt_whole(spark, tmp_path):
    path = str(tmp_path / "m")
    assert write_mart(spark.range(5), path) == 5
    assert write_mart(spark.range(2), path) == 2
    assert spark.read.parquet(path).count() == 2


def test_check_grades(spark, tmp_path):
    failing = spark.range(3)
    assert check(failing, "a")[1:3] == ("error", 3)
    assert check(failing, "a", warn_over=1, error_over=5).status == "warn"
    assert check(failing, "a", warn_over=3, error_over=5).status == "pass"
    assert check(failing.limit(0), "a", str(tmp_path))[1:3] == ("pass", 0)
    kept = check(failing, "b", str(tmp_path))
    assert kept.failures == 3 and spark.read.parquet(kept.stored_at).count() == 3
    assert store_failures(failing, str(tmp_path), "c") == 3
    assert spark.read.parquet(failures_path(str(tmp_path), "c")).count() == 3


def test_seeded_faults_are_found(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("b",)], "flight_key string")
    assert [tuple(r) for r in duplicate_keys(keys).collect()] == [("a", 2)]
    rows = spark.createDataFrame([(None, "ontime"), (50, "ontime")], "dep_delay_min int, delay_category string")
    assert category_mismatches(rows).count() == 1
    assert category_mismatches(rows, strict=True).count() == 2


def other(number, day, delay):
    return flight(
        flight_date=day,
        flight={"number": number, "iata": None, "icao": None},
        departure={**FULL["departure"], "delay": delay},
    )


def test_daily_runs_equal_one_backfill(spark, tmp_path):
    one, many = Layout.under(str(tmp_path / "one")), Layout.under(str(tmp_path / "many"))
    for layout in (one, many):
        root = tmp_path / ("one" if layout is one else "many") / "raw"
        land(root, "2024-01-01", page(FULL, other("7", "2024-01-01", 50), other("8", "2024-01-01", 0)))
        land(root, "2024-01-02", page(other("7", "2024-01-01", -20), other("7", "2024-01-02", 5)), page(FULL))
    days = ["2024-01-01", "2024-01-02"]
    reports = [run_batches(spark, one, [day]) for day in days]
    whole = run_batches(spark, many, days)
    assert [r.bronze_rows for r in reports] == [3, 3] and whole.bronze_rows == 6
    assert [r.fact_rows for r in reports] == [3, 3] and whole.fact_rows == 4
    assert all(c.status == "pass" for r in (*reports, whole) for c in r.checks)
    for name in ("fact", "route_daily", "delay_heatmap", "weekly_comparison"):
        paths = [layout.fact if name == "fact" else f"{layout.marts}/{name}" for layout in (one, many)]
        tables = [read_fact(spark, p) for p in paths]
        rows = [sorted(str(r.asDict()) for r in t.select(*sorted(t.columns)).collect()) for t in tables]
        assert rows[0] == rows[1] and rows[0]
    # marts that follow the fact by touched dates equal marts built from all of it
    fact = read_fact(spark, one.fact)
    for name, build in (
        ("route_daily", marts.route_daily),
        ("delay_heatmap", marts.delay_heatmap),
        ("weekly_comparison", marts.weekly_comparison),
    ):
        whole_mart, followed = build(fact), read_fact(spark, f"{one.marts}/{name}")
        assert sorted(map(str, whole_mart.collect())) == sorted(map(str, followed.select(*whole_mart.columns).collect()))
    # a repeated run changes nothing
    before = sorted(map(str, read_fact(spark, many.fact).collect()))
    run_batches(spark, many, days[1:])
    assert sorted(map(str, read_fact(spark, many.fact).collect())) == before
    for question in QUESTIONS:
        answer = ask(spark, many, question).collect()
        assert answer or question == "k_top_routes"  # no route has five flights here


def test_stored_tables_answer_plain_sql(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    land(tmp_path / "raw", "2024-01-01", page(*[other(str(n), "2024-01-01", 20 * n) for n in range(6)]))
    run_batches(spark, layout, ["2024-01-01"])
    register_tables(spark, layout)
    asked = spark.sql("SELECT route, total_flights FROM fct_route_daily WHERE delayed_pct > 40 AND dep_iata = 'OSL'")
    stored = read_fact(spark, f"{layout.marts}/route_daily")
    assert [tuple(r) for r in asked.collect()] == [("OSL-TOS", 6)] and stored.count() == 1
    assert [r.route for r in ask(spark, layout, "k_top_routes").collect()] == ["OSL-TOS"]
    for table in ("fct_flights", "delay_heatmap", "weekly_comparison"):
        assert spark.sql(f"SELECT * FROM {table}").count() > 0


def test_the_contract_holds_for_each_date(spark, tmp_path):
    """Whether dates are loaded one by one or together, the same ones fail and the others are loaded."""
    layout = Layout.under(str(tmp_path))
    land(tmp_path / "raw", "2024-01-01", {"error": "down"})
    land(tmp_path / "raw", "2024-01-02", page())
    land(tmp_path / "raw", "2024-01-03", page(FULL))
    with pytest.raises(LandingError):
        run_batches(spark, layout, ["2024-01-01"])
    quiet = run_batches(spark, layout, ["2024-01-02"])  # a page without flights is not an error
    assert (quiet.pages["2024-01-02"]["data_pages"], quiet.bronze_rows, quiet.fact_rows) == (1, 0, 0)
    with pytest.raises(LandingError, match="2024-01-01") as failure:
        run_batches(spark, layout, ["2024-01-01", "2024-01-02", "2024-01-03"])
    report = failure.value.report
    assert list(report.failed_dates) == ["2024-01-01"] and (report.bronze_rows, report.fact_rows) == (1, 1)
    land(tmp_path / "raw", "2024-01-01", page(FULL), "cut off {")
    report = run_batches(spark, layout, ["2024-01-01", "2024-01-02"])
    assert report.pages["2024-01-01"] == {"pages": 3, "corrupt_pages": 1, "error_pages": 1, "data_pages": 1, "flights": 1}
    with pytest.raises(LandingError, match="2024-01-01: unusable") as failure:
        run_batches(spark, layout, ["2024-01-01", "2024-01-03"], strict=True)
    assert failure.value.report.fact_rows == 1


def test_a_date_that_lost_its_flights_loses_its_bronze(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    for day in ("2024-01-01", "2024-01-02"):
        land(tmp_path / "raw", day, page(FULL))
    run_batches(spark, layout, ["2024-01-01", "2024-01-02"])
    (tmp_path / "raw" / "insert_date=2024-01-01" / "flights_page_0.json").write_text(json.dumps(page()))
    run_batches(spark, layout, ["2024-01-01", "2024-01-02"])
    assert [str(r.insert_date) for r in spark.read.parquet(layout.bronze).collect()] == ["2024-01-02"]


def test_a_run_without_any_dated_flight_reports(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    land(tmp_path / "raw", "2024-01-01", page(flight(flight_date=None)))
    report = run_batches(spark, layout, ["2024-01-01"])
    assert (report.fact_rows, [c.status for c in report.checks]) == (0, ["error"])


def test_an_upsert_that_breaks_off_loses_nothing(spark, tmp_path):
    path, rows = str(tmp_path / "fact"), "flight_key string, flight_date date, n int"
    day = date(2024, 1, 1)
    upsert_fact(spark, path, spark.createDataFrame([("a", day, 1), ("b", day, 1)], rows))
    # Staged and marked, the old partition already deleted: as a writer that dies between delete and move leaves it.
    staging = f"{path}.upsert"
    spark.createDataFrame([("b", day, 2), ("c", day, 2)], rows).write.parquet(f"{staging}/batch")
    spark.createDataFrame([("a", day, 1)], rows).write.parquet(f"{staging}/survivors")
    assert finish_upsert(spark, str(tmp_path / "other")) is False
    (tmp_path / "fact.upsert" / "READY").touch()
    for part in (tmp_path / "fact" / "flight_date=2024-01-01").iterdir():
        part.unlink()
    upsert_fact(spark, path, spark.createDataFrame([("d", day, 3)], rows))
    assert sorted((r.flight_key, r.n) for r in read_fact(spark, path).collect()) == [("a", 1), ("b", 2), ("c", 2), ("d", 3)]
    assert not (tmp_path / "fact.upsert").exists()
    # Broken off before the mark: cleared, nothing applied.
    spark.createDataFrame([("z", day, 9)], rows).write.parquet(f"{staging}/batch")
    assert finish_upsert(spark, path) is False
    assert read_fact(spark, path).count() == 4


def test_a_failed_check_stops_the_run_before_the_fact(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    land(tmp_path / "raw", "2024-01-01", page(FULL, flight(flight_date=None)))
    with pytest.raises(QualityError, match="flight_date_not_null"):
        run_batches(spark, layout, ["2024-01-01"], stop_on_error=True)
    assert not (tmp_path / "fact").exists()
    report = run_batches(spark, layout, ["2024-01-01"])
    assert report.checks[0].status == "error" and report.fact_rows == 1
    assert spark.read.parquet(report.checks[0].stored_at).count() == 1


def test_streaming_pickup_loads_each_landed_date(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    loaded = []

    def load(dates):
        loaded.append(dates)
        run_batches(spark, layout, dates)

    def pick_up():
        watch_landing(spark, layout.raw, str(tmp_path / "seen"), load).awaitTermination()

    land(tmp_path / "raw", "2024-01-01", page(FULL))
    land(tmp_path / "raw", "2024-01-02", page(other("7", "2024-01-02", 5)))
    pick_up()
    assert loaded == [["2024-01-01", "2024-01-02"]]
    pick_up()
    assert len(loaded) == 1  # nothing new
    land(tmp_path / "raw", "2024-01-02", page(other("8", "2024-01-02", 9)))
    pick_up()
    assert loaded[1:] == [["2024-01-02"]]
    assert read_fact(spark, layout.fact).count() == 3
    assert spark.read.parquet(layout.bronze).count() == 3


def test_pickup_of_old_time_stamps_and_of_pages_landed_again(spark, tmp_path):
    raw, seen = tmp_path / "raw", []
    pick_up = lambda: watch_landing(spark, str(raw), str(tmp_path / "seen"), seen.append).awaitTermination()
    changed = lambda: changed_dates(spark, str(raw), str(tmp_path / "state"))
    land(raw, "2024-01-01", page(FULL))
    pick_up()
    assert changed() == ["2024-01-01"]
    land(raw, "2024-01-02", page(FULL))
    old = (raw / "insert_date=2024-01-02" / "flights_page_0.json").stat().st_mtime - 10 * 86400
    os.utime(raw / "insert_date=2024-01-02" / "flights_page_0.json", (old, old))
    pick_up()
    assert seen == [["2024-01-01"], ["2024-01-02"]]
    assert changed() == ["2024-01-02"]
    (raw / "insert_date=2024-01-01" / "flights_page_0.json").write_text(json.dumps(page(FULL, FULL)))
    assert changed() == ["2024-01-01"] and changed() == []
