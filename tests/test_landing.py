"""Landed pages: parsing, the landing contract, flattening and rejects."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flightloom.operators import flatten_flights, missing_dates, reject_flights, stage_flights, undated_flights
from flightloom.sources import (
    LandingError,
    landed_dates,
    landing_audit,
    landing_contract,
    read_flight_pages,
    require_landed,
    scan_insert_date,
    write_bronze,
)

FULL = {
    "flight_date": "2024-03-05",
    "flight_status": "landed",
    "departure": {
        "airport": "Oslo Gardermoen", "timezone": "Europe/Oslo", "iata": "OSL", "icao": "ENGM", "gate": "B7",
        "delay": 31, "scheduled": "2024-03-05T18:20:00+00:00", "actual": "2024-03-05T18:51:00+00:00",
    },
    "arrival": {
        "airport": "Tromso Langnes", "iata": "TOS", "icao": "ENTC", "baggage": "2", "delay": "22",
        "scheduled": "2024-03-05T20:15:00+00:00", "actual": None,
    },
    "airline": {"name": "Nordlys Fly", "iata": "NF", "icao": "NLF"},
    "flight": {"number": "218", "iata": "NF218", "icao": "NLF218", "codeshared": None},
    "aircraft": {"registration": "LN-XYZ", "iata": "E95", "icao": "E195", "icao24": "4A1B2C"},
    "live": {"latitude": 64.25, "longitude": 14.5, "altitude": 10500.0, "is_ground": False, "direction": 12.0},
}


def flight(**changes):
    return {**FULL, **changes}


def land(root, insert_date, *documents):
    folder = root / f"insert_date={insert_date}"
    folder.mkdir(parents=True, exist_ok=True)
    for document in documents:
        n = len(list(folder.iterdir()))
        text = document if isinstance(document, str) else json.dumps(document)
        (folder / f"flights_page_{n}.json").write_text(text, encoding="utf-8")


def page(*flights, total=None):
    return {"pagination": {"limit": 100, "offset": 0, "count": len(flights), "total": total or len(flights)}, "data": flights}


def test_full_document(spark, tmp_path):
    land(tmp_path, "2024-03-05", page(FULL))
    bronze = flatten_flights(read_flight_pages(spark, str(tmp_path)), "2024-03-06")
    assert len(bronze.columns) == 33  # 32 bronze columns and the partition
    row = bronze.first()
    assert (row.dep_iata, row.arr_iata, row.dep_delay_min, row.arr_delay_min) == ("OSL", "TOS", 31, 22)
    assert (row.flight_iata_full, row.airline_name, row.aircraft_reg) == ("NF218", "Nordlys Fly", "LN-XYZ")
    assert (row.live_latitude, row.live_longitude, row.live_is_ground) == (64.25, 14.5, False)
    assert row.dep_actual_ts == datetime(2024, 3, 5, 18, 51) and row.arr_actual_ts is None
    assert (row.ingestion_date, row.insert_date) == ("2024-03-06", date(2024, 3, 5))

    staged = stage_flights(bronze).first()
    assert staged.flight_iata_full == "NF218" and staged.ingestion_date == date(2024, 3, 6)
    assert staged.dep_scheduled == datetime(2024, 3, 5, 18, 20)


def test_absent_parts_become_typed_nulls(spark, tmp_path):
    land(tmp_path, "2024-01-15", page(flight(live=None, aircraft=None)))
    bronze = flatten_flights(read_flight_pages(spark, str(tmp_path)))
    row = bronze.first()
    assert row.live_latitude is None and row.live_is_ground is None and row.aircraft_reg is None
    kinds = dict(bronze.dtypes)
    assert (kinds["live_latitude"], kinds["live_is_ground"], kinds["aircraft_reg"]) == ("double", "boolean", "string")


def test_pages_without_flights_give_no_rows(spark, tmp_path):
    land(tmp_path, "2024-01-15", page(), page(FULL), {"data": None})
    assert flatten_flights(read_flight_pages(spark, str(tmp_path))).count() == 1


def test_contract_refuses_unusable_input(spark, tmp_path):
    with pytest.raises(LandingError):
        read_flight_pages(spark, str(tmp_path / "absent"))
    with pytest.raises(LandingError):
        read_flight_pages(spark, str(tmp_path), ["2024-01-01"])
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(LandingError):
        require_landed(read_flight_pages(spark, str(empty)))
    for n, text in enumerate(['{"error": "no data"}', "this is not JSON"]):
        folder = tmp_path / f"bad{n}"
        land(folder, "2024-01-01", text)
        with pytest.raises(LandingError):
            require_landed(read_flight_pages(spark, str(folder)))


def test_contract_counts_and_strictness(spark, tmp_path):
    error = {"error": {"code": "limit", "message": "try later"}}
    land(tmp_path, "2024-01-01", page(FULL), error, '{"data": [{"flight_date": "2024', page())
    pages = read_flight_pages(spark, str(tmp_path))
    assert require_landed(pages) == {"pages": 4, "corrupt_pages": 1, "error_pages": 1, "data_pages": 2}
    with pytest.raises(LandingError):
        require_landed(pages, strict=True)
    # The split does not depend on what a query asks for.
    assert pages.count() == 4
    assert pages.where(F.col("page._corrupt_record").isNotNull()).count() == 1
    assert landing_contract(pages).first().corrupt_pages == 1


def test_audit_per_insert_date(spark, tmp_path):
    land(tmp_path, "2024-01-01", page(FULL, FULL, total=250), page(FULL, total=250))
    land(tmp_path, "2024-01-02", page(FULL, total=1))
    land(tmp_path, "2024-01-03", {"error": "down"})
    audit = {str(r.insert_date): r for r in landing_audit(read_flight_pages(spark, str(tmp_path)), 100, 5).collect()}
    first, second, third = (audit[f"2024-01-0{n}"] for n in (1, 2, 3))
    assert (first.pages_landed, first.flights, first.expected_pages, first.complete) == (2, 3, 3, False)
    assert (second.pages_landed, second.expected_pages, second.complete) == (1, 1, True)
    assert (third.error_pages, third.unpaginated_pages, third.reported_total, third.expected_pages) == (1, 1, 0, 1)


def test_bad_dates_are_rejected_not_lost(spark, tmp_path):
    land(tmp_path, "2024-01-01", page(FULL, flight(flight_date="2024-13-40"), flight(flight_date=None)))
    bronze = flatten_flights(read_flight_pages(spark, str(tmp_path)))
    assert stage_flights(bronze).count() == 1
    reasons = sorted(r.reject_reason for r in reject_flights(bronze).collect())
    assert reasons == ["bad flight_date", "missing flight_date"]
    assert undated_flights(bronze).count() == 2
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_flights(bronze, strict=True).collect()


def test_identity_needs_airline_and_number(spark, tmp_path):
    unknown = flight(airline={"name": None, "iata": None, "icao": None})
    land(tmp_path, "2024-01-01", page(FULL, unknown))
    staged = stage_flights(flatten_flights(read_flight_pages(spark, str(tmp_path))))
    assert {r.flight_iata_full for r in staged.collect()} == {"NF218", None}


def test_one_date_is_listed_alone(spark, tmp_path):
    land(tmp_path / "raw", "2024-01-01", page(FULL))
    land(tmp_path / "raw", "2024-01-02", page(FULL, FULL))
    pages = read_flight_pages(spark, str(tmp_path / "raw"), ["2024-01-02"])
    assert {str(r.insert_date) for r in pages.collect()} == {"2024-01-02"}
    bronze = str(tmp_path / "bronze")
    assert write_bronze(flatten_flights(read_flight_pages(spark, str(tmp_path / "raw"))), bronze) == 3
    one = scan_insert_date(spark, bronze, "2024-01-02")
    assert one.count() == 2 and len(one.inputFiles()) == 1


def test_missing_dates(spark, tmp_path):
    land(tmp_path, "2024-01-02", page(FULL), page(FULL))
    (tmp_path / "insert_date=2024-01-03").mkdir()  # nothing landed there yet
    landed = landed_dates(spark, str(tmp_path))
    assert "content" not in landed._jdf.queryExecution().executedPlan().toString()
    gaps = missing_dates(landed, "2024-01-01", "2024-01-03")
    assert sorted(str(r.insert_date) for r in gaps.collect()) == ["2024-01-01", "2024-01-03"]
