"""Headerless reference files."""

import logging
from decimal import Decimal

import pytest

from flightloom.operators import stage_reference
from flightloom.schemas import REFERENCE_DATASETS
from flightloom.sources import (
    LandingError,
    accepted,
    load_reference,
    name_columns,
    read_bronze,
    read_reference,
    read_reference_csv,
    rejected,
    write_reference,
)

AIRPORTS = '\n'.join(
    [
        '1,"Goroka, Airport","Goroka","Papua New Guinea","GKA","AYGA",-6.081689834590001,145.391998291,5282,10,"U",'
        '"Pacific/Port_Moresby","airport","OurAirports"',
        r'2,"A \"quoted\" name","Köln",\N,\N,"EDDK",50.8658981323,7.1427397728,302,1,"E",\N,"airport","OurAirports"',
        "3,short",
        '4,"Bad altitude","X","Y","ABC","ABCD",1,2,high,5.5,"N","Z","airport","S"',
        "",
        '5,"One too many","X","Y","ABC","ABCD",1,2,3,4,"N","Z","airport","S","extra"',
    ]
)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "airports.dat").write_text(AIRPORTS, encoding="utf-8")
    (folder / "airlines.dat").write_text('1,"Air, Inc",\\N,"AI","AIR","CALL","Land","Y"\n', encoding="utf-8")
    (folder / "routes.dat").write_text('AI,1,GKA,1,CGN,2,,0,738 739\n', encoding="utf-8")
    (folder / "planes.dat").write_text('"Aérospatiale ""X""","ND2","N262"\n', encoding="utf-8")
    (folder / "countries.dat").write_text("", encoding="utf-8")
    return str(folder)


def test_datasets():
    assert {n: len(d.columns) for n, d in REFERENCE_DATASETS.items()} == {
        "airports": 14, "airlines": 8, "routes": 9, "planes": 3, "countries": 3,
    }
    assert {n: len(d.staged) for n, d in REFERENCE_DATASETS.items()} == {
        "airports": 14, "airlines": 8, "routes": 9, "planes": 3, "countries": 2,
    }
    for dataset in REFERENCE_DATASETS.values():
        assert {raw for raw, _, _ in dataset.staged} <= set(dataset.columns)


def test_lines_split_the_same_way_whatever_is_asked(spark, raw):
    lines = read_reference_csv(spark, f"{raw}/airports.dat", REFERENCE_DATASETS["airports"])
    good, bad = accepted(lines), rejected(lines)
    assert lines.count() == 5
    assert good.count() == len(good.collect()) == len(good.select("airport_id").collect()) == 3
    assert bad.count() == len(bad.collect()) == 2
    assert {r.first_cell for r in bad.collect()} == {"3", "5"}
    assert "3,short" in {r.line for r in bad.collect()}


def test_cells(spark, raw):
    lines = read_reference_csv(spark, f"{raw}/airports.dat", REFERENCE_DATASETS["airports"])
    staged = {r.airport_id: r for r in stage_reference(accepted(lines), REFERENCE_DATASETS["airports"]).collect()}
    assert staged[1].airport_name == "Goroka, Airport"
    assert staged[1].airport_latitude == Decimal("-6.081690") and staged[1].airport_timezone == Decimal("10.00")
    assert staged[2].airport_name == 'A "quoted" name' and staged[2].airport_city == "Köln"
    assert staged[2].airport_country is None and staged[2].airport_iata_code is None
    assert staged[4].airport_altitude_feet is None  # a bad number is null, and the row stays


def test_text_is_never_cut(spark, raw):
    routes = read_reference_csv(spark, f"{raw}/routes.dat", REFERENCE_DATASETS["routes"])
    row = stage_reference(accepted(routes), REFERENCE_DATASETS["routes"]).first()
    assert row.plane_type == "738 739" and row.stops == 0


def test_all_datasets_to_bronze(spark, raw, tmp_path, caplog):
    with caplog.at_level(logging.WARNING):
        frames = read_reference(spark, raw)
        written = write_reference({**{n: accepted(df) for n, df in frames.items()}, "absent": None}, str(tmp_path / "b"))
    assert written == {"airports": 3, "airlines": 1, "routes": 1, "planes": 1}
    assert "countries.dat) is empty" in caplog.text and "skipping absent" in caplog.text
    assert read_bronze(spark, str(tmp_path / "b" / "airports.parquet")).count() == 3


def test_columns_are_named_by_position(spark):
    frames = {"planes": spark.createDataFrame([("a", "b", "c")]), "other": spark.range(1)}
    named = name_columns(frames)
    assert named["planes"].columns == ["name", "iata_code", "icao_code"] and named["other"].columns == ["id"]
    with pytest.raises(Exception):
        name_columns({"airports": frames["planes"]})


def test_missing_files_are_reported_together(spark, tmp_path):
    with pytest.raises(LandingError) as failure:
        read_reference(spark, str(tmp_path))
    for dataset in REFERENCE_DATASETS.values():
        assert dataset.filename in str(failure.value)


def test_one_load_for_all_files(spark, raw, tmp_path):
    loaded = load_reference(spark, raw, str(tmp_path / "b"), str(tmp_path / "m"))
    assert loaded == {"airports": (3, 2), "airlines": (1, 0), "routes": (1, 0), "planes": (1, 0), "countries": (0, 0)}
    assert {r.first_cell for r in read_bronze(spark, str(tmp_path / "m" / "airports_rejects")).collect()} == {"3", "5"}


def test_each_line_is_parsed_once(spark, raw):
    lines = read_reference_csv(spark, f"{raw}/airports.dat", REFERENCE_DATASETS["airports"])
    for frame in (accepted(lines), rejected(lines)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
