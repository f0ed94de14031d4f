"""The page ledger, and waiting until a date is complete."""

import json
import os
import shutil
import time

import pytest

from flightloom.plans.daily import Layout, run_batches
from flightloom.sources import LandingError, audit_ledger, date_counts, landing_audit, read_flight_pages, read_ledger, refresh_ledger
from flightloom.streaming import watch_complete
from tests.test_landing import FULL, flight, land, page

DAY = 86400


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_ledger_answers_the_audit(spark, tmp_path):
    raw, ledger = tmp_path / "raw", str(tmp_path / "ledger")
    land(raw, "2024-01-01", page(FULL, FULL, total=250), page(FULL), {"error": "down"})
    land(raw, "2024-01-02", page(), "cut off {", {"data": [FULL]}, "\n \n")
    land(raw, "2024-01-03", json.dumps(page(FULL)) + "\n" + json.dumps(page(FULL, total=900)))
    (raw / "insert_date=2024-01-01" / "flights_page_0.json").rename(raw / "insert_date=2024-01-01" / "flights page é%20.json")
    assert refresh_ledger(spark, str(raw), ledger) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    stored = read_ledger(spark, ledger)
    assert stored.count() == 8
    audited = audit_ledger(stored, max_pages=20)
    asked = landing_audit(read_flight_pages(spark, str(raw)), max_pages=20)
    assert rows(audited.select(*asked.columns)) == rows(asked)
    assert date_counts(stored, ["2024-01-02", "2024-01-09"]) == {
        "2024-01-02": {"pages": 3, "corrupt_pages": 1, "error_pages": 0, "data_pages": 2, "flights": 1},
        "2024-01-09": {"pages": 0, "corrupt_pages": 0, "error_pages": 0, "data_pages": 0, "flights": 0},
    }


def test_ledger_follows_changes(spark, tmp_path):
    raw, ledger = tmp_path / "raw", str(tmp_path / "ledger")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        land(raw, day, page(FULL))
    refresh_ledger(spark, str(raw), ledger)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "ledger").rglob("*.parquet")}
    assert refresh_ledger(spark, str(raw), ledger) == []
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "ledger").rglob("*.parquet")} == before
    (raw / "insert_date=2024-01-01" / "flights_page_0.json").write_text(json.dumps(page(FULL, FULL)))
    shutil.rmtree(raw / "insert_date=2024-01-02")
    land(raw, "2024-01-04", page(), "")
    assert refresh_ledger(spark, str(raw), ledger, ["2024-01-03"]) == []  # others are not looked at
    assert refresh_ledger(spark, str(raw), ledger) == ["2024-01-01", "2024-01-02", "2024-01-04"]
    assert refresh_ledger(spark, str(raw), ledger) == []  # an empty file is no news
    found = {str(r.insert_date): r.flights for r in audit_ledger(read_ledger(spark, ledger)).collect()}
    assert found == {"2024-01-01": 2, "2024-01-03": 1, "2024-01-04": 0}
    untouched = [f for f in before if "2024-01-03" in str(f)]
    assert untouched and all(f.stat().st_mtime_ns == before[f] for f in untouched)


def test_only_changed_dates_are_read_again(spark, tmp_path, monkeypatch):
    from flightloom.sources import ledger as ledger_module

    raw, ledger, read = tmp_path / "raw", str(tmp_path / "ledger"), []
    real = ledger_module.file_counts
    monkeypatch.setattr(ledger_module, "file_counts", lambda s, dirs: read.append([d[-10:] for d in dirs]) or real(s, dirs))
    for day in ("2024-01-01", "2024-01-02"):
        land(raw, day, page(FULL))
    refresh_ledger(spark, str(raw), ledger)
    land(raw, "2024-01-02", page(FULL))
    refresh_ledger(spark, str(raw), ledger)
    refresh_ledger(spark, str(raw), ledger)
    assert read == [["2024-01-01", "2024-01-02"], ["2024-01-02"]]


def test_a_thousand_dates_are_one_aggregate(spark, tmp_path):
    raw, ledger = tmp_path / "raw", str(tmp_path / "ledger")
    days = [f"{2000 + n // 336}-{n % 336 // 28 + 1:02d}-{n % 28 + 1:02d}" for n in range(1000)]
    for day in days:
        land(raw, day, page(FULL))
    start = time.monotonic()
    assert refresh_ledger(spark, str(raw), ledger, days) == days
    refreshed = time.monotonic()
    stored = read_ledger(spark, ledger, days)
    plan = stored.groupBy("insert_date").count()._jdf.queryExecution().optimizedPlan().toString()
    counts = date_counts(stored, days)
    assert all(counts[day]["flights"] == 1 for day in days)
    assert len(plan) < 5000  # whatever the number of dates
    assert time.monotonic() - refreshed < 60 and refreshed - start < 240


def test_runs_leave_dates_without_files_out(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    land(tmp_path / "raw", "2024-01-02", page(FULL))
    with pytest.raises(LandingError, match="2024-01-01: no pages found") as failure:
        run_batches(spark, layout, ["2024-01-01", "2024-01-02"])
    assert failure.value.report.fact_rows == 1
    assert [str(r.insert_date) for r in read_ledger(spark, layout.ledger).collect()] == ["2024-01-02"]


class Pickup:
    """A landing folder whose files have the times they are given, and a pickup that remembers what it released."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options, self.released = spark, root, options, []

    def land(self, day, at, *documents):
        before = set((self.root / "raw").rglob("*.json"))
        land(self.root / "raw", day, *documents)
        for file in set((self.root / "raw").rglob("*.json")) - before:
            os.utime(file, (at, at))

    def run(self):
        self.released = []
        collect = lambda found: self.released.extend((r.insert_date, r.status, r.pages, r.expected) for r in found)
        query = watch_complete(self.spark, str(self.root / "raw"), str(self.root / "seen"), collect, max_pages=10, **self.options)
        query.awaitTermination()
        self.state_rows = query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress and query.lastProgress["stateOperators"] else None
        return sorted(self.released)


def test_dates_are_released_when_complete(spark, tmp_path):
    start = 1_700_000_000
    pickup = Pickup(spark, tmp_path, wait_seconds=3600, remember_seconds=DAY)
    pickup.land("2024-01-01", start, page(FULL, total=250), page(FULL, total=250))
    pickup.land("2024-01-02", start, page(FULL))
    pickup.land("2024-01-03", start, page(), "cut off {")
    assert pickup.run() == [("2024-01-02", "complete", 1, 1), ("2024-01-03", "complete", 2, 1)]
    assert pickup.run() == []
    pickup.land("2024-01-01", start + 60, page(FULL, total=250))
    assert pickup.run() == [("2024-01-01", "complete", 3, 3)]
    pickup.land("2024-01-02", start + 120, page(FULL))
    assert pickup.run() == [("2024-01-02", "late", 2, 1)]


def test_incomplete_dates_time_out(spark, tmp_path):
    start = 1_700_000_000
    pickup = Pickup(spark, tmp_path, wait_seconds=3600, remember_seconds=DAY)
    pickup.land("2024-01-01", start, page(FULL, total=900))
    assert pickup.run() == []
    pickup.land("2024-01-02", start + 1800, page(FULL))
    assert pickup.run() == [("2024-01-02", "complete", 1, 1)]
    pickup.land("2024-01-03", start + 3700, page(FULL))  # the files' clock passes the hour
    assert pickup.run() == [("2024-01-01", "timed out", 1, 9), ("2024-01-03", "complete", 1, 1)]
    pickup.land("2024-01-01", start + 3800, page(flight(flight_date="2024-01-01"), total=900))
    assert pickup.run() == [("2024-01-01", "late", 2, 9)]


def test_state_does_not_grow_with_the_lake(spark, tmp_path):
    start = 1_700_000_000
    pickup, seen = Pickup(spark, tmp_path, wait_seconds=3600, remember_seconds=DAY), []
    for n in range(6):
        for k in range(4):
            pickup.land(f"2024-0{n + 1}-0{k + 1}", start + n * 5 * DAY + k, page(FULL))
        assert len(pickup.run()) == 4
        seen.append(pickup.state_rows)
    assert max(seen) <= 8 and seen[-1] <= 8
    pickup.land("2024-01-01", start + 40 * DAY, page(FULL))  # long forgotten, and still released
    assert pickup.run() == [("2024-01-01", "complete", 1, 1)]
