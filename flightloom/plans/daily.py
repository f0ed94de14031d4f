"""The daily run: landed pages → bronze → fact → marts, with the checks in between.

One run covers any number of insert dates. A single date is the daily case; many dates are a backfill, done as one job per
layer instead of one run per date, with the same result (the latest batch wins). Every layer replaces whole partitions, so
repeating a run changes nothing.

The marts read the stored fact, so they are built after it, always.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    CheckResult,
    cast_failures,
    check,
    check_fact,
    finish_upsert,
    flatten_flights,
    stage_flights,
    undated_flights,
    upsert_fact,
)
from ..operators.silver import MAX_GROUP_ROWS
from ..session import discard, path_exists
from ..sources import (
    LandingError,
    contract_failure,
    date_counts,
    read_dates,
    read_fact,
    read_flight_pages,
    read_ledger,
    refresh_ledger,
    scan_insert_dates,
    store_failures,
    write_bronze,
    write_mart,
)
from . import marts, serving


class Layout(NamedTuple):
    """Where each layer lives."""

    raw: str
    bronze: str
    fact: str
    marts: str
    metadata: str

    @property
    def ledger(self) -> str:
        """What has landed, one row per file."""
        return f"{self.metadata}/page_ledger"

    @classmethod
    def under(cls, root: str) -> Layout:
        root = root.rstrip("/")
        return cls(*[f"{root}/{name}" for name in ("raw", "bronze", "fact", "marts", "metadata")])


class RunReport(NamedTuple):
    pages: dict[str, dict[str, int]]  # by insert date
    bronze_rows: int
    fact_rows: int
    checks: list[CheckResult]
    failed_dates: dict[str, str] = {}  # insert dates whose pages cannot be used, with the reason
    cast_failures: int = 0  # cells that could not be read, kept under ``metadata/cast_failures``


class QualityError(Exception):
    """A data-quality check graded ``error``."""


def _graded(result: CheckResult, stop_on_error: bool) -> CheckResult:
    if stop_on_error and result.status == "error":
        raise QualityError(f"{result.name}: {result.failures} failing rows, kept at {result.stored_at}")
    return result


def rebuild_marts(spark: SparkSession, layout: Layout, touched: Sequence | None = None) -> None:
    """Bring the marts up to date with the stored fact.

    Every measure belongs to one flight date, so only the touched dates of the fact are read: ``route_daily`` and the hourly
    sums are replaced for those dates, and the heatmap and the weeks are added up from the stored sums.
    """
    routes, hours = f"{layout.marts}/route_daily", f"{layout.marts}/day_hours"
    everything = touched is None or not path_exists(spark, hours)
    changed = read_fact(spark, layout.fact) if everything else read_dates(spark, layout.fact, touched)
    if changed is None:
        return
    write_mart(marts.route_daily(changed), routes, ["flight_date"], only_touched=not everything)
    write_mart(marts.day_hours(changed), hours, ["flight_date"], only_touched=not everything)

    stored_hours = read_fact(spark, hours)
    write_mart(marts.heatmap_of_day_hours(stored_hours), f"{layout.marts}/delay_heatmap")
    weeks = marts.weeks_of_day_hours(stored_hours)
    write_mart(marts.compare_weeks(weeks), f"{layout.marts}/weekly_comparison")


def run_batches(
    spark: SparkSession,
    layout: Layout,
    insert_dates: Sequence[str],
    tie_break: Sequence[str] | None = None,
    stop_on_error: bool = False,
    strict: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> RunReport:
    """Load the given insert dates end to end. However dates are grouped into runs, the tables come out the same.

    ``tie_break`` names bronze columns that order otherwise equal rows (default: a hash of the row). With ``stop_on_error``
    a failing check raises before the marts are built; otherwise results are only reported. The landing contract holds for each
    date by itself, and is decided from the page ledger: a date that breaks it is left out and keeps its old bronze, the others are loaded, and then ``LandingError``
    is raised, with the report of what was loaded as its ``report``. ``strict`` makes the contract refuse error documents and
    unparsable pages, and the category check find wrong categories on unknown delays.
    """
    # Decided from the ledger, before anything is written.
    refresh_ledger(spark, layout.raw, layout.ledger, insert_dates)
    landed = date_counts(read_ledger(spark, layout.ledger, insert_dates), insert_dates)
    failed = {day: reason for day, counts in landed.items() if (reason := contract_failure(counts, strict))}
    loaded = [day for day in insert_dates if day not in failed]
    filled = [day for day in loaded if landed[day]["flights"]]
    for day in set(loaded) - set(filled):
        if path_exists(spark, f"{layout.bronze}/insert_date={day}"):
            discard(spark, f"{layout.bronze}/insert_date={day}")  # the date has no flights any more
    bronze_rows = 0
    if filled:
        pages = read_flight_pages(spark, layout.raw, filled)
        # One date needs no shuffle to keep its files together.
        bronze_rows = write_bronze(flatten_flights(pages, audit=True), layout.bronze, rebalance=len(filled) > 1)
    report = _load(spark, layout, filled, tie_break, stop_on_error, strict, max_group_rows) if filled else RunReport({}, 0, 0, [])
    report = report._replace(pages=landed, bronze_rows=bronze_rows, failed_dates=failed)
    if failed:
        error = LandingError("; ".join(f"{day}: {reason}" for day, reason in failed.items()))
        error.report = report
        raise error
    return report


def _load(
    spark: SparkSession, layout: Layout, insert_dates: Sequence[str], tie_break: Sequence[str] | None, stop_on_error: bool, strict: bool, max_group_rows: int
) -> RunReport:
    """Bronze of some insert dates → fact → marts, with the checks."""
    bronze = scan_insert_dates(spark, layout.bronze, insert_dates)
    undated = check(undated_flights(bronze), "flight_date_not_null", layout.metadata)
    checks = [_graded(undated, stop_on_error)]
    unread = store_failures(cast_failures(bronze), layout.metadata, "cast_failures")

    finish_upsert(spark, layout.fact)
    staged = stage_flights(bronze, keep=("insert_date", *(tie_break or ())))
    fact = marts.fact_flights(staged, F.col("insert_date"), tie_break, batch="insert_date", max_group_rows=max_group_rows)
    fact_rows, touched = upsert_fact(spark, layout.fact, fact)
    if not touched:
        return RunReport({}, 0, 0, checks, cast_failures=unread)
    # A key holds its date, so only the dates just written can have gained a duplicate or a wrong category.
    written = read_dates(spark, layout.fact, touched)
    checks += [_graded(result, stop_on_error) for result in check_fact(written, layout.metadata, strict)]

    rebuild_marts(spark, layout, touched)
    return RunReport({}, 0, fact_rows, checks, cast_failures=unread)


def register_tables(spark: SparkSession, layout: Layout) -> None:
    """Make the stored tables known by the names SQL users query them under."""
    # Table names.
    tables = {
        "fct_flights": layout.fact,
        "fct_route_daily": f"{layout.marts}/route_daily",
        "delay_heatmap": f"{layout.marts}/delay_heatmap",
        "weekly_comparison": f"{layout.marts}/weekly_comparison",
    }
    for name, path in tables.items():
        read_fact(spark, path).createOrReplaceTempView(name)


def ask(spark: SparkSession, layout: Layout, question: str) -> DataFrame:
    """Answer a saved question from the stored tables."""
    table, answer = serving.QUESTIONS[question]
    path = layout.fact if table == "fact" else f"{layout.marts}/{table}"
    return answer(read_fact(spark, path))
