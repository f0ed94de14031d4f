"""Data-quality checks. Each check is a DataFrame of failing rows; ``check`` applies a threshold policy to it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import category_agrees, count_rows
from ..sources.sinks import failures_path, store_failures


class CheckResult(NamedTuple):
    name: str
    status: str  # "pass", "warn" or "error"
    failures: int
    stored_at: str | None


def undated_flights(bronze: DataFrame) -> DataFrame:
    """Rows without a usable flight date. Takes bronze rows: staging has already dropped what this looks for."""
    return bronze.where(F.col("flight_date").try_cast("date").isNull())


def cast_failures(bronze: DataFrame) -> DataFrame:
    """One row per cell that could not be read: the flight's identifier, the column and the insert date. Takes bronze made with ``audit``."""
    return bronze.select("flight_icao_full", F.explode("failed_casts").alias("column"), "insert_date")


def duplicate_keys(rows: DataFrame, key: str = "flight_key") -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(key).agg(count_rows().alias("occurrences")).where(F.col("occurrences") > 1)


def category_mismatches(flights: DataFrame, strict: bool = False) -> DataFrame:
    """Rows whose delay category does not fit their delay. ``strict`` also finds wrong categories on unknown delays."""
    return flights.where(~category_agrees(F.col("dep_delay_min"), F.col("delay_category"), strict))


#: Failing rows over which a check warns, and over which it is an error.
POLICY = {
    "flight_date_not_null": (0, 0),
    "unique_flight_key": (0, 0),
    "delay_category": (5, 0),
}


def graded(name: str, failures: int, stored_at: str | None = None) -> CheckResult:
    """A check's result by the limits of ``POLICY``."""
    warn, error = POLICY.get(name, (0, 0))
    return CheckResult(name, "error" if failures > error else "warn" if failures > warn else "pass", failures, stored_at)


def check_fact(fact: DataFrame, metadata_root: str, strict: bool = False, key: str = "flight_key") -> list[CheckResult]:
    """The fact's checks in one pass over it: each category against its delay, and each key that occurs more than once.

    Rows are brought together by key, which takes only the key and, of a failing row, the row itself through the shuffle. What fails is written partitioned by
    check under ``<metadata_root>/fact_checks`` and counted in the same pass. A row that fails a check is kept whole, a repeated key with its occurrences.
    """
    path = f"{metadata_root.rstrip('/')}/fact_checks"
    agrees = category_agrees(F.col("dep_delay_min"), F.col("delay_category"), strict)
    failing = F.when(~agrees, F.struct(*fact.columns))
    by_key = fact.groupBy(key).agg(count_rows().alias("occurrences"), F.collect_list(failing).alias("wrong"))
    none = F.lit(None).cast(fact.schema)
    repeated = F.struct(F.lit("unique_flight_key").alias("check"), F.col(key).alias("key"), "occurrences", none.alias("row"))
    unknown = F.lit(None).cast("bigint").alias("occurrences")
    of_row = lambda row: F.struct(F.lit("delay_category").alias("check"), F.col(key).alias("key"), unknown, row.alias("row"))
    found = F.concat(F.filter(F.array(F.when(F.col("occurrences") > 1, repeated)), lambda f: f.isNotNull()), F.transform("wrong", of_row))
    failures = by_key.select(F.explode(found).alias("failure")).select("failure.*")
    seen = Observation()
    names = ("delay_category", "unique_flight_key")
    observed = failures.observe(seen, count_rows().alias("failures"), *[F.count_if(F.col("check") == name).alias(name) for name in names])
    observed.write.mode("overwrite").partitionBy("check").parquet(path)
    counts = seen.get
    return [graded(name, counts.get(name) or 0, f"{path}/check={name}") for name in names]


def check(failing: DataFrame, name: str, metadata_root: str | None = None, warn_over: int | None = None, error_over: int | None = None) -> CheckResult:
    """Count failing rows and grade them: ``error`` above ``error_over``, else ``warn`` above ``warn_over``.

    The limits are those of ``POLICY`` unless given. With ``metadata_root`` the failing rows are stored there whole, replacing
    what an earlier run left, and counted in the same pass; without it only the columns the check looks at are read.
    """
    warn, error = POLICY.get(name, (0, 0))
    warn, error = warn if warn_over is None else warn_over, error if error_over is None else error_over
    if metadata_root:
        failures, stored_at = store_failures(failing, metadata_root, name), failures_path(metadata_root, name)
    else:
        failures, stored_at = failing.count(), None
    status = "error" if failures > error else "warn" if failures > warn else "pass"
    return CheckResult(name, status, failures, stored_at)
