"""The engine's steps, each a function from DataFrames to a DataFrame."""

from .backfill import missing_dates
from .bucketed import create_fact_table, table_path, upsert_table
from .flatten import flatten_flights
from .kpis import kpi_flights
from .quality import CheckResult, cast_failures, category_mismatches, check, check_fact, duplicate_keys, undated_flights
from .silver import carried_window, dedup_flights, incremental_window, keep_tails, rolling_route_delay, route_tails, silver_flights
from .staging import reject_flights, stage_flights, stage_reference
from .upsert import LeaseLost, UpsertDamaged, UpsertLocked, finish_upsert, leased, stage_upsert, upsert_fact

__all__ = [
    "CheckResult",
    "category_mismatches",
    "check",
    "dedup_flights",
    "duplicate_keys",
    "carried_window",
    "create_fact_table",
    "keep_tails",
    "route_tails",
    "table_path",
    "upsert_table",
    "cast_failures",
    "check_fact",
    "finish_upsert",
    "stage_upsert",
    "leased",
    "UpsertLocked",
    "UpsertDamaged",
    "LeaseLost",
    "flatten_flights",
    "incremental_window",
    "kpi_flights",
    "missing_dates",
    "reject_flights",
    "rolling_route_delay",
    "silver_flights",
    "stage_flights",
    "stage_reference",
    "undated_flights",
    "upsert_fact",
]
