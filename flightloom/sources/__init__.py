"""Readers and writers."""

from .ledger import audit_ledger, date_counts, landed_files, read_ledger, refresh_ledger
from .pages import (
    LandingError,
    contract_failure,
    landed_dates,
    landing_audit,
    landing_contract,
    read_flight_pages,
    require_landed,
)
from .reference import accepted, load_reference, name_columns, read_reference, read_reference_csv, rejected
from .sinks import (
    failures_path,
    store_failures,
    write_bronze,
    write_mart,
    write_reference,
)
from .tables import partition_dates, read_bronze, read_dates, read_fact, scan_insert_date, scan_insert_dates

__all__ = [
    "LandingError",
    "accepted",
    "audit_ledger",
    "contract_failure",
    "date_counts",
    "failures_path",
    "landed_dates",
    "landed_files",
    "landing_audit",
    "landing_contract",
    "load_reference",
    "name_columns",
    "partition_dates",
    "read_bronze",
    "read_dates",
    "read_fact",
    "read_flight_pages",
    "read_ledger",
    "read_reference",
    "read_reference_csv",
    "refresh_ledger",
    "rejected",
    "require_landed",
    "scan_insert_date",
    "scan_insert_dates",
    "store_failures",
    "write_bronze",
    "write_mart",
    "write_reference",
]
