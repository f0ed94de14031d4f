"""Typed views over bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Dataset

# Staged flight column → SQL type. Column order is the staged table's.
STAGED_FLIGHT_TYPES = {
    "flight_date": "date",
    "flight_status": "string",
    "dep_airport": "string",
    "dep_iata": "string",
    "dep_scheduled": "timestamp_ntz",
    "dep_actual": "timestamp_ntz",
    "arr_airport": "string",
    "arr_iata": "string",
    "arr_scheduled": "timestamp_ntz",
    "arr_actual": "timestamp_ntz",
    "airline_iata": "string",
    "flight_number": "string",
    "flight_iata_full": "string",
    "dep_delay_min": "int",
    "arr_delay_min": "int",
    "dep_scheduled_ts": "timestamp_ntz",
    "arr_scheduled_ts": "timestamp_ntz",
    "ingestion_date": "date",
}


def flight_identity() -> Column:
    """Airline and number joined; unknown if either is. It replaces the provider's own identifier."""
    return F.concat(F.col("airline_iata"), F.col("flight_number"))


def stage_flights(bronze: DataFrame, keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Cast bronze flights to their types and keep the rows whose date is known.

    A value that cannot be cast becomes null, and a row thereby left without a date is found by ``reject_flights``.
    ``strict`` fails on the first bad value instead. ``keep`` names bronze columns to carry along, such as a tie-break.
    """
    columns = []
    for name, kind in STAGED_FLIGHT_TYPES.items():
        source = flight_identity() if name == "flight_iata_full" else F.col(name)
        columns.append((source.cast(kind) if strict else source.try_cast(kind)).alias(name))
    return bronze.select(*columns, *keep).where(F.col("flight_date").isNotNull())


def reject_flights(bronze: DataFrame) -> DataFrame:
    """Bronze rows that staging drops, with the reason."""
    reason = F.when(F.col("flight_date").isNull(), "missing flight_date").otherwise("bad flight_date")
    return bronze.where(F.col("flight_date").try_cast("date").isNull()).withColumn("reject_reason", reason)


def stage_reference(bronze: DataFrame, dataset: Dataset) -> DataFrame:
    """Rename and type one reference dataset. Text keeps its full length."""
    return bronze.select(*[F.col(raw).try_cast(kind).alias(name) for raw, kind, name in dataset.staged])
