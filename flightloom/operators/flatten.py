"""Nested pages → one flat row per flight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Flat column ← path inside a flight document.
PATHS = {
    "flight_date": "flight_date",
    "flight_status": "flight_status",
    "dep_airport": "departure.airport",
    "dep_iata": "departure.iata",
    "dep_icao": "departure.icao",
    "dep_scheduled": "departure.scheduled",
    "dep_actual": "departure.actual",
    "dep_delay_min": "departure.delay",
    "arr_airport": "arrival.airport",
    "arr_iata": "arrival.iata",
    "arr_icao": "arrival.icao",
    "arr_scheduled": "arrival.scheduled",
    "arr_actual": "arrival.actual",
    "arr_delay_min": "arrival.delay",
    "airline_name": "airline.name",
    "airline_iata": "airline.iata",
    "airline_icao": "airline.icao",
    "flight_number": "flight.number",
    "flight_iata_full": "flight.iata",
    "flight_icao_full": "flight.icao",
    "aircraft_reg": "aircraft.registration",
    "aircraft_iata": "aircraft.iata",
    "aircraft_icao": "aircraft.icao",
    "live_latitude": "live.latitude",
    "live_longitude": "live.longitude",
    "live_altitude": "live.altitude",
    "live_is_ground": "live.is_ground",
}
CLOCKS = ("dep_scheduled", "dep_actual", "arr_scheduled", "arr_actual")
DELAYS = ("dep_delay_min", "arr_delay_min")


def whole_minutes(text: Column) -> Column:
    """A delay as whole minutes. JSON may carry 13, 13.0 or "13"; anything else is unknown."""
    return text.try_cast("double").try_cast("int")


def failed_casts(flight: str = "doc") -> Column:
    """Names of the columns whose cell is there but cannot be read as what it should be: the date, the clocks, the delays."""
    cell = lambda name: F.col(f"{flight}.{PATHS[name]}")
    read = {
        "flight_date": cell("flight_date").try_cast("date"),
        **{name: F.try_to_timestamp(cell(name)) for name in CLOCKS},
        **{name: whole_minutes(cell(name)) for name in DELAYS},
    }
    named = [F.when(cell(name).isNotNull() & value.isNull(), F.lit(name)) for name, value in read.items()]
    return F.filter(F.array(*named), lambda name: name.isNotNull())


def flatten_flights(pages: DataFrame, ingestion_date: str | None = None, audit: bool = False) -> DataFrame:
    """One row per element of each page's ``data``; pages without flights give no rows.

    Adds the four clock texts as timestamps, makes the delays whole minutes and stamps ``ingestion_date`` -- the given run
    date, or the page's own insert date, but never today's, so that a rerun gives the same rows. ``audit`` adds ``failed_casts``, the columns
    of each row that became null because their cell could not be read.
    """
    stamp = F.lit(ingestion_date) if ingestion_date else F.col("insert_date").cast("string")
    # An inner explode would also filter on the array below the parse, and so parse every page again for the filter.
    elements = pages.select("insert_date", F.posexplode_outer("page.data").alias("at", "doc"))
    flights = elements.where(F.col("at").isNotNull())
    flat = []
    for name, path in PATHS.items():
        value = F.col(f"doc.{path}")
        flat.append((whole_minutes(value) if name in DELAYS else value).alias(name))
    parsed = [F.try_to_timestamp(F.col(f"doc.{PATHS[c]}")).alias(f"{c}_ts") for c in CLOCKS]
    audited = [failed_casts().alias("failed_casts")] if audit else []
    return flights.select(*flat, *parsed, *audited, stamp.alias("ingestion_date"), "insert_date")
