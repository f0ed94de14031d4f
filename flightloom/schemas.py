"""Fixed schemas and column lists.

Every read names its schema: an inferred schema costs an extra pass over the input and changes with it (an
``aircraft`` that is null in every document would otherwise be read as a string).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

# The JSON field names of a page. Only the fields some operator reads are named, so the JSON parser skips the others. ``delay`` stays text: declared as
# a number, a quoted "7" would be lost.
_STOP = dict(airport=_S, iata=_S, icao=_S, scheduled=_S, actual=_S, delay=_S)

FLIGHT = _struct(
    flight_date=_S,
    flight_status=_S,
    departure=_struct(**_STOP),
    arrival=_struct(**_STOP),
    airline=_struct(name=_S, iata=_S, icao=_S),
    flight=_struct(number=_S, iata=_S, icao=_S),
    aircraft=_struct(registration=_S, iata=_S, icao=_S),
    live=_struct(latitude=_D, longitude=_D, altitude=_D, is_ground=T.BooleanType()),
)

# ``error`` is text: it may be an object or a plain string, and only its presence matters.
PAGE = T.StructType(
    [
        T.StructField("pagination", _struct(limit=_L, offset=_L, count=_L, total=_L)),
        T.StructField("data", T.ArrayType(FLIGHT)),
        T.StructField("error", _S),
        T.StructField(CORRUPT, _S),
    ]
)


class Dataset(NamedTuple):
    """One headerless reference file: its file name, column names, and the typed form of each staged column."""

    filename: str
    columns: tuple[str, ...]
    staged: tuple[tuple[str, str, str], ...]  # (raw name, SQL type, staged name)


# The file layout (names by position), and the staged names and types the downstream tables promise.
REFERENCE_DATASETS: dict[str, Dataset] = {
    "airports": Dataset(
        "airports.dat",
        ("airport_id", "name", "city", "country", "iata", "icao", "latitude", "longitude", "altitude", "timezone",
         "dst", "tz_database_time_zone", "type", "source"),
        (
            ("airport_id", "int", "airport_id"),
            ("name", "string", "airport_name"),
            ("city", "string", "airport_city"),
            ("country", "string", "airport_country"),
            ("iata", "string", "airport_iata_code"),
            ("icao", "string", "airport_icao_code"),
            ("latitude", "decimal(10,6)", "airport_latitude"),
            ("longitude", "decimal(10,6)", "airport_longitude"),
            ("altitude", "int", "airport_altitude_feet"),
            ("timezone", "decimal(4,2)", "airport_timezone"),
            ("dst", "string", "daylight_saving_time"),
            ("tz_database_time_zone", "string", "airport_tz_database_time_zone"),
            ("type", "string", "airport_type"),
            ("source", "string", "airport_source"),
        ),
    ),
    "airlines": Dataset(
        "airlines.dat",
        ("airline_id", "name", "alias", "iata", "icao", "callsign", "country", "active"),
        (
            ("airline_id", "int", "airline_id"),
            ("name", "string", "airline_name"),
            ("alias", "string", "airline_alias"),
            ("iata", "string", "iata_code"),
            ("icao", "string", "icao_code"),
            ("callsign", "string", "airline_callsign"),
            ("country", "string", "country"),
            ("active", "string", "is_active"),
        ),
    ),
    "routes": Dataset(
        "routes.dat",
        ("airline", "airline_id", "source_airport", "source_airport_id", "destination_airport",
         "destination_airport_id", "codeshare", "stops", "equipment"),
        (
            ("airline", "string", "airline_code"),
            ("airline_id", "int", "airline_id"),
            ("source_airport", "string", "source_airport_code"),
            ("source_airport_id", "int", "source_airport_id"),
            ("destination_airport", "string", "destination_airport_code"),
            ("destination_airport_id", "int", "destination_airport_id"),
            ("codeshare", "string", "codeshare"),
            ("stops", "smallint", "stops"),
            ("equipment", "string", "plane_type"),
        ),
    ),
    "planes": Dataset(
        "planes.dat",
        ("name", "iata_code", "icao_code"),
        (
            ("name", "string", "aircraft_name"),
            ("iata_code", "string", "iata_code"),
            ("icao_code", "string", "icao_code"),
        ),
    ),
    "countries": Dataset(
        "countries.dat",
        ("name", "iso_code", "dafif_code"),
        (
            ("name", "string", "country_name"),
            ("iso_code", "string", "country_iso_code"),
        ),
    ),
}

# The stored fact's columns after the run stamp and the key.
FACT_COLUMNS = (
    "insert_date_ci", "flight_key", "flight_iata_full", "flight_number", "airline_iata", "dep_iata", "arr_iata",
    "flight_date", "dep_scheduled", "dep_actual", "arr_scheduled", "arr_actual", "flight_status", "dep_delay_min",
    "arr_delay_min", "day_of_week", "day_of_week_name", "is_weekend", "dep_hour", "time_of_day",
    "scheduled_duration_min", "actual_duration_min", "duration_diff_min", "delay_category", "is_delayed_15",
    "avg_delay_7d",
)
