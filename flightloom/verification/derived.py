"""Flight data derived from the given tables.

Nothing here is sampled: every event becomes a flight, every customer an airport, every order a route, and so on, so each
query's work grows with the tables. ``oracle`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TIE_BREAK = ["event_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


# Flight column → rule over an event, in dependency-free SQL expressions.
_BLOCK = "60 + user_id % 240"
_DEPARTS = "CASE WHEN event_id % 53 != 0 THEN CAST(date_trunc('minute', ts) AS timestamp_ntz) END"
_SECOND = "CAST(date_trunc('second', ts) AS timestamp_ntz)"
_DELAY = "CASE WHEN event_id % 11 != 0 THEN CAST(floor(value) % 90 - 25 AS int) END"
_AIRLINE = "CASE WHEN event_id % 97 != 0 THEN upper(substring(event_type, 1, 2)) END"
_NUMBER = "CAST(100 + user_id % 40 AS string)"
_STATUS = """CASE event_type WHEN 'view' THEN 'scheduled' WHEN 'click' THEN 'landed' WHEN 'purchase' THEN 'active'
             WHEN 'signup' THEN 'cancelled' ELSE 'diverted' END"""
FLIGHT_RULES = {
    "event_id": "event_id",
    "flight_date": "CAST(ts AS date)",
    "flight_status": _STATUS,
    "dep_airport": "concat('Airport A', user_id % 6)",
    "dep_iata": "concat('A', user_id % 6)",
    "dep_scheduled": _DEPARTS,
    "dep_actual": f"CASE WHEN event_id % 53 != 0 THEN timestampadd(MINUTE, {_DELAY}, {_SECOND}) END",
    "arr_airport": "concat('Airport B', user_id % 4)",
    "arr_iata": "concat('B', user_id % 4)",
    "arr_scheduled": f"timestampadd(MINUTE, {_BLOCK}, {_DEPARTS})",
    "arr_actual": f"""CASE WHEN event_id % 13 != 0
                      THEN timestampadd(SECOND, 3600 + 60 * (user_id % 240) + event_id % 60, {_SECOND}) END""",
    "airline_iata": _AIRLINE,
    "flight_number": _NUMBER,
    "flight_iata_full": f"{_AIRLINE} || {_NUMBER}",
    "dep_delay_min": _DELAY,
    "arr_delay_min": "CASE WHEN event_id % 13 != 0 THEN CAST(event_id % 31 - 10 AS int) END",
    "dep_scheduled_ts": _DEPARTS,
    "arr_scheduled_ts": f"timestampadd(MINUTE, {_BLOCK}, {_DEPARTS})",
    "ingestion_date": "date_add(CAST(ts AS date), CAST(event_id % 3 AS int))",
}


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed flight per event, with ``event_id`` as tie-break."""
    return table(spark, sf_dir, "events").selectExpr(*[f"{rule} AS {name}" for name, rule in FLIGHT_RULES.items()])


def batched_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flights, landed over three insert dates; the same flight can be in several of them."""
    batch = F.date_add(F.lit("2024-02-01").cast("date"), (F.col("event_id") % 3).cast("int"))
    return flights(spark, sf_dir).withColumn("insert_date", batch)


def _clock(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages as ``(insert_date, value)``: a hundred flights per document.

    Some documents are broken on purpose (error document, cut-off text, no pagination), and so are some cells (impossible or
    missing date, delay that is not a number). ``flight.icao`` carries the event id.
    """
    event_id = F.col("event_id")
    date = F.when(_every(43), F.lit(None)).when(_every(41), F.lit("2024-13-40")).otherwise(F.col("flight_date").cast("string"))
    late = F.when(_every(47), F.lit("n/a")).otherwise(F.col("dep_delay_min").cast("string"))

    def stop(prefix: str, delay: Column) -> Column:
        return F.struct(
            F.col(f"{prefix}_airport").alias("airport"),
            F.col(f"{prefix}_iata").alias("iata"),
            F.concat(F.lit("K"), f"{prefix}_iata").alias("icao"),
            _clock(f"{prefix}_scheduled").alias("scheduled"),
            _clock(f"{prefix}_actual").alias("actual"),
            delay.alias("delay"),
        )

    live = F.struct(
        (event_id % 180 - 90).cast("double").alias("latitude"),
        (event_id % 360 - 180).cast("double").alias("longitude"),
        (event_id % 400 * 100).cast("double").alias("altitude"),
        _every(4).alias("is_ground"),
    )
    document = F.struct(
        event_id,
        date.alias("flight_date"),
        "flight_status",
        stop("dep", late).alias("departure"),
        stop("arr", F.col("arr_delay_min")).alias("arrival"),
        F.struct(
            F.concat(F.lit("Airline "), "airline_iata").alias("name"),
            F.col("airline_iata").alias("iata"),
            F.concat("airline_iata", F.lit("X")).alias("icao"),
        ).alias("airline"),
        F.struct(
            F.col("flight_number").alias("number"),
            F.concat(F.lit("P"), "flight_number").alias("iata"),
            event_id.cast("string").alias("icao"),
        ).alias("flight"),
        F.when(_every(5), F.struct(F.concat(F.lit("N"), event_id).alias("registration"))).alias("aircraft"),
        F.when(_every(2), live).alias("live"),
    )
    page_no = F.col("page_no")
    pages = (
        flights(spark, sf_dir)
        .groupBy(F.floor(event_id / 100).alias("page_no"))
        .agg(F.array_sort(F.collect_list(document)).alias("data"))
    )
    pagination = F.struct(
        F.lit(100).alias("limit"),
        (page_no * 100).alias("offset"),
        F.array_size("data").alias("count"),
        (1500 + 100 * (page_no % 7)).alias("total"),
    )
    whole = F.to_json(F.struct(F.when(page_no % 29 != 7, pagination).alias("pagination"), "data"))
    cut = F.substring("whole", F.lit(1), F.floor(F.length("whole") / 2).cast("int"))
    value = (
        F.when(page_no % 19 == 3, F.lit('{"error": {"code": "rate_limit_reached", "message": "try later"}}'))
        .when(page_no % 23 == 5, cut)
        .otherwise(F.col("whole"))
    )
    insert_date = F.date_add(F.lit("2024-02-01").cast("date"), (page_no % 7).cast("int"))
    return pages.select("page_no", whole.alias("whole")).select(insert_date.alias("insert_date"), value.alias("value"))


def land_pages(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the pages the way they land: one document per line under one directory per insert date."""
    lines = page_lines(spark, sf_dir)
    lines.write.partitionBy("insert_date").mode("overwrite").option("compression", "none").format("text").save(root)
    return root


def reference_rows(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five reference datasets, in file column order."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    airports = table(spark, sf_dir, "customer").select(
        key.alias("airport_id"),
        F.concat(F.lit("Aéroport, "), "c_name").alias("name"),
        F.col("c_mktsegment").alias("city"),
        F.concat(F.lit("Country "), "c_nationkey").alias("country"),
        F.when(key % 9 != 0, F.concat(F.lit("C"), key % 100)).alias("iata"),
        F.concat(F.lit("KC"), key % 100).alias("icao"),
        (key % 180 - 90 + 0.125).alias("latitude"),
        (key % 360 - 180 + 0.5).alias("longitude"),
        (key % 9000).alias("altitude"),
        (key % 24 - 12 + 0.5).alias("timezone"),
        F.lit("E").alias("dst"),
        F.when(key % 5 != 0, F.concat(F.lit("Zone/"), key % 24)).alias("tz_database_time_zone"),
        F.lit("airport").alias("type"),
        F.lit("Derived").alias("source"),
    )
    supplier = F.col("s_suppkey")
    airlines = table(spark, sf_dir, "supplier").select(
        supplier.alias("airline_id"),
        F.concat("s_name", F.lit(' "Air", Inc')).alias("name"),
        F.when(supplier % 2 == 0, F.concat(F.lit("alias "), supplier)).alias("alias"),
        F.concat(F.lit("S"), supplier % 10).alias("iata"),
        F.concat(F.lit("SU"), supplier % 10).alias("icao"),
        F.upper("s_name").alias("callsign"),
        F.concat(F.lit("Country "), "s_nationkey").alias("country"),
        F.when(supplier % 3 == 0, "N").otherwise("Y").alias("active"),
    )
    order = F.col("o_orderkey")
    routes = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), order % 10).alias("airline"),
        F.when(order % 8 != 0, order % 100).alias("airline_id"),
        F.concat(F.lit("C"), F.col("o_custkey") % 100).alias("source_airport"),
        F.col("o_custkey").alias("source_airport_id"),
        F.concat(F.lit("C"), order % 100).alias("destination_airport"),
        order.alias("destination_airport_id"),
        F.when(F.col("o_orderstatus") == "F", "Y").alias("codeshare"),
        (order % 3).alias("stops"),
        F.concat_ws(" ", F.lit("738"), "o_orderpriority").alias("equipment"),
    )
    part = F.col("p_partkey")
    planes = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"),
        F.when(part % 4 != 0, F.concat(F.lit("P"), part % 100)).alias("iata_code"),
        F.concat(F.lit("PL"), part % 100).alias("icao_code"),
    )
    countries = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat_ws(", ", "n_name", "r_name").alias("name"),
        F.concat(F.lit("N"), F.col("n_nationkey") % 10).alias("iso_code"),
        F.when(F.col("n_regionkey") != 0, F.lit("DF")).alias("dafif_code"),
    )
    return {"airports": airports, "airlines": airlines, "routes": routes, "planes": planes, "countries": countries}


def broken_route_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route lines, some with a cell too few or too many."""
    order = F.col("o_orderkey")
    cells = [order % 10, order % 100, F.lit("C1"), F.col("o_custkey"), F.lit("C2"), order, F.lit(""), order % 3]
    complete = F.concat_ws(",", *cells, F.lit("738"))
    line = (
        F.when(order % 37 == 0, F.concat_ws(",", *cells))
        .when(order % 41 == 0, F.concat_ws(",", *cells, F.lit("738"), F.lit("extra")))
        .otherwise(complete)
    )
    return table(spark, sf_dir, "orders").select(line.alias("value"))
