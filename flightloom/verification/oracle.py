"""SQL that gives each registered query's expected result on the given tables, for DuckDB."""

from __future__ import annotations


def _with(ctes: list[tuple[str, str]], select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes) + "\n" + select


EVENTS = """
SELECT *,
       date_trunc('minute', ts) AS ts_minute,
       date_trunc('second', ts) AS ts_second,
       CASE WHEN event_id % 11 <> 0 THEN CAST(floor(value) % 90 - 25 AS INTEGER) END AS delay,
       CASE WHEN event_id % 97 <> 0 THEN upper(substr(event_type, 1, 2)) END AS airline,
       CAST(100 + user_id % 40 AS VARCHAR) AS number
FROM events
"""

FLIGHTS = """
SELECT event_id,
       CAST(ts AS DATE) AS flight_date,
       CASE event_type WHEN 'view' THEN 'scheduled' WHEN 'click' THEN 'landed' WHEN 'purchase' THEN 'active'
                       WHEN 'signup' THEN 'cancelled' ELSE 'diverted' END AS flight_status,
       'Airport A' || user_id % 6 AS dep_airport,
       'A' || user_id % 6 AS dep_iata,
       CASE WHEN event_id % 53 <> 0 THEN ts_minute END AS dep_scheduled,
       CASE WHEN event_id % 53 <> 0 THEN ts_second + to_minutes(delay) END AS dep_actual,
       'Airport B' || user_id % 4 AS arr_airport,
       'B' || user_id % 4 AS arr_iata,
       CASE WHEN event_id % 53 <> 0 THEN ts_minute + to_minutes(CAST(60 + user_id % 240 AS INTEGER)) END AS arr_scheduled,
       CASE WHEN event_id % 13 <> 0
            THEN ts_second + to_seconds(CAST(3600 + 60 * (user_id % 240) + event_id % 60 AS INTEGER)) END AS arr_actual,
       airline AS airline_iata,
       number AS flight_number,
       airline || number AS flight_iata_full,
       delay AS dep_delay_min,
       CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 31 - 10 AS INTEGER) END AS arr_delay_min,
       CASE WHEN event_id % 53 <> 0 THEN ts_minute END AS dep_scheduled_ts,
       CASE WHEN event_id % 53 <> 0 THEN ts_minute + to_minutes(CAST(60 + user_id % 240 AS INTEGER)) END AS arr_scheduled_ts,
       CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER) AS ingestion_date,
       DATE '2024-02-01' + CAST(event_id % 3 AS INTEGER) AS insert_date
FROM derived_events
"""

# The limits of the delay bands and of the parts of a day, and all column and answer names below.
CATEGORY_RULES = """CASE WHEN dep_delay_min IS NULL THEN 'unknown' WHEN dep_delay_min <= -15 THEN 'early'
       WHEN dep_delay_min <= 0 THEN 'ontime' WHEN dep_delay_min <= 15 THEN 'minor_delay'
       WHEN dep_delay_min <= 45 THEN 'moderate_delay' ELSE 'severe_delay' END"""

MEASURES = f"""
       CAST(dayofweek(flight_date) AS BIGINT) AS day_of_week,
       dayname(flight_date) AS day_of_week_name,
       coalesce(dayofweek(flight_date) IN (0, 6), FALSE) AS is_weekend,
       CAST(hour(dep_scheduled) AS BIGINT) AS dep_hour,
       CASE WHEN hour(dep_scheduled) BETWEEN 5 AND 11 THEN 'Morning'
            WHEN hour(dep_scheduled) BETWEEN 12 AND 16 THEN 'Afternoon'
            WHEN hour(dep_scheduled) BETWEEN 17 AND 21 THEN 'Evening'
            ELSE 'Night' END AS time_of_day,
       datediff('minute', dep_scheduled, arr_scheduled) AS scheduled_duration_min,
       datediff('minute', dep_actual, arr_actual) AS actual_duration_min,
       datediff('minute', dep_actual, arr_actual)
         - datediff('minute', dep_scheduled, arr_scheduled) AS duration_diff_min,
       {CATEGORY_RULES} AS delay_category,
       ifnull(dep_delay_min > 15, FALSE) AS is_delayed_15
"""

ROLLED = """
SELECT *, avg(dep_delay_min) OVER (
           PARTITION BY {batch} dep_iata, arr_iata ORDER BY flight_date NULLS LAST, event_id ROWS 6 PRECEDING) AS avg_delay_7d
FROM flights
"""

RANKED = """
SELECT *, row_number() OVER (
           PARTITION BY flight_iata_full, flight_date
           ORDER BY {batch} ingestion_date DESC NULLS LAST, event_id) AS place
FROM rolled
"""

FACT = f"""
SELECT {{stamp}} AS insert_date_ci,
       md5(coalesce(flight_iata_full, '_dbt_utils_surrogate_key_null_') || '-' || CAST(flight_date AS VARCHAR)) AS flight_key,
       flight_iata_full, flight_number, airline_iata, dep_iata, arr_iata, flight_date, dep_scheduled, dep_actual,
       arr_scheduled, arr_actual, flight_status, dep_delay_min, arr_delay_min,
       {MEASURES},
       avg_delay_7d
FROM ranked WHERE place = 1
"""

RUN_DATE = "DATE '2024-02-01'"

TO_FLIGHTS = [("derived_events", EVENTS), ("flights", FLIGHTS)]
TO_ROLLED = [*TO_FLIGHTS, ("rolled", ROLLED.format(batch=""))]
TO_RANKED = [*TO_ROLLED, ("ranked", RANKED.format(batch=""))]
TO_FACT = [*TO_RANKED, ("fact", FACT.format(stamp=RUN_DATE))]
TO_BATCH_FACT = [
    *TO_FLIGHTS,
    ("rolled", ROLLED.format(batch="insert_date,")),
    ("ranked", RANKED.format(batch="insert_date DESC,")),
    ("fact", FACT.format(stamp="insert_date")),
]

STAGED_COLUMNS = """flight_date, flight_status, dep_airport, dep_iata, dep_scheduled, dep_actual, arr_airport, arr_iata,
       arr_scheduled, arr_actual, airline_iata, flight_number, flight_iata_full, dep_delay_min, arr_delay_min,
       dep_scheduled_ts, arr_scheduled_ts, ingestion_date"""

ROUTE_DAILY = """
SELECT flight_date, dep_iata || '-' || arr_iata AS route, dep_iata, arr_iata, airline_iata,
       count(*) AS total_flights,
       round(avg(dep_delay_min), 2) AS avg_dep_delay_min,
       round(100.0 * count(*) FILTER (delay_category IN ('moderate_delay', 'severe_delay')) / count(*), 2) AS delayed_pct
FROM fact GROUP BY ALL
"""

HEATMAP = """
SELECT day_of_week, day_of_week_name, dep_hour,
       count(*) AS total_flights,
       round(avg(dep_delay_min), 2) AS avg_delay_min,
       round(avg(arr_delay_min), 2) AS avg_arr_delay_min,
       count(*) FILTER (is_delayed_15) AS delayed_flights,
       round(100.0 * count(*) FILTER (is_delayed_15) / count(*), 2) AS delayed_pct
FROM fact WHERE dep_hour IS NOT NULL GROUP BY ALL
"""

WEEKS = """
SELECT CAST(date_trunc('week', flight_date) AS DATE) AS week_start,
       count(*) AS total_flights,
       round(avg(dep_delay_min), 2) AS avg_delay_min,
       round(avg(arr_delay_min), 2) AS avg_arr_delay_min,
       count(*) FILTER (delay_category IN ('ontime', 'early')) AS ontime_flights,
       count(*) FILTER (delay_category = 'severe_delay') AS severe_delay_flights,
       round(100.0 * count(*) FILTER (delay_category IN ('ontime', 'early')) / count(*), 2) AS ontime_pct,
       round(100.0 * count(*) FILTER (delay_category = 'severe_delay') / count(*), 2) AS severe_pct
FROM fact GROUP BY ALL
"""

COMPARED = """
SELECT this.week_start, this.total_flights, this.avg_delay_min, this.avg_arr_delay_min, this.ontime_pct, this.severe_pct,
       lag(total_flights) OVER w AS prev_week_flights,
       lag(avg_delay_min) OVER w AS prev_week_avg_delay,
       lag(ontime_pct) OVER w AS prev_week_ontime_pct,
       lag(severe_pct) OVER w AS prev_week_severe_pct,
       total_flights - ifnull(lag(total_flights) OVER w, 0) AS flights_change,
       round(avg_delay_min - ifnull(lag(avg_delay_min) OVER w, 0), 2) AS delay_change,
       round(ontime_pct - ifnull(lag(ontime_pct) OVER w, 0), 2) AS ontime_pct_change,
       round(severe_pct - ifnull(lag(severe_pct) OVER w, 0), 2) AS severe_pct_change
FROM weeks AS this WINDOW w AS (ORDER BY week_start NULLS LAST)
"""

TO_ROUTE_DAILY = [*TO_FACT, ("route_daily", ROUTE_DAILY)]
TO_HEATMAP = [*TO_FACT, ("delay_heatmap", HEATMAP)]
TO_WEEKS = [*TO_FACT, ("weeks", WEEKS)]
TO_COMPARED = [*TO_WEEKS, ("weekly_comparison", COMPARED)]

HOUR_COLUMNS = ", ".join(f'max(avg_delay_min) FILTER (dep_hour = {h}) AS "{h}"' for h in range(24))

# Landed pages: a hundred events each, of which some are error documents or cut off.
PAGED = """
SELECT *, event_id // 100 AS page_no, DATE '2024-02-01' + CAST((event_id // 100) % 7 AS INTEGER) AS landed_on,
       CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '2024-13-40'
            ELSE CAST(flight_date AS VARCHAR) END AS date_text,
       CASE WHEN event_id % 47 <> 0 THEN dep_delay_min END AS landed_delay,
       (event_id // 100) % 19 = 3 AS is_error,
       (event_id // 100) % 19 <> 3 AND (event_id // 100) % 23 = 5 AS is_cut
FROM flights
"""
PAGES = """
SELECT page_no, any_value(landed_on) AS insert_date, count(*) AS flights, any_value(is_error) AS is_error,
       any_value(is_cut) AS is_cut, page_no % 29 <> 7 AND NOT any_value(is_error) AND NOT any_value(is_cut) AS is_paginated,
       1500 + 100 * (page_no % 7) AS total
FROM paged GROUP BY page_no
"""
TO_PAGED = [*TO_FLIGHTS, ("paged", PAGED)]
TO_PAGES = [*TO_PAGED, ("pages_landed", PAGES)]

BRONZE = """
SELECT date_text AS flight_date, flight_status, dep_airport, dep_iata, 'K' || dep_iata AS dep_icao,
       strftime(dep_scheduled, '%Y-%m-%dT%H:%M:%S+00:00') AS dep_scheduled,
       strftime(dep_actual, '%Y-%m-%dT%H:%M:%S+00:00') AS dep_actual,
       landed_delay AS dep_delay_min, arr_airport, arr_iata, 'K' || arr_iata AS arr_icao,
       strftime(arr_scheduled, '%Y-%m-%dT%H:%M:%S+00:00') AS arr_scheduled,
       strftime(arr_actual, '%Y-%m-%dT%H:%M:%S+00:00') AS arr_actual,
       arr_delay_min, 'Airline ' || airline_iata AS airline_name, airline_iata, airline_iata || 'X' AS airline_icao,
       flight_number, 'P' || flight_number AS flight_iata_full, CAST(event_id AS VARCHAR) AS flight_icao_full,
       CASE WHEN event_id % 5 = 0 THEN 'N' || event_id END AS aircraft_reg,
       CAST(NULL AS VARCHAR) AS aircraft_iata, CAST(NULL AS VARCHAR) AS aircraft_icao,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 180 - 90 AS DOUBLE) END AS live_latitude,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 360 - 180 AS DOUBLE) END AS live_longitude,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 400 * 100 AS DOUBLE) END AS live_altitude,
       CASE WHEN event_id % 2 = 0 THEN event_id % 4 = 0 END AS live_is_ground,
       dep_scheduled AS dep_scheduled_ts, dep_actual AS dep_actual_ts,
       arr_scheduled AS arr_scheduled_ts, arr_actual AS arr_actual_ts,
       CAST(landed_on AS VARCHAR) AS ingestion_date, landed_on AS insert_date
FROM paged WHERE NOT is_error AND NOT is_cut
"""

LANDED_STAGED = """
SELECT CAST(event_id AS VARCHAR) AS flight_icao_full, flight_date, flight_status, dep_airport, dep_iata, dep_scheduled,
       dep_actual, arr_airport, arr_iata, arr_scheduled, arr_actual, airline_iata, flight_number, flight_iata_full,
       landed_delay AS dep_delay_min, arr_delay_min, dep_scheduled_ts, arr_scheduled_ts, landed_on AS ingestion_date
FROM paged WHERE NOT is_error AND NOT is_cut AND try_cast(date_text AS DATE) IS NOT NULL
"""

# The landed flights as the daily run stores them: batches by landing date, ties in the order of the identifier's text.
TO_RUN_FACT = [
    *TO_PAGED,
    ("landed", LANDED_STAGED),
    (
        "rolled",
        """
        SELECT *, avg(dep_delay_min) OVER (PARTITION BY ingestion_date, dep_iata, arr_iata
                                           ORDER BY flight_date, flight_icao_full ROWS 6 PRECEDING) AS avg_delay_7d
        FROM landed
        """,
    ),
    (
        "ranked",
        """
        SELECT *, row_number() OVER (PARTITION BY flight_iata_full, flight_date
                                     ORDER BY ingestion_date DESC, flight_icao_full) AS place
        FROM rolled
        """,
    ),
    ("fact", FACT.format(stamp="ingestion_date")),
]

UNDATED = """
SELECT CAST(event_id AS VARCHAR) AS flight_icao_full, date_text AS flight_date
FROM paged WHERE NOT is_error AND NOT is_cut AND try_cast(date_text AS DATE) IS NULL
"""

RECATEGORISED = f"""
SELECT event_id, dep_delay_min,
       CASE WHEN event_id % 17 = 0 THEN 'bogus' WHEN event_id % 19 = 0 THEN 'ontime' ELSE delay_category END AS delay_category
FROM (SELECT *, {MEASURES} FROM flights)
"""
TO_RECATEGORISED = [*TO_FLIGHTS, ("recategorised", RECATEGORISED)]

MISMATCHED = f"""
SELECT * FROM recategorised WHERE delay_category <> ({CATEGORY_RULES})
   AND NOT (dep_delay_min IS NULL AND delay_category IN ('severe_delay', 'moderate_delay', 'minor_delay', 'ontime', 'early'))
"""
REPEATED = "SELECT flight_key, count(*) AS occurrences FROM fact GROUP BY 1 HAVING count(*) > 1"

# A new batch (flights from 20 January on) whose frames reach back a week into the stored fact (the flights before).
LOOKBACK = [
    *TO_FLIGHTS,
    ("rolled", ROLLED.format(batch="").replace("FROM flights", "FROM flights WHERE flight_date < DATE '2024-01-20'")),
    ("ranked", RANKED.format(batch="")),
    ("stored", FACT.format(stamp=RUN_DATE)),
    (
        "together",
        """
        SELECT dep_iata, arr_iata, flight_date, dep_delay_min, 0 AS in_batch, flight_key, NULL AS event_id
        FROM stored WHERE flight_date >= (SELECT max(flight_date) - 7 FROM stored)
        UNION ALL BY NAME
        SELECT *, 1 AS in_batch, NULL AS flight_key FROM flights WHERE flight_date >= DATE '2024-01-20'
        """,
    ),
]

ROUTE_LINES = """
SELECT o_orderkey, o_custkey, concat_ws(',', o_orderkey % 10, o_orderkey % 100, 'C1', o_custkey, 'C2', o_orderkey, '', o_orderkey % 3)
         || CASE WHEN o_orderkey % 37 = 0 THEN '' WHEN o_orderkey % 41 = 0 THEN ',738,extra' ELSE ',738' END AS line
FROM orders
"""


def _question(ctes: list[tuple[str, str]], select: str) -> str:
    return _with(ctes, select)


ORACLE: dict[str, str] = {
    "kpi_flights": _with(
        TO_FLIGHTS, f"SELECT event_id, {STAGED_COLUMNS}, {MEASURES}, dep_delay_min AS avg_delay FROM flights"
    ),
    "rolling_route_delay": _with(
        TO_ROLLED, "SELECT event_id, dep_iata, arr_iata, flight_date, dep_delay_min, avg_delay_7d FROM rolled"
    ),
    "dedup_flights": _with(TO_RANKED, f"SELECT event_id, {STAGED_COLUMNS} FROM ranked WHERE place = 1"),
    "surrogate_key": _with(
        TO_FLIGHTS,
        """SELECT event_id, md5(coalesce(flight_iata_full, '_dbt_utils_surrogate_key_null_') || '-'
                  || CAST(flight_date AS VARCHAR)) AS flight_key FROM flights""",
    ),
    "fct_flights": _with(TO_FACT, "SELECT * FROM fact"),
    "route_daily": _with(TO_ROUTE_DAILY, "SELECT * FROM route_daily"),
    "delay_heatmap": _with(TO_HEATMAP, "SELECT * FROM delay_heatmap"),
    "weekly_metrics": _with(TO_WEEKS, "SELECT * FROM weeks"),
    "weekly_comparison": _with(TO_COMPARED, "SELECT * FROM weekly_comparison"),
    # saved questions
    "k_flights_by_date": _question(
        TO_FACT, "SELECT flight_date, count(*) AS total_flights FROM fact GROUP BY ALL ORDER BY 1"
    ),
    "k_delay_category": _question(
        TO_FACT, 'SELECT delay_category, count(*) AS "count" FROM fact GROUP BY ALL ORDER BY 2 DESC, 1'
    ),
    "k_time_of_day": _question(
        TO_FACT,
        """SELECT time_of_day, round(avg(dep_delay_min), 2) AS avg_delay_min FROM fact
           WHERE dep_delay_min IS NOT NULL GROUP BY time_of_day
           ORDER BY CASE time_of_day WHEN 'Morning' THEN 1 WHEN 'Afternoon' THEN 2 WHEN 'Evening' THEN 3 ELSE 4 END""",
    ),
    "k_top_routes": _question(
        TO_ROUTE_DAILY,
        """SELECT route, round(avg(delayed_pct), 2) AS avg_delayed_pct, CAST(sum(total_flights) AS BIGINT) AS total_flights
           FROM route_daily GROUP BY route HAVING sum(total_flights) >= 5 ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
    "k_airlines": _question(
        TO_FACT,
        """SELECT airline_iata, count(*) AS total_flights FROM fact WHERE airline_iata IS NOT NULL
           GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 15""",
    ),
    "k_daily_trend": _question(
        TO_FACT,
        """SELECT flight_date, round(avg(dep_delay_min), 2) AS avg_delay_min, round(avg(avg_delay_7d), 2) AS rolling_avg_7d
           FROM fact WHERE dep_delay_min IS NOT NULL GROUP BY ALL ORDER BY 1""",
    ),
    "k_weekend": _question(
        TO_FACT,
        """SELECT if(is_weekend, 'Weekend', 'Weekday') AS day_type, count(*) AS total_flights,
                  round(avg(dep_delay_min), 2) AS avg_delay_min,
                  round(100.0 * count(*) FILTER (is_delayed_15) / count(*), 2) AS delayed_pct
           FROM fact GROUP BY is_weekend""",
    ),
    "k_total": _question(TO_FACT, "SELECT count(*) AS total FROM fact"),
    "k_ontime": _question(
        TO_FACT,
        """SELECT round(100.0 * count(*) FILTER (delay_category IN ('ontime', 'early')) / count(*), 1) AS ontime_pct
           FROM fact""",
    ),
    "k_avg_delay": _question(TO_FACT, "SELECT round(avg(dep_delay_min), 1) AS avg_delay FROM fact"),
    "k_hours": _question(
        TO_FACT,
        """SELECT CAST(dep_hour AS INTEGER) AS "hour", count(*) AS flights FROM fact WHERE dep_hour IS NOT NULL
           GROUP BY ALL ORDER BY 1""",
    ),
    "k_airports": _question(
        TO_FACT, "SELECT dep_iata, count(*) AS flights FROM fact GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 10"
    ),
    "k_severe": _question(
        TO_FACT,
        "SELECT round(100.0 * count(*) FILTER (delay_category = 'severe_delay') / count(*), 1) AS severe_pct FROM fact",
    ),
    "k_heatmap": _question(
        TO_HEATMAP,
        """SELECT day_of_week_name AS "Day", dep_hour AS "Hour", avg_delay_min AS "Avg Delay (min)",
                  total_flights AS "Flights", delayed_pct AS "Delayed %"
           FROM delay_heatmap ORDER BY day_of_week, dep_hour""",
    ),
    "k_heatmap_pivot": _question(
        TO_HEATMAP,
        f'SELECT day_of_week_name AS "Day", {HOUR_COLUMNS} FROM delay_heatmap GROUP BY day_of_week, day_of_week_name',
    ),
    "k_category_trend": _question(
        TO_FACT, 'SELECT flight_date, delay_category, count(*) AS "count" FROM fact GROUP BY ALL ORDER BY 1, 2'
    ),
    "k_route_table": _question(
        TO_ROUTE_DAILY,
        """SELECT route AS "Route", CAST(sum(total_flights) AS BIGINT) AS "Total Flights",
                  round(avg(avg_dep_delay_min), 1) AS "Avg Delay (min)", round(100 - avg(delayed_pct), 1) AS "On-Time %",
                  round(avg(delayed_pct), 1) AS "Delayed %"
           FROM route_daily GROUP BY route HAVING sum(total_flights) >= 3 ORDER BY 2 DESC, 1 LIMIT 15""",
    ),
    "k_weekly": _question(
        TO_COMPARED,
        """SELECT week_start AS "Week", total_flights AS "Flights", avg_delay_min AS "Avg Delay", ontime_pct AS "On-Time %"
           FROM weekly_comparison ORDER BY 1""",
    ),
    "k_worst_route": _question(
        TO_ROUTE_DAILY,
        """SELECT route FROM route_daily GROUP BY route HAVING sum(total_flights) >= 3
           ORDER BY round(avg(delayed_pct), 6) DESC, route LIMIT 1""",
    ),
    # landing
    "bronze_flights": _with(TO_PAGED, BRONZE),
    "landed_flights": _with(TO_PAGED, LANDED_STAGED),
    "landing_contract": _with(
        TO_PAGES,
        """SELECT count(*) AS pages, count(*) FILTER (is_cut) AS corrupt_pages, count(*) FILTER (is_error) AS error_pages,
                  count(*) FILTER (NOT is_error AND NOT is_cut) AS data_pages FROM pages_landed""",
    ),
    "landing_audit": _with(
        TO_PAGES,
        """SELECT insert_date, count(*) AS pages_landed,
                  CAST(coalesce(sum(flights) FILTER (NOT is_error AND NOT is_cut), 0) AS BIGINT) AS flights,
                  coalesce(max(total) FILTER (is_paginated), 0) AS reported_total,
                  CAST(least(20, greatest(1, ceil(coalesce(max(total) FILTER (is_paginated), 0) / 100.0))) AS BIGINT)
                    AS expected_pages,
                  count(*) FILTER (is_error) AS error_pages, count(*) FILTER (is_cut) AS corrupt_pages,
                  count(*) FILTER (NOT is_paginated) AS unpaginated_pages,
                  count(*) >= least(20, greatest(1, ceil(coalesce(max(total) FILTER (is_paginated), 0) / 100.0)))
                    AS complete
           FROM pages_landed GROUP BY insert_date""",
    ),
    "missing_dates": _with(
        TO_PAGES,
        """SELECT CAST(day AS DATE) AS insert_date
           FROM generate_series(TIMESTAMP '2024-01-25', TIMESTAMP '2024-02-15', INTERVAL 1 DAY) AS calendar(day)
           WHERE CAST(day AS DATE) NOT IN (SELECT insert_date FROM pages_landed)""",
    ),
    "scan_insert_date": _with(
        TO_PAGED,
        """SELECT CAST(event_id AS VARCHAR) AS flight_icao_full, date_text AS flight_date, dep_iata, arr_iata,
                  landed_delay AS dep_delay_min, landed_on AS insert_date
           FROM paged WHERE NOT is_error AND NOT is_cut AND landed_on = DATE '2024-02-05'""",
    ),
    "reference_rows_written": """
        SELECT 'airports' AS dataset, count(*) AS rows FROM customer UNION ALL SELECT 'airlines', count(*) FROM supplier
        UNION ALL SELECT 'routes', count(*) FROM orders UNION ALL SELECT 'planes', count(*) FROM part
        UNION ALL SELECT 'countries', count(*) FROM nation""",
    "flight_rejects": _with(
        [*TO_PAGED, ("undated", UNDATED)],
        """SELECT *, CASE WHEN flight_date IS NULL THEN 'missing flight_date' ELSE 'bad flight_date' END AS reject_reason
           FROM undated""",
    ),
    "reference_rejects": _with(
        [("route_lines", ROUTE_LINES)],
        """SELECT CAST(o_orderkey % 10 AS VARCHAR) AS first_cell, line FROM route_lines
           WHERE o_orderkey % 37 = 0 OR o_orderkey % 41 = 0""",
    ),
    "reference_accepted": _with(
        [("route_lines", ROUTE_LINES)],
        """SELECT CAST(o_orderkey % 10 AS VARCHAR) AS airline_code, CAST(o_orderkey % 100 AS INTEGER) AS airline_id,
                  'C1' AS source_airport_code, CAST(o_custkey AS INTEGER) AS source_airport_id, 'C2' AS destination_airport_code,
                  CAST(o_orderkey AS INTEGER) AS destination_airport_id, CAST(NULL AS VARCHAR) AS codeshare,
                  CAST(o_orderkey % 3 AS SMALLINT) AS stops, '738' AS plane_type
           FROM route_lines WHERE NOT (o_orderkey % 37 = 0 OR o_orderkey % 41 = 0)""",
    ),
    "reference_load": """
        SELECT 'airports' AS dataset, count(*) AS rows, 0::BIGINT AS rejects FROM customer
        UNION ALL SELECT 'airlines', count(*), 0 FROM supplier
        UNION ALL SELECT 'routes', count(*) FILTER (NOT (o_orderkey % 37 = 0 OR o_orderkey % 41 = 0)),
                         count(*) FILTER (o_orderkey % 37 = 0 OR o_orderkey % 41 = 0) FROM orders
        UNION ALL SELECT 'planes', count(*), 0 FROM part UNION ALL SELECT 'countries', count(*), 0 FROM nation""",
    "dim_airports": """
        SELECT CAST(c_custkey AS INTEGER) AS airport_id, 'Aéroport, ' || c_name AS airport_name,
               c_mktsegment AS airport_city, 'Country ' || c_nationkey AS airport_country,
               CASE WHEN c_custkey % 9 <> 0 THEN 'C' || c_custkey % 100 END AS airport_iata_code,
               'KC' || c_custkey % 100 AS airport_icao_code,
               CAST(c_custkey % 180 - 90 + 0.125 AS DECIMAL(10, 6)) AS airport_latitude,
               CAST(c_custkey % 360 - 180 + 0.5 AS DECIMAL(10, 6)) AS airport_longitude,
               CAST(c_custkey % 9000 AS INTEGER) AS airport_altitude_feet,
               CAST(c_custkey % 24 - 12 + 0.5 AS DECIMAL(4, 2)) AS airport_timezone,
               'E' AS daylight_saving_time,
               CASE WHEN c_custkey % 5 <> 0 THEN 'Zone/' || c_custkey % 24 END AS airport_tz_database_time_zone,
               'airport' AS airport_type, 'Derived' AS airport_source
        FROM customer""",
    "dim_airlines": """
        SELECT CAST(s_suppkey AS INTEGER) AS airline_id, s_name || ' "Air", Inc' AS airline_name,
               CASE WHEN s_suppkey % 2 = 0 THEN 'alias ' || s_suppkey END AS airline_alias,
               'S' || s_suppkey % 10 AS iata_code, 'SU' || s_suppkey % 10 AS icao_code,
               upper(s_name) AS airline_callsign, 'Country ' || s_nationkey AS country,
               CASE WHEN s_suppkey % 3 = 0 THEN 'N' ELSE 'Y' END AS is_active
        FROM supplier""",
    "dim_routes": """
        SELECT 'S' || o_orderkey % 10 AS airline_code,
               CAST(CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 100 END AS INTEGER) AS airline_id,
               'C' || o_custkey % 100 AS source_airport_code, CAST(o_custkey AS INTEGER) AS source_airport_id,
               'C' || o_orderkey % 100 AS destination_airport_code, CAST(o_orderkey AS INTEGER) AS destination_airport_id,
               CASE WHEN o_orderstatus = 'F' THEN 'Y' END AS codeshare, CAST(o_orderkey % 3 AS SMALLINT) AS stops,
               '738 ' || o_orderpriority AS plane_type
        FROM orders""",
    "dim_planes": """
        SELECT p_name AS aircraft_name, CASE WHEN p_partkey % 4 <> 0 THEN 'P' || p_partkey % 100 END AS iata_code,
               'PL' || p_partkey % 100 AS icao_code
        FROM part""",
    "dim_countries": """
        SELECT n_name || ', ' || r_name AS country_name, 'N' || n_nationkey % 10 AS country_iso_code
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    # stored tables
    "upsert_fact": _with(TO_BATCH_FACT, "SELECT * FROM fact"),
    "incremental_window": _with(
        LOOKBACK,
        f"""SELECT {STAGED_COLUMNS.replace("dep_airport, ", "").replace("arr_airport, ", "")
                    .replace("dep_scheduled_ts, arr_scheduled_ts, ", "")}, event_id, avg_delay_7d
            FROM (SELECT *, row_number() OVER (PARTITION BY flight_iata_full, flight_date
                                               ORDER BY ingestion_date DESC, event_id) AS place
                  FROM (SELECT *, avg(dep_delay_min) OVER (PARTITION BY dep_iata, arr_iata
                                                           ORDER BY flight_date, in_batch, flight_key, event_id ROWS 6 PRECEDING)
                                    AS avg_delay_7d
                        FROM together)
                  WHERE in_batch = 1)
            WHERE place = 1""",
    ),
    "daily_run_fact": _with(TO_RUN_FACT, "SELECT * FROM fact"),
    "daily_run_route_daily": _with([*TO_RUN_FACT, ("route_daily", ROUTE_DAILY)], "SELECT * FROM route_daily"),
    "daily_run_heatmap": _with([*TO_RUN_FACT, ("delay_heatmap", HEATMAP)], "SELECT * FROM delay_heatmap"),
    "daily_run_weekly": _with([*TO_RUN_FACT, ("weeks", WEEKS), ("weekly_comparison", COMPARED)], "SELECT * FROM weekly_comparison"),
    "daily_run_checks": _with(
        [
            *TO_PAGED,
            ("runs", "SELECT * FROM (VALUES (1, DATE '2024-02-01', DATE '2024-02-04'), (2, DATE '2024-02-05', DATE '2024-02-07')) v(run, lo, hi)"),
            ("dated", """SELECT run, count(*) FILTER (NOT is_error AND NOT is_cut AND try_cast(date_text AS DATE) IS NULL) AS failures
                         FROM runs LEFT JOIN paged ON landed_on BETWEEN lo AND hi GROUP BY run"""),
        ],
        """SELECT run, 'flight_date_not_null' AS "check", failures, CASE WHEN failures > 0 THEN 'error' ELSE 'pass' END AS status FROM dated
           UNION ALL SELECT run, 'delay_category', 0, 'pass' FROM runs UNION ALL SELECT run, 'unique_flight_key', 0, 'pass' FROM runs""",
    ),
    # checks
    "check_undated": _with(TO_PAGED, UNDATED),
    "check_unique_key": _with(TO_FACT, REPEATED),
    "duplicate_keys": _with(
        TO_FLIGHTS,
        """SELECT md5(coalesce(flight_iata_full, '_dbt_utils_surrogate_key_null_') || '-'
                  || CAST(flight_date AS VARCHAR)) AS flight_key, count(*) AS occurrences
           FROM flights GROUP BY 1 HAVING count(*) > 1""",
    ),
    "check_category": _with(TO_RECATEGORISED, MISMATCHED),
    "check_results": _with(
        [
            *TO_FACT,
            ("paged", PAGED),
            ("undated", UNDATED),
            ("repeated", REPEATED),
            ("recategorised", RECATEGORISED),
            ("mismatched", MISMATCHED),
            (
                "counted",
                """SELECT 'flight_date_not_null' AS "check", count(*) AS failures, 0 AS warn_over, 0 AS error_over FROM undated
                   UNION ALL SELECT 'unique_flight_key', count(*), 0, 0 FROM repeated
                   UNION ALL SELECT 'delay_category', count(*), 5, 0 FROM mismatched""",
            ),
        ],
        """SELECT "check", failures, failures AS stored,
                  CASE WHEN failures > error_over THEN 'error' WHEN failures > warn_over THEN 'warn' ELSE 'pass' END AS status
           FROM counted""",
    ),
    "check_category_strict": _with(
        TO_RECATEGORISED, f"SELECT * FROM recategorised WHERE delay_category IS DISTINCT FROM ({CATEGORY_RULES})"
    ),
}
# The same results by another way.
ORACLE["rolling_route_delay_cut"] = ORACLE["rolling_route_delay"]
ORACLE["rolling_route_delay_text_key"] = _with(
    [*TO_FLIGHTS, ("rolled", ROLLED.format(batch="").replace("event_id ROWS", "'AAL' || event_id ROWS"))],
    "SELECT event_id, dep_iata, arr_iata, flight_date, dep_delay_min, avg_delay_7d FROM rolled",
)
ORACLE["daily_run_fact_cut"] = ORACLE["daily_run_fact"]
ORACLE["fct_flights_cut"] = ORACLE["fct_flights"]
ORACLE["backfill"] = ORACLE["upsert_fact"]
ORACLE["stored_failures"] = ORACLE["check_category"]

ORACLE |= {
    # The same rows as another query's, reached in another way.
    "upsert_fact_recovered": ORACLE["upsert_fact"],
    "upsert_fact_bucketed": ORACLE["upsert_fact"],
    "carried_window": ORACLE["incremental_window"],
    "ledger_audit": ORACLE["landing_audit"],
    "complete_dates": f"""SELECT insert_date, 'complete' AS status, pages_landed AS pages, expected_pages AS expected
                          FROM ({ORACLE["landing_audit"]}) WHERE complete""",
    "named_columns": """
        SELECT 'S' || o_orderkey % 10 AS airline, CASE WHEN o_orderkey % 8 != 0 THEN o_orderkey % 100 END AS airline_id, 'C' || o_custkey % 100 AS source_airport,
               o_orderkey AS destination_airport_id, o_orderkey % 3 AS stops, '738 ' || o_orderpriority AS equipment
        FROM orders""",
    # The place of each row in the order the answer is shown in.
    **{
        f"{name}_order": f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place, * FROM ({ORACLE[name].rstrip().rstrip(';')})"
        for name, order in {
            "k_flights_by_date": "flight_date",
            "k_delay_category": '"count" DESC, delay_category',
            "k_time_of_day": "list_position(['Morning', 'Afternoon', 'Evening', 'Night'], time_of_day)",
        }.items()
    },
}

# fmt: off
_SUMMARY = """flight_date, '{grain}' AS grain, {value} AS value, count(*) AS flights, CAST(sum(dep_delay_min) AS BIGINT) AS dep_delay, count(dep_delay_min) AS dep_known,
              count(*) FILTER (is_delayed_15) AS late, count(*) FILTER (delay_category IN ('ontime', 'early')) AS ontime,
              count(*) FILTER (delay_category = 'severe_delay') AS severe"""
_GRAINS = {"date": "CAST(NULL AS VARCHAR)", "category": "delay_category", "time_of_day": "time_of_day", "airline": "airline_iata", "airport": "dep_iata",
           "hour": "CAST(dep_hour AS VARCHAR)"}
# fmt: on

ORACLE |= {
    **{
        f"{name}_summary": ORACLE[name]
        for name in ("k_flights_by_date", "k_delay_category", "k_time_of_day", "k_airlines", "k_weekend", "k_total", "k_ontime", "k_avg_delay", "k_hours",
                     "k_airports", "k_severe", "k_category_trend")
    },
    "stored_summary": _with(
        TO_BATCH_FACT, " UNION ALL ".join(f"SELECT {_SUMMARY.format(grain=g, value=v)} FROM fact GROUP BY flight_date, {v}" for g, v in _GRAINS.items())
    ),
    "view_stg_flights": _with([*TO_PAGED, ("landed", LANDED_STAGED)], "SELECT * EXCLUDE (flight_icao_full), ingestion_date AS insert_date FROM landed WHERE ingestion_date = DATE '2024-02-05'"),
    "view_stg_routes": """SELECT 'S' || o_orderkey % 10 AS airline_code, count(*) AS routes, CAST(sum(o_orderkey % 3) AS BIGINT) AS stops FROM orders GROUP BY 1""",
    "view_int_kpis": _with([*TO_PAGED, ("landed", LANDED_STAGED)], f"SELECT {CATEGORY_RULES} AS delay_category, count(*) AS flights FROM landed GROUP BY 1"),
    "view_int_route_delays": ORACLE["route_daily"],
    "view_int_weekly": ORACLE["weekly_comparison"],
    "route_lookup": _with(TO_FACT, "SELECT flight_key, flight_date, dep_delay_min FROM fact WHERE dep_iata = 'A3' AND arr_iata = 'B1'"),
    "cast_failures": _with(
        TO_PAGED,
        """SELECT CAST(event_id AS VARCHAR) AS flight_icao_full, 'flight_date' AS "column", landed_on AS insert_date FROM paged
           WHERE NOT is_error AND NOT is_cut AND event_id % 43 <> 0 AND event_id % 41 = 0
           UNION ALL SELECT CAST(event_id AS VARCHAR), 'dep_delay_min', landed_on FROM paged WHERE NOT is_error AND NOT is_cut AND event_id % 47 = 0""",
    ),
    "check_results_one_pass": _with(
        [*TO_RECATEGORISED, ("mismatched", MISMATCHED), ("repeated", f"SELECT * FROM ({ORACLE['duplicate_keys']})")],
        """SELECT 'delay_category' AS "check", count(*) AS failures, count(*) AS stored, CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END AS status FROM mismatched
           UNION ALL SELECT 'unique_flight_key', count(*), count(*), CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END FROM repeated""",
    ),
}
