"""Every registered query, as a function of the session and the table directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as ops
from ..functions import surrogate_key
from ..operators.silver import FLIGHT
from ..plans import marts, serving, summary
from ..plans.daily import Layout, run_batches
from ..plans.views import register_views
from ..schemas import REFERENCE_DATASETS
from ..session import configure, discard, shared_dir
from ..sources import (
    LandingError,
    accepted,
    audit_ledger,
    failures_path,
    landed_dates,
    landing_audit,
    landing_contract,
    load_reference,
    name_columns,
    read_bronze,
    read_fact,
    read_flight_pages,
    read_ledger,
    read_reference,
    read_reference_csv,
    refresh_ledger,
    rejected,
    scan_insert_date,
    store_failures,
    write_bronze,
    write_mart,
    write_reference,
)
from ..sources.pages import parse_pages
from ..sources.reference import NULL_MARKER
from ..streaming import watch_complete
from . import derived
from .derived import TIE_BREAK

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2024-02-01"
BATCH_DAYS = ("2024-02-01", "2024-02-02", "2024-02-03")
SMALL_GROUP = 200  # forces the cut path on tables of any size


def _fact(spark: SparkSession, sf_dir: str, rolling: bool = True, **options) -> DataFrame:
    return marts.fact_flights(derived.flights(spark, sf_dir), RUN_DATE, TIE_BREAK, rolling=rolling, **options)


def kpi_flights(spark, sf_dir):
    return ops.kpi_flights(derived.flights(spark, sf_dir))


def rolling_route_delay(spark, sf_dir, **options):
    rolled = ops.rolling_route_delay(derived.flights(spark, sf_dir), TIE_BREAK, **options)
    return rolled.select("event_id", "dep_iata", "arr_iata", "flight_date", "dep_delay_min", "avg_delay_7d")


def rolling_route_delay_cut(spark, sf_dir):
    return rolling_route_delay(spark, sf_dir, max_group_rows=SMALL_GROUP)


def rolling_route_delay_text_key(spark, sf_dir):
    """Ordered by letters and digits as text, on the path for large routes."""
    flights = derived.flights(spark, sf_dir).withColumn("event_key", F.concat(F.lit("AAL"), F.col("event_id").cast("string")))
    rolled = ops.rolling_route_delay(flights, ("event_key",), max_group_rows=SMALL_GROUP)
    return rolled.select("event_id", "dep_iata", "arr_iata", "flight_date", "dep_delay_min", "avg_delay_7d")


def dedup_flights(spark, sf_dir):
    return ops.dedup_flights(derived.flights(spark, sf_dir), TIE_BREAK)


def surrogate_keys(spark, sf_dir):
    key = surrogate_key(*[F.col(c) for c in FLIGHT])
    return derived.flights(spark, sf_dir).select("event_id", key.alias("flight_key"))


def fct_flights(spark, sf_dir):
    return _fact(spark, sf_dir)


def fct_flights_cut(spark, sf_dir):
    return _fact(spark, sf_dir, max_group_rows=SMALL_GROUP)


def _mart(build: Callable[[DataFrame], DataFrame]) -> Query:
    # No mart reads the rolling delay.
    return lambda spark, sf_dir: build(_fact(spark, sf_dir, rolling=False))


MARTS = {
    "route_daily": marts.route_daily,
    "delay_heatmap": marts.delay_heatmap,
    "weekly_metrics": marts.weekly_metrics,
    "weekly_comparison": marts.weekly_comparison,
}


def _question(name: str) -> Query:
    table, ask = serving.QUESTIONS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact = _fact(spark, sf_dir, rolling=name == "k_daily_trend")
        return ask(fact if table == "fact" else MARTS[table](fact))

    return run


def _pages(spark, sf_dir):
    return parse_pages(derived.page_lines(spark, sf_dir))


def bronze_flights(spark, sf_dir):
    bronze = ops.flatten_flights(_pages(spark, sf_dir))
    clocks = {c: F.col(c).cast("timestamp_ntz") for c in bronze.columns if c.endswith("_ts")}
    return bronze.withColumns(clocks)


def landed_flights(spark, sf_dir):
    """Pages on disk → bronze on disk → staging."""
    root = shared_dir(spark, "landed")
    pages = read_flight_pages(spark, derived.land_pages(spark, sf_dir, f"{root}/raw"))
    write_bronze(ops.flatten_flights(pages), f"{root}/bronze")
    return ops.stage_flights(read_bronze(spark, f"{root}/bronze"), keep=("flight_icao_full",))


def ledger_audit(spark, sf_dir):
    """The audit answered from the page ledger, which read each landed file once."""
    root = shared_dir(spark, "landed")
    derived.land_pages(spark, sf_dir, f"{root}/raw")
    refresh_ledger(spark, f"{root}/raw", f"{root}/ledger")
    refresh_ledger(spark, f"{root}/raw", f"{root}/ledger")
    return audit_ledger(read_ledger(spark, f"{root}/ledger"), limit=100, max_pages=20)


def complete_dates(spark, sf_dir):
    """What the waiting stream releases of the landed dates; the others wait on."""
    root = shared_dir(spark, "landed")
    derived.land_pages(spark, sf_dir, f"{root}/raw")
    released = []
    watch_complete(spark, f"{root}/raw", f"{root}/seen", released.extend, limit=100, max_pages=20).awaitTermination()
    return spark.createDataFrame(released, "insert_date string, status string, pages bigint, expected bigint").withColumn("insert_date", F.col("insert_date").cast("date"))


def named_columns(spark, sf_dir):
    """Reference data read without names, which it gets by position."""
    nameless = {name: df.toDF(*[f"_c{n}" for n in range(len(df.columns))]) for name, df in derived.reference_rows(spark, sf_dir).items()}
    return name_columns(nameless)["routes"].select("airline", "airline_id", "source_airport", "destination_airport_id", "stops", "equipment")


def _in_shown_order(name: str) -> Query:
    """A question's answer with the place of each row. An answer has a row a date or category."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        answer = _question(name)(spark, sf_dir)
        rows = [(place, *row) for place, row in enumerate(answer.collect(), 1)]
        return spark.createDataFrame(rows, T.StructType([T.StructField("place", T.IntegerType()), *answer.schema]))

    return run


def missing_dates(spark, sf_dir):
    root = shared_dir(spark, "landed")
    landed = landed_dates(spark, derived.land_pages(spark, sf_dir, root))
    discard(spark, root)
    return ops.missing_dates(landed, "2024-01-25", "2024-02-15")


def scan_one_insert_date(spark, sf_dir):
    """One date of a bronze table that holds seven."""
    root = shared_dir(spark, "bronze")
    write_bronze(ops.flatten_flights(_pages(spark, sf_dir)), root)
    bronze = scan_insert_date(spark, root, "2024-02-05")
    return bronze.select("flight_icao_full", "flight_date", "dep_iata", "arr_iata", "dep_delay_min", "insert_date")


def flight_rejects(spark, sf_dir):
    rejects = ops.reject_flights(ops.flatten_flights(_pages(spark, sf_dir)))
    return rejects.select("flight_icao_full", "flight_date", "reject_reason")


def check_undated(spark, sf_dir):
    undated = ops.undated_flights(ops.flatten_flights(_pages(spark, sf_dir)))
    return undated.select("flight_icao_full", "flight_date")


def _broken_routes(spark, sf_dir):
    root = shared_dir(spark, "routes")
    derived.broken_route_lines(spark, sf_dir).write.text(root)
    return read_reference_csv(spark, root, REFERENCE_DATASETS["routes"])


def reference_accepted(spark, sf_dir):
    staged = ops.stage_reference(accepted(_broken_routes(spark, sf_dir)), REFERENCE_DATASETS["routes"])
    return staged


def reference_load(spark, sf_dir):
    """The five files in one go, with the malformed route lines kept apart."""
    root = shared_dir(spark, "reference")
    for name, rows in derived.reference_rows(spark, sf_dir).items():
        target = f"{root}/raw/{REFERENCE_DATASETS[name].filename}"
        if name == "routes":
            derived.broken_route_lines(spark, sf_dir).write.text(target)
        else:
            rows.write.option("nullValue", NULL_MARKER).csv(target)
    loaded = load_reference(spark, f"{root}/raw", f"{root}/bronze", f"{root}/metadata")
    discard(spark, root)
    return spark.createDataFrame([(n, *c) for n, c in loaded.items()], "dataset string, rows bigint, rejects bigint")


def _dimension(name: str) -> Query:
    """The dataset as a headerless file → bronze → staging."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, dataset = shared_dir(spark, name), REFERENCE_DATASETS[name]
        rows = derived.reference_rows(spark, sf_dir)[name]
        rows.write.option("nullValue", NULL_MARKER).csv(f"{root}/raw/{dataset.filename}")
        read = read_reference(spark, f"{root}/raw", {name: dataset})
        write_reference({k: accepted(df) for k, df in read.items()}, f"{root}/bronze")
        return ops.stage_reference(read_bronze(spark, f"{root}/bronze/{name}.parquet"), dataset)

    return run


def reference_rows_written(spark, sf_dir):
    """Rows per dataset, as counted by the pass that writes them."""
    root = shared_dir(spark, "reference")
    written = write_reference(derived.reference_rows(spark, sf_dir), root)
    discard(spark, root)
    return spark.createDataFrame(list(written.items()), "dataset string, rows bigint")


def check_results(spark, sf_dir):
    """The three checks with their thresholds, failing rows stored."""
    root = shared_dir(spark, "metadata")
    bronze = ops.flatten_flights(_pages(spark, sf_dir))
    results = [
        ops.check(ops.undated_flights(bronze), "flight_date_not_null", root),
        ops.check(ops.duplicate_keys(_fact(spark, sf_dir, rolling=False)), "unique_flight_key", root),
        ops.check(ops.category_mismatches(_recategorised(spark, sf_dir)), "delay_category", root),
    ]
    rows = [(r.name, r.status, r.failures, spark.read.parquet(r.stored_at).count()) for r in results]
    discard(spark, root)
    return spark.createDataFrame(rows, "check string, status string, failures bigint, stored bigint")


def cast_failures(spark, sf_dir):
    return ops.cast_failures(ops.flatten_flights(_pages(spark, sf_dir), audit=True))


def check_results_one_pass(spark, sf_dir):
    """Both checks of a fact in one pass over it; here over flights with duplicates and with wrong categories."""
    root = shared_dir(spark, "metadata")
    keyed = _recategorised(spark, sf_dir).join(surrogate_keys(spark, sf_dir), "event_id")
    results = ops.check_fact(keyed, root)
    rows = [(r.name, r.status, r.failures, spark.read.parquet(r.stored_at).count() if r.failures else 0) for r in results]
    discard(spark, root)
    return spark.createDataFrame(rows, "check string, status string, failures bigint, stored bigint")


def _from_summary(name: str) -> Query:
    return lambda spark, sf_dir: summary.ask_summary(summary.day_summary(_fact(spark, sf_dir, rolling=False)), name)


def stored_summary(spark, sf_dir):
    """The summary as it follows the fact over three upserts, by touched dates."""
    path, kept = shared_dir(spark, "fact"), shared_dir(spark, "summary")
    flights = derived.batched_flights(spark, sf_dir)
    for day in BATCH_DAYS:
        batch = marts.fact_flights(flights.where(F.col("insert_date") == F.lit(day).cast("date")), day, TIE_BREAK, rolling=False)
        _, touched = ops.upsert_fact(spark, path, batch)
        summary.keep_summary(spark, path, kept, touched)
    grouped = spark.read.parquet(kept)
    value = F.coalesce(*[F.col(c).cast("string") for c in summary.GRAINS.values() if c])
    return grouped.select("flight_date", "grain", value.alias("value"), "flights", "dep_delay", "dep_known", "late", "ontime", "severe")


def _viewed(spark, sf_dir, question: str) -> DataFrame:
    """A question of a SQL user to the named layers."""
    layout = Layout.under(shared_dir(spark, "views"))
    write_bronze(ops.flatten_flights(_pages(spark, sf_dir)), layout.bronze)
    write_mart(_fact(spark, sf_dir, rolling=False), layout.fact, ["flight_date"])
    write_reference({"routes": derived.reference_rows(spark, sf_dir)["routes"]}, f"{layout.bronze}-reference")
    register_views(spark, layout, f"{layout.bronze}-reference")
    return spark.sql(question)


VIEWED = {
    "view_stg_flights": "SELECT * FROM stg_lnd_flights WHERE insert_date = DATE'2024-02-05'",
    "view_stg_routes": "SELECT airline_code, count(*) AS routes, sum(CAST(stops AS BIGINT)) AS stops FROM stg_lnd_routes GROUP BY airline_code",
    "view_int_kpis": "SELECT delay_category, count(*) AS flights FROM int_flights_kpis GROUP BY delay_category",
    "view_int_route_delays": "SELECT * FROM int_avg_flight_delays",
    "view_int_weekly": "SELECT * FROM int_weekly_comparison",
}


def _view_query(question: str) -> Query:
    return lambda spark, sf_dir: _viewed(spark, sf_dir, question)


def route_lookup(spark, sf_dir):
    """One route of the stored fact, whose files skip the row groups of other routes."""
    path = shared_dir(spark, "fact")
    ops.upsert_fact(spark, path, _fact(spark, sf_dir, rolling=False))
    return read_fact(spark, path).where("dep_iata = 'A3' AND arr_iata = 'B1'").select("flight_key", "flight_date", "dep_delay_min")


def upsert_fact(spark, sf_dir):
    """Three insert dates, one upsert after the other."""
    path = shared_dir(spark, "fact")
    flights = derived.batched_flights(spark, sf_dir)
    for day in BATCH_DAYS:
        batch = flights.where(F.col("insert_date") == F.lit(day).cast("date"))
        ops.upsert_fact(spark, path, marts.fact_flights(batch, day, TIE_BREAK))
    return read_fact(spark, path)


def upsert_fact_recovered(spark, sf_dir):
    """The same three insert dates, of which the second breaks off once it is marked, and leftovers of unmarked ones lie about."""
    path = shared_dir(spark, "fact")
    flights = derived.batched_flights(spark, sf_dir)
    batches = [marts.fact_flights(flights.where(F.col("insert_date") == F.lit(day).cast("date")), day, TIE_BREAK) for day in BATCH_DAYS]
    ops.upsert_fact(spark, path, batches[0])
    with ops.leased(spark, path, "broken off") as lease:
        ops.stage_upsert(spark, path, batches[1], lease)
    batches[0].limit(5).write.parquet(f"{path}.upsert/unmarked/batch")
    ops.upsert_fact(spark, path, batches[2])
    batches[0].limit(5).write.parquet(f"{path}.upsert/unmarked/batch")
    ops.finish_upsert(spark, path)
    return read_fact(spark, path)


def upsert_fact_bucketed(spark, sf_dir):
    """The same three insert dates into a catalog table bucketed by key."""
    path = shared_dir(spark, "bucketed")
    table = f"fct_flights_{path[-32:]}"
    flights = derived.batched_flights(spark, sf_dir)
    for day in BATCH_DAYS:
        fact = marts.fact_flights(flights.where(F.col("insert_date") == F.lit(day).cast("date")), day, TIE_BREAK)
        ops.create_fact_table(spark, table, path, fact, buckets=4)
        ops.upsert_table(spark, table, fact)
    return spark.table(table)


def backfill(spark, sf_dir):
    """The same three insert dates in one job."""
    path = shared_dir(spark, "fact")
    flights = derived.batched_flights(spark, sf_dir)
    fact = marts.fact_flights(flights, F.col("insert_date"), TIE_BREAK, batch="insert_date")
    ops.upsert_fact(spark, path, fact)
    return read_fact(spark, path)


def loaded_lake(spark, sf_dir, **options) -> tuple[Layout, list]:
    """All landed dates, loaded in two runs, with their reports."""
    layout = Layout.under(shared_dir(spark, "lake"))
    derived.land_pages(spark, sf_dir, layout.raw)
    days = [f"2024-02-0{n}" for n in range(1, 8)]
    reports = []
    for dates in (days[:4], days[4:]):
        try:
            reports.append(run_batches(spark, layout, dates, tie_break=("flight_icao_full",), **options))
        except LandingError as error:  # on small tables some dates have nothing but error pages
            reports.append(error.report)
    discard(spark, layout.raw)
    discard(spark, layout.bronze)
    return layout, reports


def daily_run_fact(spark, sf_dir):
    return read_fact(spark, loaded_lake(spark, sf_dir)[0].fact)


def daily_run_fact_cut(spark, sf_dir):
    return read_fact(spark, loaded_lake(spark, sf_dir, max_group_rows=SMALL_GROUP)[0].fact)


def _daily_run_mart(name: str) -> Query:
    return lambda spark, sf_dir: read_fact(spark, f"{loaded_lake(spark, sf_dir)[0].marts}/{name}")


def daily_run_checks(spark, sf_dir):
    """The checks of both runs, under the run's own policy."""
    _, reports = loaded_lake(spark, sf_dir)
    rows = [(n, c.name, c.status, c.failures) for n, report in enumerate(reports, 1) for c in report.checks]
    return spark.createDataFrame(rows, "run int, check string, status string, failures bigint")


def _stored_and_batch(spark, sf_dir):
    flights = derived.flights(spark, sf_dir)
    from_day = F.lit("2024-01-20").cast("date")
    path = shared_dir(spark, "fact")
    stored = marts.fact_flights(flights.where(F.col("flight_date") < from_day), RUN_DATE, TIE_BREAK)
    ops.upsert_fact(spark, path, stored)
    return path, flights.where(F.col("flight_date") >= from_day)


def incremental_window(spark, sf_dir):
    return ops.incremental_window(*_stored_and_batch(spark, sf_dir), TIE_BREAK)


def carried_window(spark, sf_dir):
    """The same frames, carried by the stored tails of the routes."""
    path, batch = _stored_and_batch(spark, sf_dir)
    tails = shared_dir(spark, "tails")
    ops.keep_tails(spark, path, tails)
    return ops.carried_window(tails, path, batch, TIE_BREAK)


def _recategorised(spark, sf_dir):
    wrong = F.when(F.col("event_id") % 17 == 0, "bogus").when(F.col("event_id") % 19 == 0, "ontime")
    kpis = ops.kpi_flights(derived.flights(spark, sf_dir))
    return kpis.select("event_id", "dep_delay_min", F.coalesce(wrong, "delay_category").alias("delay_category"))


def stored_failures(spark, sf_dir):
    failing = ops.category_mismatches(_recategorised(spark, sf_dir))
    root = shared_dir(spark, "metadata")
    store_failures(failing, root, "delay_category")
    return spark.read.parquet(failures_path(root, "delay_category"))


def _duplicates(spark, sf_dir):
    return ops.duplicate_keys(surrogate_keys(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "kpi_flights": kpi_flights,
    "rolling_route_delay": rolling_route_delay,
    "rolling_route_delay_cut": rolling_route_delay_cut,
    "rolling_route_delay_text_key": rolling_route_delay_text_key,
    "dedup_flights": dedup_flights,
    "surrogate_key": surrogate_keys,
    "fct_flights": fct_flights,
    "fct_flights_cut": fct_flights_cut,
    **{name: _mart(build) for name, build in MARTS.items()},
    **{name: _question(name) for name in serving.QUESTIONS},
    **{f"{name}_summary": _from_summary(name) for name in summary.ANSWERS},
    "stored_summary": stored_summary,
    **{name: _view_query(question) for name, question in VIEWED.items()},
    "route_lookup": route_lookup,
    **{f"{name}_order": _in_shown_order(name) for name in ("k_flights_by_date", "k_delay_category", "k_time_of_day")},
    "bronze_flights": bronze_flights,
    "landed_flights": landed_flights,
    "landing_contract": lambda spark, sf_dir: landing_contract(_pages(spark, sf_dir)),
    "landing_audit": lambda spark, sf_dir: landing_audit(_pages(spark, sf_dir), limit=100, max_pages=20),
    "ledger_audit": ledger_audit,
    "complete_dates": complete_dates,
    "missing_dates": missing_dates,
    "scan_insert_date": scan_one_insert_date,
    "flight_rejects": flight_rejects,
    "reference_rejects": lambda spark, sf_dir: rejected(_broken_routes(spark, sf_dir)),
    "reference_accepted": reference_accepted,
    "named_columns": named_columns,
    **{f"dim_{name}": _dimension(name) for name in REFERENCE_DATASETS},
    "reference_load": reference_load,
    "reference_rows_written": reference_rows_written,
    "upsert_fact": upsert_fact,
    "upsert_fact_recovered": upsert_fact_recovered,
    "upsert_fact_bucketed": upsert_fact_bucketed,
    "backfill": backfill,
    "incremental_window": incremental_window,
    "carried_window": carried_window,
    "daily_run_fact": daily_run_fact,
    "daily_run_fact_cut": daily_run_fact_cut,
    "daily_run_route_daily": _daily_run_mart("route_daily"),
    "daily_run_heatmap": _daily_run_mart("delay_heatmap"),
    "daily_run_weekly": _daily_run_mart("weekly_comparison"),
    "daily_run_checks": daily_run_checks,
    "check_undated": check_undated,
    "check_unique_key": lambda spark, sf_dir: ops.duplicate_keys(_fact(spark, sf_dir, rolling=False)),
    "duplicate_keys": _duplicates,
    "check_category": lambda spark, sf_dir: ops.category_mismatches(_recategorised(spark, sf_dir)),
    "check_category_strict": lambda spark, sf_dir: ops.category_mismatches(_recategorised(spark, sf_dir), strict=True),
    "stored_failures": stored_failures,
    "check_results": check_results,
    "check_results_one_pass": check_results_one_pass,
    "cast_failures": cast_failures,
}


def configured(query: Query) -> Query:
    """Run a query under this package's session settings."""
    return lambda spark, sf_dir: query(configure(spark), sf_dir)
