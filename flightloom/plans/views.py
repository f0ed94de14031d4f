"""The staged and intermediate layers by name, for users of SQL.

Staged layers are catalog views, each a typed projection over the files as they lie: they hold no rows, need no refresh, are seen by every session of the
catalog, and a filter on a partition column prunes directories through them. Intermediate layers are views of this
session, composed over the staged ones and the stored fact by the same functions that the daily run uses.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.kpis import kpi_flights
from ..operators.staging import STAGED_FLIGHT_TYPES
from ..schemas import REFERENCE_DATASETS
from ..session import path_exists
from ..sources import read_fact
from . import marts
from .daily import Layout


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _view(spark: SparkSession, name: str, columns: dict[str, str], path: str, keep: str = "") -> None:
    listed = ", ".join(f"{rule} AS {_quoted(column)}" for column, rule in columns.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM parquet.{_quoted(path)} {keep}")


def staged_views(spark: SparkSession, layout: Layout, reference_root: str | None = None, database: str = "default") -> list[str]:
    """Create ``stg_lnd_flights``, ``stg_fct_flights`` and, with ``reference_root``, one ``stg_lnd_`` view for each reference dataset whose table is there."""
    names = []
    if path_exists(spark, layout.bronze):
        identity = {"flight_iata_full": "airline_iata || flight_number"}
        typed = {column: f"try_cast({identity.get(column, _quoted(column))} AS {kind})" for column, kind in STAGED_FLIGHT_TYPES.items()}
        # The landing date is no staged column, but it is what the files are partitioned by.
        typed["insert_date"] = "CAST(insert_date AS DATE)"
        _view(spark, f"{database}.stg_lnd_flights", typed, layout.bronze, "WHERE try_cast(flight_date AS DATE) IS NOT NULL")
        names.append("stg_lnd_flights")
    if path_exists(spark, layout.fact):
        _view(spark, f"{database}.stg_fct_flights", {c: _quoted(c) for c in read_fact(spark, layout.fact).columns}, layout.fact)
        names.append("stg_fct_flights")
    for name, dataset in REFERENCE_DATASETS.items() if reference_root else ():
        path = f"{reference_root.rstrip('/')}/{name}.parquet"
        if path_exists(spark, path):
            _view(spark, f"{database}.stg_lnd_{name}", {staged: f"try_cast({_quoted(raw)} AS {kind})" for raw, kind, staged in dataset.staged}, path)
            names.append(f"stg_lnd_{name}")
    return names


def intermediate_views(spark: SparkSession, database: str = "default") -> list[str]:
    """Create the session's ``int_`` views over the staged ones that are there."""
    made = {}
    if spark.catalog.tableExists(f"{database}.stg_lnd_flights"):
        staged = spark.table(f"{database}.stg_lnd_flights")
        made["int_flights_kpis"] = kpi_flights(staged)
        made["int_flights"] = marts.fact_flights(staged, F.col("insert_date"), batch="insert_date", rolling=False)
    if spark.catalog.tableExists(f"{database}.stg_fct_flights"):
        fact = spark.table(f"{database}.stg_fct_flights")
        made["int_avg_flight_delays"] = marts.route_daily(fact)
        made["int_weekly_comparison"] = marts.weekly_comparison(fact)
    for name, frame in made.items():
        frame.createOrReplaceTempView(name)
    return [*made]


def register_views(spark: SparkSession, layout: Layout, reference_root: str | None = None, database: str = "default") -> list[str]:
    """Both layers. Names: ``stg_lnd_flights``, ``stg_fct_flights``, ``stg_lnd_airports`` and so on, ``int_flights_kpis``, ``int_flights``,
    ``int_avg_flight_delays``, ``int_weekly_comparison``."""
    return staged_views(spark, layout, reference_root, database) + intermediate_views(spark, database)
