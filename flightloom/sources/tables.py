"""Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import directories, path_exists


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet directory. Partition columns in the path become columns."""
    return spark.read.parquet(path)


def scan_insert_dates(spark: SparkSession, root: str, insert_dates: Sequence[str]) -> DataFrame:
    """Some insert dates of a bronze table. Only their directories are listed, however many dates the table holds.

    A date without flights has no directory and gives no rows; a table with none of the dates raises.
    """
    days = [f"{root.rstrip('/')}/insert_date={day}" for day in insert_dates]
    written = [day for day in days if path_exists(spark, day)]
    rows = spark.read.option("basePath", root).parquet(*(written or days))
    return rows.withColumn("insert_date", F.col("insert_date").cast("date"))


def scan_insert_date(spark: SparkSession, root: str, insert_date: str) -> DataFrame:
    """One insert date of a bronze table."""
    return scan_insert_dates(spark, root, [insert_date])


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The stored fact (or mart). Filters on ``flight_date`` prune its partitions."""
    return spark.read.parquet(path)


def partition_dates(spark: SparkSession, path: str, column: str) -> list[date]:
    """The dates for which a table partitioned by ``column`` has a directory. One listing, however many files it holds."""
    prefix = f"{column}="
    values = [name.removeprefix(prefix) for name in directories(spark, path) if name.startswith(prefix)]
    return sorted(date.fromisoformat(v) for v in values if v != "__HIVE_DEFAULT_PARTITION__")


def read_dates(spark: SparkSession, path: str, dates: Sequence[date], column: str = "flight_date") -> DataFrame | None:
    """Some dates of a partitioned table, listing only their directories; nothing if it has none of them."""
    wanted = [f"{path.rstrip('/')}/{column}={day}" for day in dates]
    there = [d for d in wanted if path_exists(spark, d)]
    return spark.read.option("basePath", path).parquet(*there) if there else None
