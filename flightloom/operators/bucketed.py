"""The fact as a catalog table, bucketed and sorted by its key within each flight date.

An upsert joins the touched dates with the batch's keys. In a plain directory both sides are shuffled by key; here the stored rows, which are
the larger side by far, are read bucket by bucket as they lie, and only the batch's keys move. Rewriting a date deals its rows by the same hash, so each
task writes one bucket of each date and a date has as many files as there are buckets.

The steps, the lease and the recovery are those of ``operators.upsert``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .upsert import FACT_KEY, FACT_PARTITION, LEASE_SECONDS, upsert_fact

#: Buckets of a new table: about as many as a busy date has files of the advisory size.
BUCKETS = 16


def create_fact_table(spark: SparkSession, table: str, path: str, like: DataFrame, buckets: int = BUCKETS) -> None:
    """An empty table at ``path`` with the columns of ``like``, partitioned by flight date and bucketed by key. Left as it is if it is there."""
    if spark.catalog.tableExists(table):
        return
    empty = like.limit(0).write.format("parquet").partitionBy(FACT_PARTITION).bucketBy(buckets, FACT_KEY).sortBy(FACT_KEY)
    empty.option("path", path).saveAsTable(table)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def table_path(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["Location"]


def table_buckets(spark: SparkSession, table: str) -> int:
    return int(_described(spark, table)["Num Buckets"])


def stored_rows(spark: SparkSession, table: str, dates: list[date]) -> DataFrame:
    """The rows of some dates, of which alone the files are listed."""
    return spark.table(table).where(F.col(FACT_PARTITION).isin(dates))


def upsert_table(
    spark: SparkSession, table: str, batch: DataFrame, owner: str | None = None, lease_seconds: float = LEASE_SECONDS
) -> tuple[int, list[date]]:
    """``upsert_fact`` into a table made by ``create_fact_table``."""
    buckets, columns = table_buckets(spark, table), spark.table(table).columns

    def apply(rows: DataFrame) -> None:
        dealt = rows.select(*columns).repartition(buckets, FACT_KEY)
        mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            dealt.write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)

    stored = lambda dates: stored_rows(spark, table, dates) if dates else None
    return upsert_fact(spark, table_path(spark, table), batch, owner, lease_seconds, stored, apply)
