"""Which dates are still to be loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_dates(landed: DataFrame, first: str, last: str, column: str = "insert_date") -> DataFrame:
    """Calendar days from ``first`` to ``last`` for which ``landed`` has no row."""
    days = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    calendar = landed.sparkSession.range(1).select(F.explode(days).alias(column))
    present = landed.select(F.col(column).cast("date").alias(column)).distinct()
    return calendar.join(present, column, "left_anti")
