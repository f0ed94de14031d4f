"""Headerless reference CSV files."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CORRUPT, REFERENCE_DATASETS, Dataset
from .pages import LandingError
from .sinks import store_failures, write_reference

logger = logging.getLogger(__name__)

NULL_MARKER = "\\N"  # fixed value: how the files spell a missing cell


def read_reference_csv(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """Read one file as text columns, with the whole line kept in the corrupt-record column when its cell count is wrong.

    All columns are text, so a bad number is not a malformed line here; it becomes null when the column is typed. Lines are
    parsed by expression, not by the CSV source: the source parses only the cells a query asks for, and a short line then
    passes unnoticed in a query that needs its first cells alone.
    """
    schema = ", ".join(f"`{name}` string" for name in (*dataset.columns, CORRUPT))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "nullValue": NULL_MARKER}
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    # A filter on the corrupt-record column cannot pass the generator; below the parse it would parse every line again.
    parsed = F.posexplode_outer(F.array(F.from_csv("value", schema, options))).alias("at", "line")
    return lines.select(parsed).select("line.*")


def accepted(lines: DataFrame) -> DataFrame:
    """Well-formed lines, without the corrupt-record column."""
    return lines.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(lines: DataFrame) -> DataFrame:
    """Malformed lines: the raw text and what could be read of the first cell."""
    first = lines.columns[0]
    return lines.where(F.col(CORRUPT).isNotNull()).select(F.col(first).alias("first_cell"), F.col(CORRUPT).alias("line"))


def name_columns(
    frames: Mapping[str, DataFrame], datasets: Mapping[str, Dataset] = REFERENCE_DATASETS
) -> dict[str, DataFrame]:
    """Name the columns of frames read elsewhere by position. A wrong number of columns raises; an unknown dataset is left
    as it is."""
    return {n: df.toDF(*datasets[n].columns) if n in datasets else df for n, df in frames.items()}


def read_reference(
    spark: SparkSession, raw_dir: str, datasets: dict[str, Dataset] = REFERENCE_DATASETS
) -> dict[str, DataFrame]:
    """Read every dataset. All unreadable files are reported together; an empty file only warns."""
    frames: dict[str, DataFrame] = {}
    failures: list[str] = []
    for name, dataset in datasets.items():
        try:
            frames[name] = read_reference_csv(spark, f"{raw_dir.rstrip('/')}/{dataset.filename}", dataset)
        except AnalysisException as e:
            failures.append(f"{name} ({dataset.filename}): {e}")
            continue
        if frames[name].isEmpty():
            logger.warning("%s (%s) is empty", name, dataset.filename)
    if failures:
        raise LandingError("cannot read " + "; ".join(failures))
    return frames


def load_reference(
    spark: SparkSession, raw_dir: str, bronze_root: str, metadata_root: str | None = None, datasets: dict[str, Dataset] = REFERENCE_DATASETS
) -> dict[str, tuple[int, int]]:
    """Load every dataset in one go: well-formed lines to ``<bronze_root>/<name>.parquet``, malformed ones to
    ``<metadata_root>/<name>_rejects``. Returns the rows of both for each dataset."""
    frames = read_reference(spark, raw_dir, datasets)
    written = write_reference({name: accepted(df) for name, df in frames.items()}, bronze_root)
    rejects = {name: store_failures(rejected(df), metadata_root, f"{name}_rejects") if metadata_root else rejected(df).count() for name, df in frames.items()}
    return {name: (written.get(name, 0), rejects[name]) for name in frames}
