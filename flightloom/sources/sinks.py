"""Parquet sinks. Each counts its rows in the pass that writes them."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation

from ..functions import count_rows
from ..session import discard

logger = logging.getLogger(__name__)

DEFAULT_COMPRESSION = "snappy"


def _write(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    compression: str,
    max_output_files: int | None = None,
    replace_only_touched: bool = False,
    rebalance: bool = True,
    cluster_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
) -> int:
    out = df
    if max_output_files:
        out = out.coalesce(max_output_files)
    elif partition_by and rebalance:
        # Groups each partition's rows into files of the advisory size: a date with few rows gets one file, a huge date is
        # split over many tasks.
        out = out.hint("rebalance", *partition_by)
    if cluster_by:
        # The writer sorts by partition anyway; sorting on within it gives each row group a narrow range of these columns.
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    # Observed last: a count taken below a shuffle is lost when the shuffle turns out to be empty.
    seen = Observation()
    writer = out.observe(seen, count_rows().alias("rows")).write.mode("overwrite").option("compression", compression)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return seen.get["rows"]


def write_bronze(
    df: DataFrame,
    root: str,
    partition: str = "insert_date",
    compression: str = DEFAULT_COMPRESSION,
    max_output_files: int | None = None,
    rebalance: bool = True,
) -> int:
    """Write one directory per insert date and return the number of rows written.

    Only the dates present in ``df`` are replaced, so a rerun of a date is idempotent, one job may write many dates, and an
    empty input leaves the table as it was. ``max_output_files`` caps the number of files; it also caps the writing tasks,
    so leave it unset for large inputs. ``rebalance=False`` saves the shuffle when ``df`` holds a single date.
    """
    rows = _write(df, root, [partition], compression, max_output_files, True, rebalance)
    if not rows:
        logger.warning("nothing to write to %s", root)
    return rows


def write_reference(
    frames: Mapping[str, DataFrame | None],
    root: str,
    compression: str = DEFAULT_COMPRESSION,
    max_output_files: int | None = None,
) -> dict[str, int]:
    """Write each dataset to ``<root>/<name>.parquet``. Returns rows per dataset; absent and empty ones are left out, and an
    empty one leaves no table behind.

    Files get the advisory size. ``max_output_files`` caps their number instead, and with it the writing tasks, so it is for
    small datasets only.
    """
    written: dict[str, int] = {}
    for name, df in frames.items():
        path = f"{root.rstrip('/')}/{name}.parquet"
        sized = None if df is None else df if max_output_files else df.hint("rebalance")
        rows = 0 if sized is None else _write(sized, path, [], compression, max_output_files)
        if rows:
            written[name] = rows
            continue
        logger.warning("skipping %s: no rows", name)
        if df is not None:
            discard(df.sparkSession, path)
    logger.info("%d datasets, %d rows written", len(written), sum(written.values()))
    return written


def write_mart(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), only_touched: bool = False, cluster_by: Sequence[str] = (), bloom: Sequence[str] = ()
) -> int:
    """Rebuild a mart. ``only_touched`` replaces just the partitions present in ``df``.

    ``cluster_by`` sorts the rows of a partition, so that a filter on these columns skips row groups by their ranges; ``bloom`` adds Bloom filters, by
    which a lookup of single values skips row groups whatever their order.
    """
    return _write(df, path, partition_by, DEFAULT_COMPRESSION, None, only_touched, cluster_by=cluster_by, bloom=bloom)


def failures_path(metadata_root: str, check: str) -> str:
    return f"{metadata_root.rstrip('/')}/{check}"


def store_failures(failing: DataFrame, metadata_root: str, check: str) -> int:
    """Keep a check's failing rows under ``failures_path`` and return their number, counted as they are written."""
    return _write(failing, failures_path(metadata_root, check), [], DEFAULT_COMPRESSION)
