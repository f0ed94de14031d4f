"""Waiting until an insert date is complete, as a stateful stream.

Each insert date is a key, whose state holds how many pages have landed, the largest total any of them reported and when the first one landed. A
date is released when as many pages are there as that total needs, or when ``wait`` has passed since its first page. The clock is the files' own:
their modification times, by a watermark, so a rerun over the same files releases the same dates. A page that lands after the release releases
its date once more, as ``late``.

State is pruned: a released date is forgotten once the watermark is ``remember`` past its last page. A page that comes even later starts its
date anew, which is then released like any other; since a released date is loaded whole, nothing is lost by that. So the state holds the dates
of the last ``wait`` and ``remember``, however old the lake is, and the source remembers files of ``max_file_age`` only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.ledger import parse_narrow
from .landing import MAX_FILE_AGE

RELEASED = "insert_date string, status string, pages long, expected long"
STATE = "pages long, total long, first_ms long, released boolean"


class Released(NamedTuple):
    """A date to load: ``complete``, ``timed out`` before it was, or ``late`` because a page followed its release."""

    insert_date: str
    status: str
    pages: int
    expected: int


def settle(limit: int, max_pages: int, wait_ms: int, remember_ms: int) -> Callable:
    """The state's transition: (date, new pages, state) → rows to release."""

    def expected(total: int) -> int:
        return min(max_pages, max(1, math.ceil(total / limit)))

    def step(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        insert_date, watermark = key[0], state.getCurrentWatermarkMs()
        pages, total, first, released = state.get if state.exists else (0, 0, None, False)
        status = None
        if state.hasTimedOut:
            state.remove()
            status = None if released else "timed out"
            if not released:
                # Kept for a while, so that a page which comes now counts as late.
                state.update((pages, total, first, True))
                state.setTimeoutTimestamp(watermark + max(remember_ms, 1))
        else:
            last = 0
            for frame in frames:
                landed = frame["modified_ms"]
                pages += len(frame)
                total = max(total, int(frame["total"].max()))
                first = min(int(landed.min()), landed.max() if first is None else first)
                last = max(last, int(landed.max()))
            due = int(first) + wait_ms
            status = "late" if released else "complete" if pages >= expected(total) else "timed out" if due <= watermark else None
            state.update((pages, total, int(first), bool(released or status)))
            state.setTimeoutTimestamp(max(watermark, last) + max(remember_ms, 1) if released or status else due)
        if status:
            yield pd.DataFrame([(insert_date, status, pages, expected(total))], columns=["insert_date", "status", "pages", "expected"])

    return step


def released_dates(pages: DataFrame, limit: int = 100, max_pages: int = 1, wait_seconds: int = 6 * 3600, remember_seconds: int = 3 * 86400) -> DataFrame:
    """(insert_date, status, pages, expected) of the dates that a stream of landed pages (insert_date, modified, total) releases."""
    marked = pages.withWatermark("modified", "0 seconds").withColumn("modified_ms", F.unix_millis("modified"))
    step = settle(limit, max_pages, wait_seconds * 1000, remember_seconds * 1000)
    return marked.groupBy("insert_date").applyInPandasWithState(step, RELEASED, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def watch_complete(
    spark: SparkSession,
    raw_root: str,
    checkpoint: str,
    on_dates: Callable[[list[Released]], object],
    limit: int = 100,
    max_pages: int = 1,
    wait_seconds: int = 6 * 3600,
    remember_seconds: int = 3 * 86400,
    max_file_age: str = MAX_FILE_AGE,
    max_files_per_trigger: int = 100_000,
) -> StreamingQuery:
    """Call ``on_dates`` with the dates that the files not seen before release, then stop. Run it again to go on.

    A batch that is retried after a failure may release the same dates twice; loading a date twice changes nothing.
    """

    def release(rows: DataFrame, _: int) -> None:
        # Bounded by the calendar.
        found = sorted(Released(*r) for r in rows.select("insert_date", "status", "pages", "expected").collect())
        if found:
            on_dates(found)

    lines = (
        spark.readStream.format("text")
        .option("maxFileAge", max_file_age)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("wholetext", False)
        .load(f"{raw_root.rstrip('/')}/insert_date=*")
        .select(
            "value",
            F.regexp_extract(F.col("_metadata.file_path"), "/insert_date=([^/]+)/", 1).alias("insert_date"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )
    pages = parse_narrow(lines).select("insert_date", "modified", F.coalesce("page.pagination.total", F.lit(0)).alias("total"))
    released = released_dates(pages, limit, max_pages, wait_seconds, remember_seconds)
    return (
        released.writeStream.foreachBatch(release)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
