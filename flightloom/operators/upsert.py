"""Keyed upsert into a Parquet fact partitioned by flight date, safe to break off and to retry.

One upsert goes through these steps, each of which may be the last one that happens:

1. take the lease, a file beside the fact that only one writer can create;
2. finish what a writer before left marked, clear what it left unmarked;
3. write the batch, and the old rows of the touched dates that survive it, to a staging folder of this writer's own;
4. mark: one small file that names the staging folder and its parts. From here on the upsert will happen;
5. rebuild the touched dates from the staged copies alone;
6. remove the mark, *then* the copies, then the lease.

Broken off before the mark, an upsert has changed nothing; after it, the next writer repeats step 5, which reads only the copies. A mark whose
copies are not all there raises instead of replacing dates by a part of their rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import create_file, discard, mark, modified_before, path_exists, read_file
from ..sources.sinks import write_mart
from ..sources.tables import read_dates

FACT_KEY = "flight_key"
FACT_PARTITION = "flight_date"
#: By what the rows of a date are sorted.
FACT_CLUSTER = ("dep_iata", "arr_iata")
#: How long after its last sign of life a writer's lease still holds.
LEASE_SECONDS = 6 * 3600


class UpsertLocked(Exception):
    """Another writer holds the fact's lease."""


class LeaseLost(Exception):
    """Another writer has taken the lease over in the meantime."""


class UpsertDamaged(Exception):
    """An upsert was marked, but its staged copies are not all there."""


class Lease:
    """The right to write one fact, held by one ``owner`` at a time.

    It is a file created without overwriting, which holds its owner's name. A retry under the same name goes on with its own lease; another
    writer gets it once ``seconds`` have passed since it was last renewed. A holder renews it, and makes sure it still holds it, before every
    step that others would notice.
    """

    def __init__(self, spark: SparkSession, fact_path: str, owner: str, seconds: float = LEASE_SECONDS):
        self.spark, self.path, self.owner, self.seconds = spark, f"{fact_path.rstrip('/')}.lease", owner, seconds

    def holder(self) -> str | None:
        return read_file(self.spark, self.path)

    def take(self) -> None:
        if create_file(self.spark, self.path, self.owner):
            return
        if self.holder() == self.owner:
            mark(self.spark, self.path, self.owner)
            return
        if modified_before(self.spark, self.path, self.seconds):
            discard(self.spark, self.path)
            if create_file(self.spark, self.path, self.owner):
                return
        raise UpsertLocked(f"{self.path} is held by {self.holder()}")

    def renew(self) -> None:
        if self.holder() != self.owner:
            raise LeaseLost(f"{self.path} is held by {self.holder()}, not by {self.owner}")
        mark(self.spark, self.path, self.owner)

    def release(self) -> None:
        if self.holder() == self.owner:
            discard(self.spark, self.path)


@contextmanager
def leased(spark: SparkSession, fact_path: str, owner: str | None, seconds: float = LEASE_SECONDS) -> Iterator[Lease]:
    """Hold the fact's lease. An exception gives it back: this writer is no longer at work, and what it staged is for the next one."""
    lease = Lease(spark, fact_path, owner or uuid.uuid4().hex, seconds)
    lease.take()
    try:
        yield lease
    finally:
        lease.release()


def touched_dates(batch: DataFrame) -> list[date]:
    """The flight dates a stored batch touches. Their number is bounded by the calendar."""
    return [r[0] for r in batch.select(FACT_PARTITION).distinct().collect()]


def _staging(fact_path: str) -> str:
    return f"{fact_path.rstrip('/')}.upsert"


def _mark_path(fact_path: str) -> str:
    return f"{_staging(fact_path)}/READY"


def _marked(spark: SparkSession, fact_path: str) -> list[str] | None:
    """The staged copies of a marked upsert, if there is one."""
    text = read_file(spark, _mark_path(fact_path))
    if text is None:
        return None
    if text:
        staged = json.loads(text)
        parts = [f"{_staging(fact_path)}/{staged['folder']}/{name}" for name in staged["parts"]]
    else:  # an empty mark: copies right below the staging folder, survivors only if there were any
        parts = [f"{_staging(fact_path)}/{name}" for name in ("batch", "survivors")]
        parts = [p for p in parts if p.endswith("/batch") or path_exists(spark, p)]
    # A finished write leaves _SUCCESS behind.
    if missing := [p for p in parts if not path_exists(spark, f"{p}/_SUCCESS")]:
        raise UpsertDamaged(f"{_mark_path(fact_path)} is set, but {missing} are not whole")
    return parts


#: Replaces the touched dates of a fact by these rows.
Apply = Callable[[DataFrame], object]
#: The stored rows of some dates, if there are any.
Stored = Callable[[list[date]], DataFrame | None]


def _finish(spark: SparkSession, fact_path: str, lease: Lease, apply: Apply | None = None) -> bool:
    parts = _marked(spark, fact_path)
    if parts:
        lease.renew()
        result = spark.read.parquet(parts[0])
        for part in parts[1:]:
            result = result.unionByName(spark.read.parquet(part))
        if apply:
            apply(result)
        else:
            clustered = [c for c in FACT_CLUSTER if c in result.columns]
            write_mart(result, fact_path, [FACT_PARTITION], only_touched=True, cluster_by=clustered, bloom=[FACT_KEY])
        lease.renew()
        # The mark goes first and alone: a folder is removed in no promised order, and a mark must never outlive its copies.
        discard(spark, _mark_path(fact_path))
    if path_exists(spark, _staging(fact_path)):
        discard(spark, _staging(fact_path))
    return bool(parts)


def finish_upsert(spark: SparkSession, fact_path: str, owner: str | None = None, lease_seconds: float = LEASE_SECONDS) -> bool:
    """Complete an upsert that broke off after it was marked, or clear one that broke off before. Tells which."""
    if not path_exists(spark, _staging(fact_path)):
        return False
    with leased(spark, fact_path, owner, lease_seconds) as lease:
        return _finish(spark, fact_path, lease)


def survivors(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The stored rows whose key is not among the incoming ones."""
    return stored.join(incoming.select(FACT_KEY), FACT_KEY, "left_anti")


def stage_upsert(spark: SparkSession, fact_path: str, batch: DataFrame, lease: Lease, stored_of: Stored | None = None) -> tuple[int, list[date]]:
    """Steps 3 and 4: write what the touched dates will hold, and mark it. Returns the batch's rows and the dates it touches.

    The key contains the flight date, so a key never changes partition and only the touched dates are listed and read. The copies are not
    partitioned, so writing them moves no rows.
    """
    folder = uuid.uuid4().hex
    staged = f"{_staging(fact_path)}/{folder}"
    incoming_rows = write_mart(batch, f"{staged}/batch")
    if not incoming_rows:
        return 0, []
    incoming = spark.read.parquet(f"{staged}/batch")
    touched = touched_dates(incoming)
    stored = stored_of(touched) if stored_of else read_dates(spark, fact_path, touched, FACT_PARTITION)
    parts = ["batch"]
    if stored is not None:
        write_mart(survivors(stored, incoming), f"{staged}/survivors")
        parts.append("survivors")
    lease.renew()
    mark(spark, _mark_path(fact_path), json.dumps({"folder": folder, "parts": parts}))
    return incoming_rows, touched


def upsert_fact(
    spark: SparkSession,
    fact_path: str,
    batch: DataFrame,
    owner: str | None = None,
    lease_seconds: float = LEASE_SECONDS,
    stored_of: Stored | None = None,
    apply: Apply | None = None,
) -> tuple[int, list[date]]:
    """Replace the fact's rows that share a key with ``batch`` and insert the rest. Returns the batch's row count and the flight dates it
    touched.

    Only the touched dates are rewritten, and nothing is read from a partition that is being replaced. ``owner`` names the writer: a retry that
    gives the same name goes on at once after a crash, another writer gets ``UpsertLocked`` until the lease runs out. ``stored_of`` and ``apply``
    read and replace dates where the fact is more than a directory (``operators.bucketed``).
    """
    with leased(spark, fact_path, owner, lease_seconds) as lease:
        _finish(spark, fact_path, lease, apply)
        rows, touched = stage_upsert(spark, fact_path, batch, lease, stored_of)
        _finish(spark, fact_path, lease, apply)
    return rows, touched
