"""Waiting for landed files, as a stream.

The stream's own checkpoint remembers which files it has seen. It does not carry the flights; it tells which insert dates
have new files, and those dates are then loaded whole by a batch run. A page that arrives late therefore reloads its date
instead of overwriting it with a part, and a batch that is retried after a failure gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import path_exists

#: How far behind the newest file a new one may lie, and how long the stream remembers a file.
MAX_FILE_AGE = "60d"


def watch_landing(
    spark: SparkSession,
    raw_root: str,
    checkpoint: str,
    on_dates: Callable[[list[str]], object],
    max_file_age: str = MAX_FILE_AGE,
    max_files_per_trigger: int = 100_000,
) -> StreamingQuery:
    """Call ``on_dates`` with the insert dates of all files not seen before, then stop. Run it again to pick up what has
    landed since.

    A file counts as seen by its path, so one that is landed again under its own name is not picked up: ``changed_dates``
    finds it, as does running its date by hand. ``max_file_age`` is how far behind the newest file seen a new file's time stamp
    may lie; Spark's own default of seven days would pass over files that were copied with an older one. The stream remembers files of that age
    only, so what it holds does not grow with the lake; still older ones are found by ``refresh_ledger`` as well.
    """

    def pick_up(files: DataFrame, _: int) -> None:
        # Bounded by the calendar.
        dates = [str(r[0]) for r in files.select("insert_date").distinct().collect()]
        if dates:
            on_dates(sorted(dates))

    # Only file names are taken from this source; the content column is never read.
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFileAge", max_file_age)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(f"{raw_root.rstrip('/')}/insert_date=*")
    )
    landed = files.select(F.regexp_extract("path", "/insert_date=([^/]+)/", 1).alias("insert_date"))
    return (
        landed.writeStream.foreachBatch(pick_up)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def changed_dates(spark: SparkSession, raw_root: str, state: str) -> list[str]:
    """The insert dates whose landed files are not those of the last call: new, gone, or landed again under the same name.

    Files are listed by Spark, not read. ``state`` is a directory that remembers one fingerprint a date; it is replaced on each
    call, so load the dates before the next one, or call again with the old state after a failure.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*").load(f"{raw_root.rstrip('/')}/insert_date=*")
    day = F.regexp_extract("path", "/insert_date=([^/]+)/", 1).alias("insert_date")
    mark = F.xxhash64("path", "modificationTime", "length")
    found = files.groupBy(day).agg(F.bit_xor(mark).alias("mark"), F.count(F.lit(1)).alias("files"))
    now = {r["insert_date"]: (r["mark"], r["files"]) for r in found.collect()}  # bounded by the calendar
    before = {}
    if path_exists(spark, state):
        before = {r["insert_date"]: (r["mark"], r["files"]) for r in spark.read.parquet(state).collect()}
    rows = [(d, *v) for d, v in sorted(now.items())]
    spark.createDataFrame(rows, "insert_date string, mark bigint, files bigint").coalesce(1).write.mode("overwrite").parquet(state)
    return sorted(d for d in now.keys() | before.keys() if now.get(d) != before.get(d))
