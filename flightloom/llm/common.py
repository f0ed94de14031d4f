"""What the operators of this subpackage share: narrow inputs, batch-wise Python stages, written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Words are runs of anything but the six ASCII white-space characters.
WORD_SEPARATORS = " \t\n\x0b\x0c\r"


def column(name: str):
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names, so that no other column of the input can clash. Null texts stay null."""
    return docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str) -> DataFrame:
    """Run ``make()`` once per task and the function it returns on every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = make()
        for batch in batches:
            if batch.num_rows:
                out = handle(batch)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession, rows: int = 2000, megabytes: int = 32) -> None:
    """Bound what one Arrow batch holds, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: later stages never recompute it and survive lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_list(text: str | None) -> list[str]:
    """The words of a text, unchanged. ``str.split`` alone would also split at other Unicode white space."""
    if not text:
        return []
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    for c in "\t\n\x0b\x0c\r":
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]
