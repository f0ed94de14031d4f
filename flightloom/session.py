"""Session defaults and the shared scratch location."""

from __future__ import annotations

import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings every job in this package relies on. All are runtime settings, so they can also be applied to a session
# somebody else built (see ``configure``).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks. On a cluster the submitter builds the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flightloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory for written intermediates, inside the folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a single-machine session uses a folder of its warehouse, which goes when the session's JVM ends; a cluster
    raises, because its executors need not see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{uuid.uuid4().hex}"
        files, target = _located(spark, root)
        files.mkdirs(target)
        files.deleteOnExit(target)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/flightloom/{purpose}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    files, target = _located(spark, path)
    return files.exists(target)


def directories(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of the directories right below a path, with their modification times in milliseconds. Files are not listed."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(target) if s.isDirectory()}


def has_children(spark: SparkSession, path: str) -> bool:
    """Whether a directory holds anything. Only its first entry is looked at."""
    files, target = _located(spark, path)
    return files.listStatusIterator(target).hasNext()


def mark(spark: SparkSession, path: str, text: str = "") -> None:
    """Create or replace a small file. A reader sees the whole text or, in the moment of replacing, an older one or none."""
    files, target = _located(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one; tells whether it did. As exclusive as the file system's creation without overwriting."""
    files, target = _located(spark, path)
    try:
        out = files.create(target, False)
    except Py4JJavaError as e:
        if files.exists(target):
            return False
        raise e
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    # Where two creations can both succeed, the content tells whose file it is.
    return read_file(spark, path) == text


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; nothing if there is none."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return None
    opened = files.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(opened)).decode()
    finally:
        opened.close()


def modified_before(spark: SparkSession, path: str, seconds: float) -> bool:
    """Whether a file is older than so many seconds, or gone."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return True
    return files.getFileStatus(target).getModificationTime() < (time.time() - seconds) * 1000


def discard(spark: SparkSession, directory: str) -> None:
    """Remove a directory that ``shared_dir`` made, once nothing reads it any more."""
    files, target = _located(spark, directory)
    files.delete(target, True)
