"""Approximate nearest neighbours by cross-polytope hashing.

Each of ``tables`` tables turns unit vectors by a pseudo-rotation, three rounds of random signs and a fast Hadamard transform, and
hashes them to the nearest signed axis. A query probes the axes it is nearest to, ``probes`` in each table. Candidates of a
probed bucket are scored by exact inner products in double precision; each block of a bucket keeps a query's best ``k``, and the
best ``k`` of all blocks are its answer. Every row is indexed; nothing is fitted. A query that finds fewer than ``k`` rows, or than
there are, probes ``WIDER`` times the axes until it is full, at last every axis of one table, which meets every row.

Nearness is the inner product, so a vector's length counts: candidates get one more component that brings them all to the length of
the longest, which turns the largest inner product into the smallest angle.

A bucket may hold any share of the rows: buckets are cut into blocks of about ``BLOCK`` candidates, their queries into blocks of
about ``QUERY_BLOCK``, and a task takes one pair of blocks.

Vectors that are null, empty, zero or hold null or non-finite components take no part. Vectors of different lengths have no inner product: each
length is searched by itself, in as many runs as there are lengths. Rows that repeat an
id are candidates each on its own and may both appear; a query id that repeats is searched once, by the vector of the smallest
hash. Null ids take no part. Only the two named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, small_batches, written
from .vectors import keyed_vectors, matrix, usable, widths

TABLES = 10
#: Axes probed in a table, as a share of all signed axes.
PROBED = 0.06
#: Times the axes that a query probes next if it found too few.
WIDER = 4
BLOCK = 8_000
QUERY_BLOCK = 2_000
SEED = 20_240_229


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the number of columns is a power of two."""
    n = x.shape[1]
    half = 1
    while half < n:
        x = x.reshape(len(x), -1, 2, half)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        half *= 2
        x = x.reshape(len(x), n)
    return x / np.sqrt(n)


class Rotations:
    """Pseudo-rotations of ``tables`` tables, the same on every worker."""

    def __init__(self, width: int, tables: int, seed: int = SEED):
        self.size = 1 << max(1, (width + 1 - 1).bit_length())
        self.signs = np.random.default_rng(seed).choice((-1.0, 1.0), size=(tables, 3, self.size))

    def turned(self, x: np.ndarray, table: int) -> np.ndarray:
        full = np.zeros((len(x), self.size))
        full[:, : x.shape[1]] = x
        for signs in self.signs[table]:
            full = hadamard(full * signs)
        return full

    def ranked(self, x: np.ndarray, table: int, count: int) -> np.ndarray:
        """The ``count`` nearest signed axes of each row, nearest first: axis i is 2i, its negative 2i + 1."""
        t = self.turned(x, table)
        both = np.stack([t, -t], axis=2).reshape(len(t), -1)
        if count == 1:
            return both.argmax(axis=1)[:, None]
        return np.argsort(-both, axis=1, kind="stable")[:, :count]


def _hashed(vectors: DataFrame, width: int, tables: int, longest: float, probes: int, used: int | None = None) -> DataFrame:
    """One row per vector, table (of the first ``used``) and bucket. ``probes`` 0: candidates, each in one bucket of every table."""
    used = used or tables

    def make():
        rotations = Rotations(width + 1, tables)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = matrix(batch.column(1), width) / longest
            rest = np.zeros(len(x)) if probes else np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
            x = np.c_[x, rest]
            count = max(probes, 1)
            buckets = np.stack([rotations.ranked(x, t, count) for t in range(used)], axis=1)
            rows = np.repeat(np.arange(len(x)), used * count)
            table = np.tile(np.repeat(np.arange(used), count), len(x))
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                                               pa.array((table * 2 * rotations.size + buckets.ravel()).astype(np.int64))],
                                              names=["vec_id", "vector", "bucket"])

        return handle

    return map_batches(vectors, make, "vec_id long, vector array<double>, bucket long")


def _best(k: int, width: int):
    """Exact scores of one block of queries against one block of candidates; each query's best ``k``, ties to smaller ids."""

    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        candidates = candidates.sort_values("vec_id", kind="stable")
        ids, q_ids = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        x, q = np.stack(candidates["vector"].to_numpy()), np.stack(queries["vector"].to_numpy())
        found = []
        for at in range(0, len(q), 256):
            scores = q[at : at + 256] @ x.T
            scores[q_ids[at : at + 256, None] == ids[None, :]] = -np.inf
            if len(ids) > k:
                # Keep everything that ties with the k-th, then cut by score and id.
                least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
            else:
                least = np.full(len(scores), -np.inf)
            row, col = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
            order = np.lexsort((ids[col], -scores[row, col], row))
            row, col = row[order], col[order]
            start = np.searchsorted(row, np.arange(len(scores)))
            keep = np.arange(len(row)) - start[row] < k
            row, col = row[keep], col[keep]
            # The product of two rows rounds alike wherever it is taken.
            exact = (q[at + row] * x[col]).sum(axis=1)
            found.append(pd.DataFrame({"query_id": q_ids[at + row], "vec_id": ids[col], "score": exact}))
        return pd.concat(found)

    return run


def search(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           tables: int = TABLES, probed: float = PROBED) -> DataFrame:
    """query_id, rank (from 1), vec_id, score. ``is_query`` is a condition on the column vec_id."""
    spark = table.sparkSession
    small_batches(spark, rows=5000)
    vectors = keyed_vectors(table, id_col, vector_col).where("vec_id is not null")
    lengths = widths(vectors)
    if len(lengths) > 1:
        parts = [vectors.where(F.size("vector") == w) for w in lengths]
        return reduce(DataFrame.unionByName, [search(part, is_query, k, "vec_id", "vector", tables, probed) for part in parts])
    width = lengths[0] if lengths else 0
    good = vectors.where(usable(F.col("vector")) & (F.size("vector") == width))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    longest = good.agg(F.max(norm)).first()[0] if width else None
    if not longest:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    axes = 2 * Rotations(width + 1, 1).size
    probes = min(axes, max(1, round(probed * axes)))
    index = written(_hashed(good, width, tables, float(longest), 0), "ann-index")
    asked = good.where(is_query).groupBy("vec_id").agg(F.min_by("vector", F.xxhash64("vector")).alias("vector"))
    # A query is a candidate itself, but not its own.
    full = min(k, good.select("vec_id").distinct().limit(k + 1).count() - 1)
    settled = []
    while True:
        used = tables if probes < axes else 1
        hashed = written(_hashed(asked, width, tables, float(longest), probes, used), "ann-queries")
        answers = written(_answers(index, hashed, k, width), "ann-answers")
        counts = answers.groupBy("query_id").agg(F.count(F.lit(1)).alias("found"))
        short = asked.join(counts.where(F.col("found") >= full), F.col("vec_id") == F.col("query_id"), "left_anti")
        if probes >= axes or full < 1 or short.isEmpty():
            break
        settled.append(answers.join(counts.where(F.col("found") >= full), "query_id", "left_semi"))
        asked, probes = written(short, "ann-short"), min(axes, WIDER * probes)
    for part in settled:
        answers = answers.unionByName(part)
    return answers


def _answers(index: DataFrame, asked: DataFrame, k: int, width: int) -> DataFrame:
    """query_id, rank, vec_id, score: the best ``k`` of each query among the candidates of its buckets."""
    # tables × signed axes rows, whatever the data: both counts can be broadcast.
    counts = index.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("c_blocks"))
    counts = counts.join(asked.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("q_blocks")), "bucket")
    counts = F.broadcast(counts)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    left = asked.join(counts, "bucket").withColumn("q", own("q_blocks")).withColumn("c", each("c_blocks"))
    right = index.join(counts, "bucket").withColumn("c", own("c_blocks")).withColumn("q", each("q_blocks"))
    keys, fields = ["bucket", "c", "q"], ["bucket", "c", "q", "vec_id", "vector"]
    pairs = left.select(fields).groupBy(keys).cogroup(right.select(fields).groupBy(keys))
    scored = pairs.applyInPandas(_best(k, width), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # The same candidate comes from several tables with the same score.
    return (
        scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
