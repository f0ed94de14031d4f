"""Near-duplicate vectors: PCA-ordered tiled comparison of unit vectors.

Vectors are turned into their principal axes, by the covariance of all of them, so that the leading dimensions tell most. A pair of
tiles adds up products of the leading dimensions first; what the rest can still add is at most the product of the two
suffix norms (Cauchy-Schwarz), and a pair stops as soon as its cosine cannot reach the threshold. Tiles are cells of a grid over the
``LEADING`` first axes: linked vectors lie at most ``sqrt(2 - 2 threshold)`` apart on each axis, so only neighbouring cells meet. A
cell with more than ``TILE`` vectors is dealt over several tiles.

Equal vectors are one class with a weight. A pair of tiles returns one row per vector that has links there: the weight of its links
and the smallest vector it is connected with, never the pairs themselves. Components follow from those rows. The final decision
for a pair within ``1e-9`` of the threshold is its cosine by the plain formula.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their own component. Vectors of different
lengths have no cosine: each length is compared by itself, in as many runs as there are lengths. Rows that repeat an id and a vector are vectors each on
their own; ids that repeat with different vectors share links and component. A row with a null id links with nothing and has a null
component. Only the two named columns are read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_batches, written
from .graph import components
from .vectors import keyed_vectors, matrix, usable, widths

THRESHOLD = 0.95
TILE = 4096
LEADING = 2
_SLACK = 1e-9
_CHUNK = 512


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns, largest variance first. Width squared numbers come to the driver."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = _units(matrix(batch.column(0), width))
            total += x.T @ x
        at = np.arange(width * width)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "value"])

    sums = vectors.select("vector").mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    moments = np.zeros(width * width)
    for row in sums:
        moments[row["at"]] = row["value"]
    _, axes = np.linalg.eigh(moments.reshape(width, width))
    return np.ascontiguousarray(axes[:, ::-1])


def linked(x: np.ndarray, y: np.ndarray, threshold: float, plain_x: np.ndarray, plain_y: np.ndarray) -> np.ndarray:
    """Which rows of ``x`` and ``y`` (unit vectors, leading axes first) have a cosine of at least ``threshold``."""
    width = x.shape[1]
    cuts = [c for c in (8, 16, 32) if c < width] + [width]
    rest = lambda m, cut: np.sqrt(np.maximum((m[:, cut:] ** 2).sum(axis=1), 0))
    out = np.zeros((len(x), len(y)), dtype=bool)
    for low in range(0, len(x), _CHUNK):
        part = x[low : low + _CHUNK]
        dense = part[:, : cuts[0]] @ y[:, : cuts[0]].T
        row, col = np.nonzero(dense + rest(part, cuts[0])[:, None] * rest(y, cuts[0])[None, :] >= threshold - _SLACK)
        if len(row) > dense.size // 8:
            total = part @ y.T
            row, col = np.nonzero(total >= threshold - _SLACK)
            total = total[row, col]
        else:
            total = dense[row, col]
            for start, cut in zip(cuts, cuts[1:], strict=False):
                total = total + np.einsum("ij,ij->i", part[row, start:cut], y[col, start:cut])
                alive = total + rest(part, cut)[row] * rest(y, cut)[col] >= threshold - _SLACK
                row, col, total = row[alive], col[alive], total[alive]
        sure = total >= threshold + _SLACK
        for i in np.flatnonzero(~sure):
            a, b = plain_x[low + row[i]], plain_y[col[i]]
            sure[i] = float(a @ b) / (float(np.sqrt(a @ a)) * float(np.sqrt(b @ b))) >= threshold
        out[low + row[sure], col[sure]] = True
    return out


def _labels(links: np.ndarray, x_ids: np.ndarray, y_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column is connected with by ``links``."""
    while True:
        top = np.iinfo(np.int64).max
        new_x = np.minimum(x_ids, np.where(links, y_ids[None, :], top).min(axis=1))
        new_y = np.minimum(y_ids, np.where(links, new_x[:, None], top).min(axis=0))
        if (new_x == x_ids).all() and (new_y == y_ids).all():
            return x_ids, y_ids
        x_ids, y_ids = new_x, new_y


def _compare(pairs: DataFrame, width: int, axes: np.ndarray, threshold: float) -> DataFrame:
    """Rows of two tiles each: for every vector with links between them its id, their weight, and its smallest connected id."""

    def tile(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        members = column.flatten()
        return members.field("id").to_numpy(), members.field("n").to_numpy(), matrix(members.field("vector"), width)

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            outs = []
            for at in range(batch.num_rows):
                x_id, x_n, x = tile(batch.column(1).slice(at, 1))
                y_id, y_n, y = tile(batch.column(2).slice(at, 1))
                one = batch.column(0)[at].as_py()
                links = linked(_units(x) @ axes, _units(y) @ axes, threshold, x, y)
                if one:
                    np.fill_diagonal(links, False)
                rows, cols = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
                if not len(rows):
                    continue
                links = links[np.ix_(rows, cols)]
                low_x, low_y = _labels(links, x_id[rows], y_id[cols])
                outs.append((x_id[rows], links @ y_n[cols], low_x))
                if not one:
                    outs.append((y_id[cols], x_n[rows] @ links, low_y))
            if not outs:
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*outs, strict=True)], names=["id", "links", "low"])

        return handle

    return map_batches(pairs, make, "id long, links long, low long")


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", tile: int = TILE) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id, kept."""
    spark = table.sparkSession
    small_batches(spark)
    vectors = keyed_vectors(table, id_col, vector_col)
    lengths = widths(vectors)
    if len(lengths) > 1:
        used = usable(F.col("vector"))
        parts = [vectors.where(used & (F.size("vector") == w)) for w in lengths] + [vectors.where(~used)]
        return reduce(DataFrame.unionByName, [near_duplicates(part, threshold, "vec_id", "vector", tile) for part in parts])
    width = lengths[0] if lengths else 0
    good = F.col("vec_id").isNotNull() & usable(F.col("vector")) & (F.size("vector") == width)
    keyed = vectors.select("vec_id", "vector", F.when(good, F.xxhash64("vector")).alias("h1"), F.when(good, F.xxhash64(F.lit(1), "vector")).alias("h2"))
    classes = keyed.where("h1 is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    classes = written(classes, "vector-classes")
    if not width:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    axes = principal_axes(classes, width)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            lead = _units(matrix(batch.column(2), width)) @ axes[:, :LEADING]
            cells = np.floor(lead / reach).astype(np.int32)
            if cells.shape[1] < LEADING:
                cells = np.pad(cells, ((0, 0), (0, LEADING - cells.shape[1])))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells[:, 0]), pa.array(cells[:, 1])], names=["id", "n", "vector", "cx", "cy"])

        return handle

    placed = written(map_batches(classes.select("id", "n", "vector"), make, "id long, n long, vector array<double>, cx int, cy int"), "vector-cells")
    # The grid has at most (2 / reach + 2)^LEADING cells: the counts can be broadcast.
    counts = placed.groupBy("cx", "cy").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    member = F.struct("id", "n", "vector")
    dealt = placed.join(F.broadcast(counts), ["cx", "cy"]).withColumn("salt", F.pmod(F.xxhash64("id", "vector"), F.col("tiles")).cast("int"))
    tiles = written(dealt.groupBy("cx", "cy", "salt").agg(F.collect_list(member).alias("members")), "vector-tiles")
    names = tiles.select("cx", "cy", "salt")
    # Half of the neighbourhood: each pair of cells meets once.
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    near = names.withColumn("s", F.explode(steps)).select("cx", "cy", "salt", (F.col("cx") + F.col("s.dx")).alias("ox"), (F.col("cy") + F.col("s.dy")).alias("oy"))
    other = names.select(F.col("cx").alias("ox"), F.col("cy").alias("oy"), F.col("salt").alias("osalt"))
    same_cell = (F.col("cx") == F.col("ox")) & (F.col("cy") == F.col("oy"))
    pairs = near.join(other, ["ox", "oy"]).where(~same_cell | (F.col("salt") <= F.col("osalt"))).withColumn("one", same_cell & (F.col("salt") == F.col("osalt")))
    right = tiles.select(F.col("cx").alias("ox"), F.col("cy").alias("oy"), F.col("salt").alias("osalt"), F.col("members").alias("others"))
    full = pairs.join(tiles, ["cx", "cy", "salt"]).join(right, ["ox", "oy", "osalt"]).select("one", "members", "others")
    small_batches(spark, rows=4)
    found = written(_compare(full, width, axes, threshold), "vector-links")
    small_batches(spark)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found, "id", "low")
    resolved = classes.select("h1", "h2", "id", "n").join(links, "id", "left").join(joined, F.col("id") == F.col("node"), "left")
    resolved = resolved.select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component"))
    rows = keyed.select("vec_id", "h1", "h2").join(resolved, ["h1", "h2"], "left")
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")
    )
