"""What the two vector operators share: which vectors take part, and their columns in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and every component there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def keyed_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Only id and vector, under fixed names, in double precision."""
    return table.select(column(id_col).cast("long").alias("vec_id"), column(vector_col).cast("array<double>").alias("vector"))


def widths(vectors: DataFrame) -> list[int]:
    """The lengths of usable vectors, ascending. Vectors of different lengths have no product, so each length is work of its own."""
    return sorted(r["w"] for r in vectors.where(usable(F.col("vector"))).select(F.size("vector").alias("w")).distinct().collect())


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """A list column, all of one length, as rows of a matrix."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
