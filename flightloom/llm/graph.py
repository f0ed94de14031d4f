"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _contracted(batches):
    """Each node of a partition's edges with the smallest node it reaches inside the partition."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [n for n in parent if parent[n] != n]
    for at in range(0, len(nodes), 10_000):
        some = nodes[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([root(n) for n in some], pa.int64())], names=["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges`` that is not its component's smallest. The component is that smallest node.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller ones; both are map-side minima and a join
    whose hot keys adaptive execution splits. Rounds are written out, so lineage stays short. The number of rounds grows with the
    logarithm of the longest path. Null ends and self loops are ignored.
    """
    start = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    start = start.where("u != v")
    current = written(start.mapInArrow(_contracted, "u long, v long").distinct(), "components")
    mark = _fingerprint(current)
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        following = written(hung.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "components")
        new_mark = _fingerprint(following)
        if new_mark == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        current, mark = following, new_mark


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum("v")).first())
