"""Merkle manifest of a dataset, by nested-interval labels.

Every row is a leaf; each group's leaves stand by id, and every ``ARITY`` consecutive nodes become their hash until one, the group's
subroot, remains. The subroots, by group, give the root in the same way. A node carries the interval [lo, hi) of the leaf
ranks it covers. Level k + 1 cuts ranks into buckets of ``ARITY`` ** (k + 1), so a node finds its parent by an equality join on group and
bucket, with containment of its interval; the siblings are what the parent's interval holds besides the node's own. Paths are joined
downwards, from the few nodes at the top to the leaves, so no join repeats a row.

Ranks come from one range partitioning by (group, id, leaf) and the row's place in its sorted partition, so a group that holds a third of
all rows is spread over tasks like any other. Levels are written tables, each a sixteenth of the one before. To the driver come the number
of leaves of the largest group, the row counts of the partitions, and the root.

Null groups are a group of their own, which comes first. Null ids come first in their group; rows that repeat an id stand by
their leaves, and identical rows are neighbouring leaves. Null columns hash as ``-``, empty texts as ``0:``. An empty table gives no rows.
Columns that are not named are not read.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, written

ARITY = 16
#: What a leaf covers, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PLACE_BITS = 33  # monotonically_increasing_id keeps a row's place in its partition in as many low bits
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """A value with its length, so that neighbouring values cannot run together."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def leaf_of(columns: Sequence[str] = LEAF_COLUMNS, changes: dict[str, Callable[[Column], Column]] | None = None) -> Column:
    changes = changes or {}
    return digest(*[framed(changes[c](column(c)) if c in changes else column(c)) for c in columns])


def ranked(rows: DataFrame, purpose: str, order: Sequence[str], group: str = "tree") -> DataFrame:
    """``rows`` written with ``rank`` from 0 by ``order`` in each group, and ``leaves``, the group's number of rows. No group is one task's work."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = rows.withColumn("row_at", F.monotonically_increasing_id()).repartitionByRange(*keys, "row_at").sortWithinPartitions(*keys, "row_at")
    stored = written(dealt.drop("row_at").withColumn("place", F.monotonically_increasing_id()), purpose)
    placed = stored.withColumns({"part": F.shiftright("place", _PLACE_BITS), "at": F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1)})
    # One row for each group and partition that holds some of it: a group's rows in a partition are neighbours.
    spans = placed.groupBy(group, "part").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    spans = spans.select(F.col(group).alias("span_group"), F.col("part").alias("span_part"), "first_at",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"), F.sum("n").over(whole).alias("leaves"))
    joined = placed.join(spans, (F.col(group) == F.col("span_group")) & (F.col("part") == F.col("span_part")))
    return joined.select(*rows.columns, (F.col("first_rank") + F.col("at") - F.col("first_at")).alias("rank"), "leaves")


def levels(leaves: DataFrame, purpose: str) -> list[DataFrame]:
    """Nodes (tree, leaves, lo, hi, digest, children) by level, leaves first, each level written. ``leaves`` holds tree, leaves, rank and digest.

    A tree stops at the level where it has one node. The loop runs once a level: six times for sixteen million leaves.
    """
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    child = F.struct("lo", "hi", "digest")
    built = [leaves.select("tree", "leaves", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest")]
    width = 1
    while width < most:
        below, width = built[-1].where(F.col("leaves") > width), width * ARITY
        # At most ARITY nodes in a group.
        grouped = below.groupBy("tree", "leaves", F.expr(f"lo div {width}").alias("bucket")).agg(F.array_sort(F.collect_list(child)).alias("children"))
        nodes = grouped.select(
            "tree", "leaves", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
            digest(F.array_join(F.transform("children", lambda c: c["digest"]), "")).alias("digest"), "children")
        built.append(written(nodes, f"{purpose}-level"))
    return built


def _step(lo: Column, hi: Column, children: Column) -> Column:
    """The digests of the parent's other children, before and after the node's own interval."""
    joined = lambda holds: F.array_join(F.transform(F.filter(children, holds), lambda c: c["digest"]), "")
    return F.struct(joined(lambda c: c["hi"] <= lo).alias("before"), joined(lambda c: c["lo"] >= hi).alias("after"))


def _below(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """``nodes`` (tree, lo, hi, ...) with the path of each up to its root, by the paths of the parents, whose intervals are ``width`` ranks wide."""
    above = parents.select(F.col("tree").alias("p_tree"), F.expr(f"lo div {width}").alias("p_bucket"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                           F.col("children").alias("p_children"), F.col("path").alias("p_path"), "subroot")
    contained = (F.col("tree") == F.col("p_tree")) & (F.expr(f"lo div {width}") == F.col("p_bucket")) & (F.col("lo") >= F.col("p_lo")) & (F.col("hi") <= F.col("p_hi"))
    own = F.concat(F.array(_step(F.col("lo"), F.col("hi"), F.col("p_children"))), F.col("p_path")).cast(_PATH)
    return nodes.join(above, contained).select(*nodes.columns, own.alias("path"), "subroot")


def paths(leaves: DataFrame, built: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``leaves`` with ``path``, its siblings before and after it from its own level up, and ``subroot``. ``tops`` holds (top_tree, path, subroot)."""
    starts = tops.select("top_tree", "path", "subroot")

    def at_top(nodes: DataFrame, width: int) -> DataFrame:
        return nodes.where(F.col("leaves") <= width).join(starts, F.col("tree") == F.col("top_tree")).drop("top_tree")

    above = None
    for level in range(len(built) - 1, 0, -1):
        width = ARITY**level
        with_path = at_top(built[level].where(F.col("leaves") > width // ARITY), width)
        if above is not None:
            with_path = with_path.unionByName(_below(built[level].where(F.col("leaves") > width), above, width * ARITY))
        above = written(with_path, "merkle-paths")
    spread = leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})
    single = at_top(spread, 1)
    found = single if above is None else single.unionByName(_below(spread.where("leaves > 1"), above, ARITY))
    return found.drop("lo", "hi")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda below, step: digest(step["before"], below, step["after"]))


def proof(path: Column) -> Column:
    """Hash of a path's siblings, left to right and upwards."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def _tops(built: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the last node of each tree."""
    found = built[0].where("leaves = 1").select("tree", "digest")
    for level, nodes in enumerate(built[1:], 1):
        found = found.unionByName(nodes.where(F.col("leaves") <= ARITY**level).select("tree", "digest"))
    return found


def manifest(docs: DataFrame, changed: Column | None = None, columns: Sequence[str] = LEAF_COLUMNS, group_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, path, and ``checked``, the leaf to fold along the path: that of the row as ``changed`` (a leaf; null
    where the row stays) has it."""
    group = F.coalesce(F.concat(F.lit("1"), column(group_col).cast("string")), F.lit("0"))  # nulls first, as text
    leaf = leaf_of(columns)
    hashed = docs.select(group.alias("tree"), column(id_col).cast("long").alias("doc_id"), leaf.alias("digest"), (F.lit(None).cast("string") if changed is None else changed).alias("changed"))
    leaves = written(ranked(hashed, "merkle-sorted", ["doc_id", "digest"]), "merkle-leaves")
    built = levels(leaves, "merkle")
    subroots = _tops(built).select(F.lit("").alias("tree"), F.col("tree").alias("owner"), "digest")
    groups = written(ranked(subroots, "merkle-subroots", ["owner"]), "merkle-groups")
    upper = levels(groups, "merkle-upper")
    root = (_tops(upper).select("digest").first() or [None])[0]
    end = docs.sparkSession.range(1).select(F.lit("").alias("top_tree"), F.array().cast(_PATH).alias("path"), F.lit(root).cast("string").alias("subroot"))
    of_groups = paths(groups, upper, end)
    tops = written(of_groups.select(F.col("owner").alias("top_tree"), "path", F.col("digest").alias("subroot")), "merkle-tops")
    found = paths(leaves, built, tops)
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"), "path",
                        F.coalesce("changed", "digest").alias("checked"))
