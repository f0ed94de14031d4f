"""N-gram Jaccard self-join: size-aware, with light and heavy sets.

A document's set holds its distinct shingles of ``SHINGLE`` words, A-Z lower-cased. Two documents link when
``100 * common >= percent * union``. The result is the components of these links.

* Equal sets are one class, so copies cost nothing further.
* Light sets are small: every subset of the size that a link with a partner of each possible size needs is enumerated, so no link
  with a light set can be missed. A set is light up to the size at which that takes more subsets than a heavy set has, so the
  boundary follows from the cost.
* Heavy sets would have astronomically many such subsets. They enumerate ``TABLES`` subsets of ``SUBSET`` shingles each: the smallest
  ones under as many fixed orders. Two large sets with a Jaccard index of 0.75 share each one with probability 0.316, the smallest
  heavy ones (9 of 12 shingles common) with 0.254, so linked sets miss all with probability below 1e-6, most far more rarely, as far
  as the orders are independent. The inverted lists of these subsets are scanned.
* Lists are scanned by stars first: every member against two centers of its list, by exact sets. What is linked needs no
  further pairs, so a list of thousands of near copies takes thousands of pairs, not millions. Here a pair with fewer than
  ``LEAST_COMMON`` common subsets may be passed over, since the next step decides it again.
* Lists that still hold several components are then scanned whole, in blocks of bounded size that meet pairwise: members outside
  the block's main component count their common shingles with all others by the full sets, and one link per pair of components leaves
  the block.

Shingles are compared by 64-bit hashes. A text of fewer than five words has one shingle, all of it. Null and empty texts, and texts
without words, have no shingles and link with nothing. Rows that repeat an id count as one document with several sets. A row with a null id
links with nothing and has a null component. Only the two named columns are read.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keyed_texts, map_batches, small_batches, word_list, written
from .graph import components
from .substring_dedup import group_hashes, word_hashes

SHINGLE = 5
PERCENT = 75
TABLES = 48
SUBSET = 4
LEAST_COMMON = 3
#: Members of a list, and bytes of their sets, that a task holds at a time for each side of a pair of blocks.
BLOCK = 2_000
BLOCK_BYTES = 16 << 20
_ORDERS = np.random.default_rng(20_240_301).integers(1 << 62, (1 << 63) - 1, TABLES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = np.random.default_rng(20_240_302).integers(0, (1 << 63) - 1, TABLES, dtype=np.int64).astype(np.uint64)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    if not text:
        return np.zeros(0, np.uint64)
    words = word_hashes(word_list(text.encode().lower().decode()))
    if len(words) == 0:
        return words
    return np.unique(group_hashes(words, min(size, len(words))))


def needed(a: int, b: int, percent: int = PERCENT) -> int:
    """Common elements that sets of these sizes need for a link."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(size: int, percent: int = PERCENT) -> range:
    return range(-(-size * percent // 100), size * 100 // percent + 1)


def subset_sizes(size: int, light: int, percent: int = PERCENT) -> list[int]:
    """Sizes of the subsets by which a set finds partners where one of the two is light."""
    return sorted({needed(size, other, percent) for other in partner_sizes(size, percent) if other and min(size, other) <= light})


def light_limit(tables: int = TABLES, percent: int = PERCENT) -> int:
    """The largest size up to which enumerating all subsets costs no more than the heavy way."""
    size = 0
    while sum(comb(size + 1, c) for c in subset_sizes(size + 1, size + 1, percent)) <= tables:
        size += 1
    return size


LIGHT = light_limit()


def signatures(shingles: np.ndarray, light: int = LIGHT) -> tuple[np.ndarray, bytes]:
    """Keys of a set's subsets, and 16-bit fingerprints of the heavy ones (empty for a light set)."""
    n, keys = len(shingles), []
    for size in subset_sizes(n, light) if n * PERCENT <= light * 100 else []:
        for chosen in combinations(shingles.tolist(), size):
            keys.append(xxhash.xxh3_64_intdigest(np.array(chosen, np.uint64).tobytes(), seed=size))
    enumerated = np.array(keys, np.uint64)
    if n <= light:
        return enumerated, b""
    heavy = np.empty(TABLES, np.uint64)
    rows = max(1, 2_000_000 // n)
    for low in range(0, TABLES, rows):
        turned = shingles[None, :] * _ORDERS[low : low + rows, None]
        least = np.sort(np.partition(turned, SUBSET - 1, axis=1)[:, :SUBSET], axis=1)
        key = _SALTS[low : low + rows].copy()
        for k in range(SUBSET):
            key = (key ^ least[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        heavy[low : low + rows] = key
    return np.r_[enumerated, heavy], (heavy >> np.uint64(20)).astype(np.uint16).tobytes()


def describe(keyed: DataFrame) -> DataFrame:
    """Per row: doc_id, set size, two hashes of the set, subset keys, fingerprints."""

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, first, second, prints, keys, ends = [], [], [], [], [], [0]
            for text in batch.column(1).to_pylist():
                shingles = shingle_set(text)
                found, marks = signatures(shingles) if len(shingles) else (np.zeros(0, np.uint64), b"")
                data = shingles.tobytes()
                sizes.append(len(shingles))
                first.append(xxhash.xxh3_64_intdigest(data) - (1 << 63))
                second.append(xxhash.xxh3_64_intdigest(data, seed=1) - (1 << 63))
                prints.append(marks)
                keys.append(found)
                ends.append(ends[-1] + len(found))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), lists, pa.array(prints, pa.binary())],
                                              names=["doc_id", "n", "h1", "h2", "keys", "prints"])

        return handle

    return map_batches(keyed, make, "doc_id long, n long, h1 long, h2 long, keys array<long>, prints binary")


def _alike(x: pa.RecordBatch) -> pa.Array:
    """For rows (n, prints, other n, other prints): may the two link? By size, and by common subsets where both sets are heavy."""
    n, m = x.column(2).to_numpy(), x.column(4).to_numpy()
    keep = np.minimum(n, m) * 100 >= np.maximum(n, m) * PERCENT
    for i in np.flatnonzero(keep):
        a, b = x.column(3)[int(i)].as_py(), x.column(5)[int(i)].as_py()
        if a and b:
            keep[i] = (np.frombuffer(a, np.uint16) == np.frombuffer(b, np.uint16)).sum() >= LEAST_COMMON
    return pa.array(keep)


def _promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass ``_alike``."""
    side = lambda name: classes.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("prints").alias(f"p_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "p_a", "n_b", "p_b")

    def run(batches):
        for batch in batches:
            yield batch.filter(_alike(batch)).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that link, by their exact sets."""
    side = lambda name: sets.select(F.col("id").alias(name), F.col("shingles").alias(f"s_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b")

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _scan_block(rows: list[tuple[int, int, int, int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links between components of one pair of blocks. Rows: part, other part, id, component, set size, shingles."""
    if len(rows) < 2:
        return []
    part, _, ids, comp, n = (np.array(c) for c in list(zip(*rows, strict=True))[:5])
    if (comp == comp[0]).all():
        return []
    one_block = rows[0][0] == rows[0][1] and (part == part[0]).all()
    labels, counts = np.unique(comp, return_counts=True)
    main = labels[counts.argmax()]
    order = np.argsort(comp == main, kind="stable")
    joined = np.concatenate([r[5] for r in rows])
    ends = np.cumsum([len(r[5]) for r in rows])
    starts = ends - np.array([len(r[5]) for r in rows])
    _, local = np.unique(joined, return_inverse=True)
    own = np.zeros(int(local.max()) + 1, dtype=bool)
    found = []
    for i in order:
        # Components merge while the list is scanned, so a member may have joined the main one since; those after it may not have.
        if comp[i] == main:
            continue
        mine = local[starts[i] : ends[i]]
        own[mine] = True
        common = np.add.reduceat(own[local].astype(np.int32), starts)
        own[mine] = False
        linked = (100 * common >= PERCENT * (n[i] + n - common)) & (comp != comp[i])
        if not one_block:
            linked &= part != part[i]
        for label in np.unique(comp[linked]):
            j = np.flatnonzero(linked & (comp == label))[:1]
            if len(j):
                found.append((min(ids[i], ids[j[0]]), max(ids[i], ids[j[0]])))
                if comp[i] == main or label == main:
                    comp[(comp == label) | (comp == comp[i])] = main
                else:
                    comp[comp == label] = comp[i]
                linked &= comp != comp[i]
    return found


def _blocks(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect different components of one list; lists are cut into blocks that meet pairwise."""
    rows = lists.join(sets.select("id", F.octet_length("shingles").alias("bytes")), "id")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int")
    sizes = rows.groupBy("key").agg(parts.alias("parts"))
    dealt = lists.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # A member meets every block of its list once.
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "id", "component")
    full = dealt.join(sets.select("id", "n", "shingles"), "id").select("key", "low", "high", "part", "id", "component", "n", "shingles")
    ordered = full.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def run(batches):
        current, held = None, []
        for batch in batches:
            found = []
            columns = [c.to_pylist() for c in batch.columns]
            for key, low, high, part, doc, component, n, shingles in zip(*columns, strict=True):
                if (key, low, high) != current:
                    found += _scan_block(held)
                    current, held = (key, low, high), []
                held.append((part, high if part == low else low, doc, component, n, np.frombuffer(shingles, np.uint64)))
            if found:
                yield _pairs(found)
        if found := _scan_block(held):
            yield _pairs(found)

    return ordered.mapInArrow(run, "a long, b long").distinct()


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(map(int, a), pa.int64()), pa.array(map(int, b), pa.int64())], names=["a", "b"])


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    keyed = keyed_texts(docs, id_col, text_col)
    described = written(describe(keyed), "ngram-documents")
    linkable = described.where("n > 0 and doc_id is not null")
    classes = linkable.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("prints").alias("prints"), F.first("keys").alias("keys"))
    classes = written(classes, "ngram-classes")
    each = classes.select("id", F.explode("keys").alias("key"))
    ends = each.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.min(F.struct(F.xxhash64("id"), "id")).alias("any")).where("lo < hi").drop("hi")
    lists = written(each.join(ends, "key").select("key", "id", "lo", F.col("any.id").alias("any")).distinct(), "ngram-lists")
    # Two centers a list: its smallest document, and one that no order favours.
    stars = [lists.where(F.col("id") != F.col(c)).select(F.least("id", c).alias("a"), F.greatest("id", c).alias("b")) for c in ("lo", "any")]
    promising = written(_promising(stars[0].union(stars[1]).distinct(), classes), "ngram-pairs")
    sets = _sets_of(keyed, lists)
    links = written(_linked(promising, sets), "ngram-links")
    current = components(links)
    labelled = lists.select("key", "id").join(current.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    rest = written(_blocks(written(labelled.join(mixed, "key"), "ngram-mixed"), sets), "ngram-links")
    current = components(links.union(rest))
    members = described.select("doc_id", "n", "h1", "h2").join(classes.select("h1", "h2", "id"), ["h1", "h2"], "left").join(current, F.col("id") == F.col("node"), "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id")).otherwise(F.col("doc_id"))
    return members.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _sets_of(keyed: DataFrame, lists: DataFrame) -> DataFrame:
    """(id, n, shingles) of the documents that occur in a list, one row for each of its texts."""
    wanted = keyed.join(lists.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingle_set(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["id", "n", "shingles"])

        return handle

    return written(map_batches(wanted, make, "id long, n long, shingles binary"), "ngram-sets")
