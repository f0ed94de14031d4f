"""Ranked lexical search: exact best documents of each item by integer scores, over sparse ball trees.

Items come in blocks of about ``BLOCK_BYTES`` of text, so that what goes to the tasks (an item block, its vocabulary, its counts) is bounded
however many items there are; a block's search covers all documents. Of a document only the terms of the block's items matter to any score, so its
vector holds these; its length and the corpus' counts take all its terms.

Documents are dealt by range on their two heaviest terms, so those that share rare terms stand together, and each stretch of
``TREE_ROWS`` of them becomes a tree (``ball_tree``), stored as one row. A first pass goes greedily to one leaf a tree, which gives every item a score that
at least k documents reach; the second searches all trees with it, best-first, and a task keeps its k best over its trees. The k best of those
k a task are the answer, which is exact: nothing is left out but subtrees whose bound lies below k known scores.

Null, empty and blank texts have no terms and are not counted; items without terms, and an empty table on either side, give no rows. Rows are ranked each on its
own, so rows that repeat an id may both appear; equal scores go by ascending id, null ids last. Items that repeat id and text are one; items
that repeat an id only are searched each for itself. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ball_tree import Search, Tree, Vectors, build
from .common import map_batches, small_batches, written
from .terms import keyed_bodies, terms

#: Bytes of item texts searched at once.
BLOCK_BYTES = 1 << 18
#: Documents of a tree.
TREE_ROWS = 1024
VECTORS = "doc_id long, n long, terms array<int>, tf array<int>"
WEIGHTED = "doc_id long, terms array<int>, component array<int>, heaviest int, second int"


def _vectors(bodies: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document: number of terms, and those of the vocabulary with their occurrences."""
    held = bodies.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        known = held.value.get

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            lengths, found, often = [], [], []
            for body in batch.column(1).to_pylist():
                words = terms(body)
                counts = Counter(map(known, words))
                counts.pop(None, None)
                lengths.append(len(words))
                found.append(list(counts))
                often.append(list(counts.values()))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int32()))],
                                              names=["doc_id", "n", "terms", "tf"])

        return handle

    return map_batches(bodies, make, VECTORS)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def components(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What an occurrence count is worth in a document of ``n`` terms; 64-bit integers throughout."""
    m = 100 - 25 + (25 * n * documents) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _rows(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.offsets.to_numpy().astype(np.int64) - column.offsets[0].as_py(), column.flatten().to_numpy().astype(np.int64)


def _weighted(vectors: DataFrame, weights: np.ndarray, documents: int, total: int) -> DataFrame:
    """The vectors' integer components, with the two terms that weigh most, by which documents are dealt."""

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            start, words = _rows(batch.column(2))
            _, tf = _rows(batch.column(3))
            sizes = np.diff(start)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            value = components(tf, batch.column(1).to_numpy()[owner], documents, total)
            order = np.lexsort((words, -weights[words] * value, owner))
            ranked, heaviest = words[order], np.full((2, len(sizes)), -1, np.int64)
            for place in (0, 1):
                there = np.flatnonzero(sizes > place)
                heaviest[place, there] = ranked[start[there] + place]
            lists = [pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(x, pa.int32())) for x in (words, value)]
            return pa.RecordBatch.from_arrays([batch.column(0), *lists, *(pa.array(h, pa.int32()) for h in heaviest)],
                                              names=["doc_id", "terms", "component", "heaviest", "second"])

        return handle

    return map_batches(vectors.where(F.size("terms") > 0), make, WEIGHTED)


def _trees(weighted: DataFrame) -> DataFrame:
    """One row a tree."""
    # Equal vectors stand together; their hash, not their terms, goes into the sample that finds the ranges.
    keys = [F.col("heaviest"), F.col("second"), F.xxhash64("terms", "component"), F.col("doc_id")]
    dealt = weighted.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column(0)
            start, words = _rows(batch.column(1))
            vectors = Vectors(ids.fill_null(0).to_numpy(), np.array(ids.is_null()), start, words, _rows(batch.column(2))[1])
            return pa.RecordBatch.from_arrays([pa.array([t.pack() for t in build(vectors)], pa.binary())], names=["tree"])

        return handle

    return map_batches(dealt, make, "tree binary")


def _best(trees: DataFrame, counts: np.ndarray, weights: np.ndarray, k: int, least: np.ndarray | None, greedy: bool) -> DataFrame:
    """(query, doc_id, score) of the k best a task has, and what it looked at, as a row of query -1: rows scored as doc_id, rows there as score."""
    held = trees.sparkSession.sparkContext.broadcast((counts, weights, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*held.value[:2], k, held.value[2])
        for batch in batches:
            for data in batch.column(0):
                search.visit(Tree.unpack(data.as_py()), greedy)
        place, query = np.nonzero(search.scores)
        ids = pa.array(np.r_[search.ids[place, query], search.rows_scored], mask=np.r_[search.no_id[place, query], False])
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[query, -1]), ids, pa.array(np.r_[search.scores[place, query], search.rows_seen])], names=["query", "doc_id", "score"])

    return trees.mapInArrow(run, "query long, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.where("query >= 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(bodies: DataFrame, items: list[tuple[int | None, bytes]], k: int) -> tuple[DataFrame, DataFrame]:
    spark = bodies.sparkSession
    counted = [Counter(terms(body)) for _, body in items]
    vocabulary = {word: at for at, word in enumerate(sorted(set().union(*counted)))}
    vectors = written(_vectors(bodies, vocabulary), "lexical-vectors")
    documents, total = vectors.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(vocabulary), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the block's vocabulary
        holding[row["term"]] = row["count"]
    weights = np.array([weight(documents, int(h)) for h in holding], np.int64)
    counts = np.zeros((len(vocabulary), len(items)), np.int64)
    for at, words in enumerate(counted):
        for word, often in words.items():
            counts[vocabulary[word], at] = often
    small_batches(spark, rows=TREE_ROWS)
    trees = written(_trees(_weighted(vectors, weights, documents, total)), "lexical-trees")
    small_batches(spark, rows=1)
    kth = _top(_best(trees, counts, weights, k, None, greedy=True), k).where(F.col("rank") == k)
    least = np.ones(len(items), np.int64)
    for row in kth.select("query", "score").collect():  # one number an item
        least[row["query"]] = row["score"]
    found = written(_best(trees, counts, weights, k, least, greedy=False), "lexical-found")
    small_batches(spark)
    names = spark.createDataFrame([(at, item) for at, (item, _) in enumerate(items)], "item_at long, item_id long")
    top = _top(found, k).join(F.broadcast(names), F.col("query") == F.col("item_at")).select("item_id", "rank", "doc_id", "score")
    return top, found.where("query < 0").select(F.col("doc_id").alias("scored"), F.col("score").alias("pairs"))


def _blocks(benchmark: DataFrame, block_bytes: int, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items, a bounded number at a time; without any that have no terms."""
    items = keyed_bodies(benchmark, id_col, text_col, "item_id").where("octet_length(body) > 0").distinct()
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks)) == block).collect()
        found = sorted(((r["item_id"], bytes(r["body"])) for r in rows), key=lambda i: (i[0] is None, i[0] or 0, i[1]))
        if found := [i for i in found if terms(i[1])]:
            yield found


def _searched(docs, benchmark, k, block_bytes, id_col, text_col, item_col, item_text_col) -> list[tuple[DataFrame, DataFrame]]:
    small_batches(docs.sparkSession)
    bodies = keyed_bodies(docs, id_col, text_col, "doc_id")
    return [_search_block(bodies, items, k) for items in _blocks(benchmark, block_bytes, item_col, item_text_col)]


def search(docs: DataFrame, benchmark: DataFrame, k: int = 20, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per item its ``k`` best documents with a score above 0: item_id, rank (from 1), doc_id, score."""
    found = _searched(docs, benchmark, k, block_bytes, id_col, text_col, item_col, item_text_col)
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, [top for top, _ in found])


def scored_share(docs: DataFrame, benchmark: DataFrame, k: int = 20, block_bytes: int = BLOCK_BYTES) -> float:
    """The share of all (item, document) pairs whose score the second pass computed."""
    found = _searched(docs, benchmark, k, block_bytes, "doc_id", "text", "item_id", "text")
    scored, pairs = reduce(DataFrame.unionByName, [seen for _, seen in found]).agg(F.sum("scored"), F.sum("pairs")).first()
    return scored / max(pairs, 1)
