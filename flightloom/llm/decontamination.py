"""Benchmark decontamination: one Aho-Corasick automaton over the normalised items, documents scanned once.

A window is ``WINDOW`` consecutive words of an item, or all words of a shorter one. The automaton's alphabet is the words of the
windows by number, so a match starts and ends at word bounds, and a document's other words lead back to its root. The
normalised text has the length of the original in bytes, so word offsets lead back to the original (``passages``).

The distinct (window, item) pairs are counted first and cut by hash into blocks of about ``BLOCK_PAIRS``; each block's pairs come to the
driver and go to the tasks, so neither holds more than one block. One block, the usual case, is one scan of the documents; further blocks scan
again, and what they found is united by row. A window may stand in several blocks with different items; that changes nothing.

Null, empty and blank texts have no words: such a document has no hits, such an item no windows. Rows are judged each on its
own, so repeated rows and null ids give rows like any other. Items that repeat an id count as one; an item without an id marks words but is
not counted. Empty tables give no rows, and an empty benchmark no hits. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_batches, written
from .terms import NORMAL, keyed_bodies, terms

#: Words of a window.
WINDOW = 10
#: (window, item) pairs that one automaton holds.
BLOCK_PAIRS = 200_000
_WORD = re.compile(rb"[^ ]+")
_SPANS = "spans array<struct<first:long,end:long>>"


def windows(words: list[bytes], width: int = WINDOW) -> list[bytes]:
    """The windows of an item, each as its words with spaces between."""
    if not words:
        return []
    return [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def window_pairs(benchmark: DataFrame, width: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The distinct pairs (window, item_id)."""

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = {(w, item) for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for w in windows(terms(body), width)}
            each, items = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(each, pa.binary()), pa.array(items, pa.int64())], names=["window", "item_id"])

        return handle

    return map_batches(keyed_bodies(benchmark, id_col, text_col, "item_id"), make, "window binary, item_id long").distinct()


class Windows:
    """An automaton over windows, and the items of each."""

    def __init__(self, pairs: list[tuple[bytes, int | None]]):
        import ahocorasick

        self.number: dict[bytes, int] = {}
        self.items: list[list[int]] = []
        self.lengths: list[int] = []
        at: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for window, item in pairs:
            if window not in at:
                at[window] = len(self.items)
                numbers = tuple(self.number.setdefault(w, len(self.number) + 1) for w in window.split(b" "))
                self.automaton.add_word(numbers, len(self.items))
                self.items.append([])
                self.lengths.append(len(numbers))
            if item is not None:
                self.items[at[window]].append(item)
        self.automaton.make_automaton()

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(first word, word after the last, window) of each occurrence, by its last word."""
        if not self.items:
            return
        number = self.number.get
        for last, window in self.automaton.iter(tuple([number(w, 0) for w in words])):
            yield last + 1 - self.lengths[window], last + 1, window

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The spans of words inside occurrences, apart from each other and in order, and the items that occur."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for first, end, window in self.matches(words):
            found.add(window)
            while spans and spans[-1][1] >= first:
                first = min(first, spans.pop()[0])
            spans.append((first, end))
        return spans, {item for window in found for item in self.items[window]}


def _scan(bodies: DataFrame, pairs: list[tuple[bytes, int | None]], only_hits: bool) -> DataFrame:
    held = bodies.sparkSession.sparkContext.broadcast(pairs)
    kinds = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def make():
        known = Windows(held.value)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, ids, counts, spans, items = [], [], [], [], []
            for row, doc_id, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = terms(body)
                where, which = known.find(words)
                if only_hits and not where:
                    continue
                rows.append(row)
                ids.append(doc_id)
                counts.append(len(words))
                spans.append([{"first": a, "end": b} for a, b in where])
                items.append(sorted(which))
            return pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(spans, kinds), pa.array(items, pa.list_(pa.int64()))],
                names=["row_id", "doc_id", "n_words", "spans", "items"])

        return handle

    return map_batches(bodies, make, f"row_id long, doc_id long, n_words long, {_SPANS}, items array<long>")


def _blocks(benchmark: DataFrame, width: int, block_pairs: int, id_col: str, text_col: str) -> Iterator[list[tuple[bytes, int | None]]]:
    """The pairs, a bounded number at a time."""
    pairs = written(window_pairs(benchmark, width, id_col, text_col), "decontamination-windows")
    blocks = max(1, -(-pairs.count() // block_pairs))
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == block)
        yield sorted(((bytes(r["window"]), r["item_id"]) for r in own.collect()), key=lambda p: (p[0], p[1] is None, p[1] or 0))


def covered(spans: Column) -> Column:
    """How many words stand in any of the spans, which may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def add(seen, span):
        fresh = F.greatest(span["end"] - F.greatest(span["first"], seen["upto"]), F.lit(0).cast("long"))
        return F.struct((seen["n"] + fresh).alias("n"), F.greatest(seen["upto"], span["end"]).alias("upto"))

    return F.aggregate(F.array_sort(spans), start, add, lambda seen: seen["n"])


def mark(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_pairs: int = BLOCK_PAIRS, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence of a window), ``spans`` of such words (first, end exclusive) and
    ``items``, the ids of the items whose windows occur, ascending."""
    small_batches(docs.sparkSession)
    keyed = keyed_bodies(docs, id_col, text_col, "doc_id")
    # By input file and place in it, so the same after a task is run again.
    bodies = keyed.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "body")
    found = [_scan(bodies, block, only_hits=at > 0) for at, block in enumerate(_blocks(benchmark, width, block_pairs, item_col, item_text_col))]
    marked = found[0]
    if len(found) > 1:
        # At most one row a block and document.
        marked = reduce(DataFrame.unionByName, found).groupBy("row_id").agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return marked.select("doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), "spans", "items")


def passages(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_pairs: int = BLOCK_PAIRS, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every occurrence in the original text: doc_id, item_id, start and end (code points, end exclusive) and the passage itself. Overlapping
    and adjoining windows of one item are one passage."""
    small_batches(docs.sparkSession)
    bodies = keyed_bodies(docs, id_col, text_col, "doc_id")
    kinds = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("passage", pa.string())])

    def scan(pairs):
        held = bodies.sparkSession.sparkContext.broadcast(pairs)

        def make():
            known = Windows(held.value)

            def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
                rows = []
                for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    runs: dict[int, list[list[int]]] = {}
                    for first, end, window in known.matches(terms(body)):
                        for item in known.items[window]:
                            own = runs.setdefault(item, [])
                            while own and own[-1][1] >= first:
                                first = min(first, own.pop()[0])
                            own.append([first, end])
                    if not runs:
                        continue
                    places = [m.span() for m in _WORD.finditer(body.translate(NORMAL))]
                    for item, own in runs.items():
                        for first, end in own:
                            low, high = places[first][0], places[end - 1][1]
                            passage, start = body[low:high].decode(), len(body[:low].decode())
                            rows.append({"doc_id": doc_id, "item_id": item, "start": start, "end": start + len(passage), "passage": passage})
                return pa.RecordBatch.from_pylist(rows, kinds)

            return handle

        return map_batches(bodies, make, "doc_id long, item_id long, start long, end long, passage string")

    return reduce(DataFrame.unionByName, [scan(block) for block in _blocks(benchmark, width, block_pairs, item_col, item_text_col)])
