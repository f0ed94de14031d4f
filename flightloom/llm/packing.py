"""Packing token sequences: shortest pack first over the length histogram.

Documents are cut into pieces of at most ``capacity`` tokens. Only the histogram of piece lengths (``capacity`` numbers,
whatever the corpus holds) reaches the driver; there the lengths are placed, longest first, into the open packs with most
room, as counts of identical patterns. A pattern with its count claims a range of ranks of each length it holds, and pieces
find their sequence by joining their rank among equal lengths with those ranges.

Null texts count as empty: a document always has its closing id, so it always has a piece. Repeated rows are packed each on
its own. A null id sorts first and is packed like any other. Columns other than the two named ones are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed_texts, map_batches, small_batches, written

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
WITH_IDS = PIECES + ", ids array<int>"
#: Pieces of one length that are ranked together, about.
RANK_ROWS = 5_000
#: Entries of a generation of each of a worker's caches.
CACHE = 300_000
#: The same where ids are kept: their batches take the room.
CACHE_WITH_IDS = 100_000
#: Rows of a batch where ids are kept: a worker holds the ids of all of them at once.
ROWS_WITH_IDS = 500
_SPACES = re.compile(r"\s\s")
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_characters() -> dict[int, int]:
    """The characters by which byte-level vocabularies show bytes: printable ones as they are, the others from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def document_ids(path: str, pattern: str, cache_size: int = CACHE) -> Callable[[str], bytes]:
    """A function from text to its ids as little-endian 32-bit integers, by the byte-level tokenizer at ``path``.

    ``pattern`` is the one by which that tokenizer splits. A match starts at each single space between other characters, so
    the stretches between those spaces are encoded on their own and remembered; each match goes through the tokenizer's own
    model. Special tokens in a text are ordinary text. Built once per Python worker, which serves many tasks.
    """
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.normalizer is not None or not all(t.special for t in tokenizer.get_added_tokens_decoder().values()):
        raise ValueError("expected a byte-level tokenizer without a normalizer and without added words")
    split, merge = regex.compile(pattern).findall, tokenizer.model.tokenize
    shown = byte_characters()

    class Remembered(dict):
        """Ids by text, in two generations: a full one becomes the old one, from which texts that occur again come back."""

        def __init__(self, find: Callable[[str], bytes]):
            self.find, self.old = find, {}

        def __missing__(self, text: str) -> bytes:
            ids = self.old.get(text)
            if ids is None:
                ids = self.find(text)
                if len(text) >= 64:
                    return ids
            if len(self) >= cache_size:
                self.old = dict(self)
                self.clear()
            self[text] = ids
            return ids

    def of_match(match: str) -> bytes:
        return array("I", [t.id for t in merge(match.encode().decode("latin-1").translate(shown))]).tobytes()

    matches = Remembered(of_match)

    def of_stretch(stretch: str) -> bytes:
        found = split(stretch)
        return of_match(found[0]) if len(found) == 1 else b"".join([matches[m] for m in found])

    later, first = Remembered(of_stretch), Remembered(of_stretch)

    def encode(text: str) -> bytes:
        if not text:
            return b""
        parts = text.split(" ") if not _SPACES.search(text) and text[-1] != " " else _SAFE_CUT.split(text)
        return first[parts[0]] + b"".join([later[" " + p] for p in parts[1:]])

    return encode


def pieces(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = 1024, closing_id: int = 0, keep_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids with the closing id, cut every ``capacity`` ids. One row per piece, with its ids if asked."""
    small_batches(docs.sparkSession, ROWS_WITH_IDS) if keep_ids else small_batches(docs.sparkSession)
    closing = array("I", [closing_id]).tobytes()

    def make():
        encode = document_ids(tokenizer_path, pattern, CACHE_WITH_IDS if keep_ids else CACHE)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows: list[list] = [[] for _ in range(5)]
            kept: list[bytes] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + closing
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows[0].append(doc_id)
                    rows[1].append(start)
                    rows[2].append(len(part) // 4)
                    rows[3].append(zlib.crc32(part))
                    rows[4].append(total)
                    if keep_ids:
                        kept.append(part)
            columns, names = [pa.array(v, pa.int64()) for v in rows], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                flat = np.frombuffer(b"".join(kept), dtype=np.uint32).astype(np.int32)  # token ids stay far below 2**31
                ends = np.r_[0, np.cumsum(rows[2], dtype=np.int64)].astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names=names)

        return handle

    return map_batches(keyed_texts(docs, id_col, text_col), make, WITH_IDS if keep_ids else PIECES)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) and how many sequences have each. Lengths go longest first into the packs with most room.

    A new pack takes as many pieces of the length at hand as fit. At most ``capacity`` lengths and room sizes exist, so the
    work is bounded by ``capacity`` squared.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    most: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], count: int, left: int) -> None:
        if left:
            if left not in room:
                room[left] = []
                heapq.heappush(most, -left)
            room[left].append((pattern, count))
        else:
            done.append((pattern, count))

    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        while count:
            left = -most[0] if most else 0
            if left < length:
                fit = capacity // length
                full, rest = divmod(count, fit)
                if full:
                    put((length,) * fit, full, capacity - fit * length)
                if rest:
                    put((length,) * rest, 1, capacity - rest * length)
                break
            open_packs = room[left]
            pattern, packs = open_packs.pop()
            taken = min(count, packs)
            if packs > taken:
                open_packs.append((pattern, packs - taken))
            if not open_packs:
                del room[left]
                heapq.heappop(most)
            put((*pattern, length), taken, left - length)
            count -= taken
    return done + [x for packs in room.values() for x in packs]


def _claims(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of each place of each pattern."""
    used: dict[int, int] = {}
    claims, base = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            low = used.get(length, 0)
            used[length] = low + count
            claims.append((length, low, low + count, base, offset))
            offset += length
        base += count
    return claims


def place(cut: DataFrame, capacity: int = 1024) -> DataFrame:
    """Give each piece its sequence and its offset there. ``cut`` must be a written table: it is read several times."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # At most capacity² rows: a length appears in a pattern, and a pattern among the results, boundedly often.
    claims = spark.createDataFrame(_claims(shortest_pack_first(histogram, capacity)) or [(0, 0, 0, 0, 0)],
                                   "c_length long, low long, high long, base long, c_offset long")
    # By each length's own count: of long documents most pieces have the one length ``capacity``.
    salts = spark.createDataFrame([(length, -(-n // RANK_ROWS)) for length, n in histogram.items()] or [(0, 1)], "l_length long, salts long")
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("salts")).alias("salt")
    salted = cut.join(F.broadcast(salts), F.col("length") == F.col("l_length")).select(*cut.columns, salt)
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("length").alias("s_length"), F.col("salt").alias("s_salt"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        salted.withColumn("at", F.row_number().over(order) - 1)
        .join(starts, (F.col("length") == F.col("s_length")) & (F.col("salt") == F.col("s_salt")))
        .withColumn("rank", F.col("first_rank") + F.col("at"))
    )
    claimed = ranked.join(F.broadcast(claims), (F.col("length") == F.col("c_length")) & (F.col("rank") >= F.col("low"))
                          & (F.col("rank") < F.col("high")))
    sequence = (F.col("base") + F.col("rank") - F.col("low")).alias("sequence_id")
    return claimed.select(*cut.columns, sequence, F.col("c_offset").alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = 1024, closing_id: int = 0, keep_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents. One row per piece: doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset."""
    cut = pieces(docs, tokenizer_path, pattern, capacity, closing_id, keep_ids, id_col, text_col)
    return place(written(cut, "packing"), capacity)
