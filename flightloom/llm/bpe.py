"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a doubly linked list of tokens. Every adjacent pair that can merge waits in the bucket of its merge rank, and
a two-level bitmap says which buckets hold something: find-first-set on the upper level, then on the lower one, gives the
lowest rank. Entries are never removed when a neighbour merges; one whose pair has changed is skipped when it comes up.
Each merge costs a few integer operations and a push into a small heap of positions, so a pre-token of n bytes takes
O(n log n), however long it is.

Null texts count as empty: no ids, empty bytes. Rows are independent, so repeated rows and null ids need no rule, and columns
other than the two named ones are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from heapq import heappop, heappush
from operator import or_

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import keyed_texts, map_batches, small_batches

#: Plain words that each generation of a worker's cache holds.
CACHE = 350_000
#: Below this character ``str.isalpha`` and the pattern's letters are the same in every Unicode version.
_PLAIN_BELOW = "\u0250"
_SPACES = re.compile(r"\s\s")
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
ENCODED = "doc_id long, ids binary"


class Vocabulary:
    """Ranks of byte strings, and the pairs of ids that may merge."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.token_of = {rank: token for token, rank in self.ranks.items()}
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 20 | right] = rank
        self.of_byte = [self.ranks[bytes([b])] for b in range(256)]
        self.as_left = {rank: rank << 20 for rank in self.of_byte}
        # The queue; empty between two calls.
        size = max(self.token_of) + 1
        self.buckets: list[list[int]] = [[] for _ in range(size)]
        self.lower = [0] * (size // 256 + 1)
        self.bit = [1 << i for i in range(max(256, len(self.lower)))]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: always the lowest rank first, leftmost among equals."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        pair, buckets, lower, bit = self.pairs.get, self.buckets, self.lower, self.bit
        n, upper = len(piece), 0
        ids = [*map(self.of_byte.__getitem__, piece)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_at = [*map(pair, map(or_, map(self.as_left.__getitem__, ids), ids[1:])), None]
        for at, rank in enumerate(rank_at):
            if rank is not None:
                bucket = buckets[rank]
                if not bucket:
                    block = rank >> 8
                    lower[block] |= bit[rank & 255]
                    upper |= bit[block]
                bucket.append(at)
        while upper:
            block = (upper & -upper).bit_length() - 1
            bits = lower[block]
            rank = block << 8 | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            at = heappop(bucket) if len(bucket) > 1 else bucket.pop()
            if not bucket:
                lower[block] = bits = bits & (bits - 1)
                if not bits:
                    upper &= upper - 1
            if rank_at[at] != rank:
                continue
            gone = after[at]
            ids[at] = rank
            rank_at[gone] = None
            after[at] = right = after[gone]
            left = before[at]
            if right < n:
                before[right] = at
                rank_at[at] = new = pair(rank << 20 | ids[right])
                if new is not None:
                    bucket = buckets[new]
                    if bucket:
                        heappush(bucket, at)
                    else:
                        bucket.append(at)
                        block = new >> 8
                        lower[block] |= bit[new & 255]
                        upper |= bit[block]
            else:
                rank_at[at] = None
            if left >= 0:
                rank_at[left] = new = pair(ids[left] << 20 | rank)
                if new is not None:
                    bucket = buckets[new]
                    if bucket:
                        heappush(bucket, left)
                    else:
                        bucket.append(left)
                        block = new >> 8
                        lower[block] |= bit[new & 255]
                        upper |= bit[block]
        out, at = [], 0
        while at < n:
            out.append(ids[at])
            at = after[at]
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that little-endian 32-bit ids stand for."""
        token_of = self.token_of
        return b"".join([token_of[i] for i in array("I", ids)])


def text_encoder(vocabulary: Vocabulary, pattern: str, cache_size: int = CACHE) -> Callable[[str], bytes]:
    """Ids of a text as little-endian 32-bit integers; each match of ``pattern`` is encoded on its own.

    A single space between two other characters always starts a match, so the stretches between those spaces are encoded
    apart. A stretch of letters is one match with its space. Matches are remembered, and so are short stretches of several.
    """
    import regex

    find, merge = regex.compile(pattern).findall, vocabulary.encode
    others: dict[str, bytes] = {}  # matches and stretches that are not plain words

    class Stretches(dict):
        """Plain words by what follows their space, in two generations: a full one becomes the old one, from which words that
        occur again come back."""

        old: dict[str, bytes] = {}

        def __missing__(self, stretch: str) -> bytes:
            if not (stretch.isalpha() and max(stretch) < _PLAIN_BELOW):
                return mixed(stretch)
            ids = self.old.get(stretch)
            if ids is None:
                ids = array("I", merge(b" " + stretch.encode())).tobytes()
            if len(self) >= cache_size:
                self.old = dict(self)
                self.clear()
            if len(stretch) < 64:
                self[stretch] = ids
            return ids

    def mixed(stretch: str) -> bytes:
        whole = " " + stretch
        ids = others.get(whole)
        if ids is not None:
            return ids
        before, ids = len(others), b""
        for match in find(whole):
            plain = match[0] == " " and match[1:].isalpha() and max(match) < _PLAIN_BELOW
            ids += later[match[1:]] if plain else other(match)
        if len(others) == before and len(whole) < 24:
            remember(whole, ids)
        return ids

    def other(match: str) -> bytes:
        ids = others.get(match)
        if ids is None:
            ids = array("I", merge(match.encode())).tobytes()
            if len(match) < 64:
                remember(match, ids)
        return ids

    def remember(text: str, ids: bytes) -> None:
        if len(others) >= cache_size // 3:
            others.clear()
        others[text] = ids

    later = Stretches()

    def encode(text: str) -> bytes:
        if not text:
            return b""
        parts = text.split(" ") if not _SPACES.search(text) and text[-1] != " " else _SAFE_CUT.split(text)
        return b"".join([*map(other, find(parts[0])), *map(later.__getitem__, parts[1:])])

    return encode


@lru_cache(maxsize=2)
def _vocabulary_of_worker(ranks_path: str) -> Vocabulary:
    """Built once per Python worker, which serves many tasks."""
    return Vocabulary(ranks_path)


@lru_cache(maxsize=2)
def _encoder_of_worker(ranks_path: str, pattern: str) -> Callable[[str], bytes]:
    return text_encoder(_vocabulary_of_worker(ranks_path), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and its ids as little-endian 32-bit integers."""
    small_batches(docs.sparkSession)

    def make():
        to_ids = _encoder_of_worker(ranks_path, pattern)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [to_ids(t or "") for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

        return handle

    return map_batches(keyed_texts(docs, id_col, text_col), make, ENCODED)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Inverse of ``encode``: doc_id, ids and the bytes they stand for. Null ids give empty bytes."""

    def make():
        vocabulary = _vocabulary_of_worker(ranks_path)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [x or b"" for x in batch.column(1).to_pylist()]
            texts = pa.array([vocabulary.decode(x) for x in ids], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), texts],
                                              names=["doc_id", "ids", "decoded"])

        return handle

    return map_batches(encoded.select("doc_id", "ids"), make, ENCODED + ", decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode`` of ``encode`` in one pass over the documents: doc_id, ids, and the bytes that the ids stand for."""
    small_batches(docs.sparkSession)

    def make():
        vocabulary, to_ids = _vocabulary_of_worker(ranks_path), _encoder_of_worker(ranks_path, pattern)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [to_ids(t or "") for t in batch.column(1).to_pylist()]
            decoded = pa.array([vocabulary.decode(x) for x in ids], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), decoded], names=["doc_id", "ids", "decoded"])

        return handle

    return map_batches(keyed_texts(docs, id_col, text_col), make, ENCODED + ", decoded binary")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
