"""Substring dedup: suffix automata of reference shards, matching statistics of the documents.

A window is ``window`` consecutive words of one document. Every word is removed that lies in a window whose words also start in
a document with a smaller id. Windows are judged on the input, not on what is left.

1. Anchors. Each window's anchor is its word group (``GRAM`` words) with the smallest hash; equal windows have equal anchors, and
   neighbouring windows mostly share one, so a document has few. Anchors are grouped by hash: one that occurs in a single
   document proves all its windows unique, and the first document of any other one is known from a map-side minimum.
2. Reference shards. The windows around a shared anchor in its first document are reference text; those in later documents are
   queries. A first document is cut into stretches by where its anchors first stand; shards collect some stretches and hold about
   ``SHARD_WINDOWS`` windows, so an automaton has a bounded size however long one document is. Windows that a long document
   repeats within itself are reference text once. A shard with more queries than one task should stream gets several tasks, each with its own copy of the
   automaton: a common passage is no hot spot. Queries stream past; matching statistics at least ``window`` long whose
   owner is a smaller document mark a window.
3. The rest. A query window that its shard does not hold may still stand in another document with that anchor. These windows go by
   a 128-bit hash to one more minimum. So all windows are decided, whatever the data look like.

Anchors and hashes that stand in very many places get their first document by a broadcast (``hot``), so no task gathers them.

Words are compared by 64-bit hashes. Null and short texts have no windows. Rows with a null id are returned as they are and remove
nothing. Rows that repeat an id are one document as far as order goes: they do not remove from each other, and each is cut by its
own words. Only the two named columns are read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import keyed_texts, map_batches, small_batches, word_list, written
from .hot import join_facts

WINDOW = 50
GRAM = 20
SHARD_WINDOWS = 60_000
#: Stretches of a document in a shard, if it had to hold that document alone.
STRETCHES = 8
TASK_WINDOWS = 1_000_000
_CACHE = 300_000
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def _hashes_of_worker() -> _Hashes:
    return _Hashes()


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes_of_worker().__getitem__, words), np.uint64, len(words))


def group_hashes(words: np.ndarray, size: int, multiplier: int = _MULTIPLIERS[0]) -> np.ndarray:
    """A mixed polynomial hash of every ``size`` consecutive words, by doubling."""
    powers, result, done = multiplier, None, 0
    block, length = words, 1
    while True:
        if size & length:
            if result is None:
                result, done = block, length
            else:
                n = len(words) - done - length + 1
                result = result[:n] * np.uint64(powers) + block[done : done + n]
                done += length
        if done == size:
            break
        block = block[:-length] * np.uint64(powers) + block[length:]
        length, powers = 2 * length, powers * powers & 0xFFFFFFFFFFFFFFFF
    result = result ^ (result >> np.uint64(31))
    result = result * np.uint64(0xBF58476D1CE4E5B9)
    return result ^ (result >> np.uint64(29))


def anchors(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first window and number of windows of each anchor, in text order."""
    hashes = group_hashes(words, gram)
    at = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << 20) - 1)
    keys = (hashes & ~low) | (at & low)
    span, width = window - gram + 1, 1
    least = keys
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(keys) - span + 1], least[span - width : span - width + len(keys) - span + 1])
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    counts = np.diff(np.r_[starts, len(least)])
    first = starts.astype(np.int64)
    position = first + ((least[starts] & low).astype(np.int64) - first) % (1 << 20)
    return hashes[position], first, counts


_ANCHORS = "doc_id long, key long, anchors array<struct<hash:long,first:int,n:int>>"


def _text_key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def find_anchors(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    """Per document with at least one window: its id, a hash of its text, and its anchors."""
    kind = pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            ids, keys, ends = [], [], [0]
            parts: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = word_list(text)
                if doc_id is None or len(words) < window:
                    continue
                parts.append(anchors(word_hashes(words), window, gram))
                ids.append(doc_id)
                keys.append(_text_key(text))
                ends.append(ends[-1] + len(parts[-1][0]))
            if not ids:
                return None
            hashes, first, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            values = pa.StructArray.from_arrays([pa.array(hashes.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))], fields=list(kind))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), lists], names=["doc_id", "key", "anchors"])

        return handle

    return map_batches(keyed, make, _ANCHORS)


def _unseen(words: np.ndarray, parts: list[dict], window: int) -> list[dict]:
    """Reference parts of one text without the windows that the same shard has from an earlier place of that text; query parts as they are."""
    hashes = [group_hashes(words, window, m) for m in _MULTIPLIERS]
    seen: dict[int, set] = {}
    kept = []
    for part in sorted(parts, key=lambda p: p["first"]):
        if part["query"]:
            kept.append(part)
            continue
        known, span = seen.setdefault(part["shard"], set()), slice(part["first"], part["first"] + part["n"])
        for at, pair in enumerate(zip(*(h[span].tolist() for h in hashes), strict=True), part["first"]):
            if pair not in known:
                known.add(pair)
                kept.append(part | {"first": at, "n": 1})
    return kept


def _cut_slices(marked: DataFrame, window: int) -> DataFrame:
    """Slices of word hashes: neighbouring windows of one document with the same shard and role make one slice."""
    long = SHARD_WINDOWS // STRETCHES

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            rows: list[dict] = []
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for doc_id, key, text, parts in zip(*columns, batch.column(3).to_pylist(), strict=True):
                words = word_hashes(word_list(text))
                if sum(p["n"] for p in parts if not p["query"]) > long:
                    parts = _unseen(words, parts, window)
                start = end = -1
                state = None
                for part in [*sorted(parts, key=lambda p: p["first"]), None]:
                    own = part and (part["shard"], part["query"])
                    if part and own == state and part["first"] == end:
                        end += part["n"]
                        continue
                    if state is not None:
                        piece = words[start : end + window - 1]
                        rows.append({"shard": state[0], "query": state[1], "doc_id": doc_id, "key": key, "first": start, "words": piece.tobytes()})
                    if part:
                        start, end, state = part["first"], part["first"] + part["n"], own
            if not rows:
                return None
            kinds = pa.schema([("shard", pa.int64()), ("query", pa.int32()), ("doc_id", pa.int64()), ("key", pa.int64()), ("first", pa.int32()), ("words", pa.binary())])
            return pa.RecordBatch.from_pylist(rows, kinds)

        return handle

    return map_batches(marked, make, "shard long, query int, doc_id long, key long, first int, words binary")


_MATCHED = "doc_id long, key long, runs array<struct<first:int,n:int>>, rest array<struct<first:int,a:long,b:long>>"


def _intervals(starts: list[int]) -> list[dict]:
    if not starts:
        return []
    at = np.array(starts)
    cuts = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    return [{"first": int(f), "n": int(n)} for f, n in zip(at[cuts], np.diff(np.r_[cuts, len(at)]), strict=True)]


def _stream(slices: DataFrame, window: int) -> DataFrame:
    """``slices`` must come sorted by (shard, salt, query): each shard's references before its queries."""
    run_kind = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))
    rest_kind = pa.list_(pa.struct([("first", pa.int32()), ("a", pa.int64()), ("b", pa.int64())]))

    def run(batches):
        current, automaton, ready = None, None, False
        for batch in batches:
            ids, keys, runs, rests = [], [], [], []
            for row in batch.to_pylist():
                own = (row["shard"], row["salt"])
                if own != current:
                    current, automaton, ready = own, SuffixAutomaton(), False
                words = np.frombuffer(row["words"], np.uint64)
                if not row["query"]:
                    automaton.add(words.tolist(), row["doc_id"])
                    continue
                if not ready:
                    automaton.finish()
                    ready = True
                starts = automaton.found(words.tolist(), window, row["doc_id"])
                missing = np.ones(len(words) - window + 1, dtype=bool)
                missing[starts] = False
                rest = []
                if missing.any():
                    at = np.flatnonzero(missing)
                    a, b = (group_hashes(words, window, m)[at].view(np.int64).tolist() for m in _MULTIPLIERS)
                    rest = [{"first": row["first"] + int(f), "a": x, "b": y} for f, x, y in zip(at, a, b, strict=True)]
                ids.append(row["doc_id"])
                keys.append(row["key"])
                runs.append(_intervals([row["first"] + s for s in starts]))
                rests.append(rest)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(runs, run_kind), pa.array(rests, rest_kind)],
                                                 names=["doc_id", "key", "runs", "rest"])

    return slices.mapInArrow(run, _MATCHED)


def repeated_windows(keyed: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, key and the repeated windows of each document that has some, as an array of (first, n)."""
    found = written(find_anchors(keyed, window, gram), "substring-anchors")
    each = found.select("doc_id", "key", F.inline("anchors"))
    spread = each.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min_by("first", "doc_id").alias("at"), F.count(F.lit(1)).alias("places"))
    stretch = F.floor(F.col("at") / max(1, SHARD_WINDOWS // STRETCHES)).alias("stretch")
    spread = written(spread.where("lo < hi").select("hash", "lo", stretch, "places"), "substring-spread")
    shared = written(join_facts(each, spread, ["hash"]).select("doc_id", "key", "first", "n", "lo", "stretch"), "substring-shared")
    is_query = (F.col("doc_id") != F.col("lo")).cast("int")
    total = shared.agg(F.sum(F.when(is_query == 0, F.col("n")))).first()[0] or 0
    shards = max(1, -(-total // SHARD_WINDOWS))
    shard = F.pmod(F.xxhash64("lo", "stretch"), F.lit(shards))
    parts = shared.select("doc_id", "key", F.struct("first", "n", shard.alias("shard"), is_query.alias("query")).alias("p"))
    parts = parts.groupBy("doc_id", "key").agg(F.collect_set("p").alias("parts"))
    texts = keyed.where("doc_id is not null").select("doc_id", "text")
    marked = texts.join(parts, "doc_id").select("doc_id", "key", "text", "parts").mapInArrow(_own_rows, "doc_id long, key long, text string, parts array<struct<first:int,n:int,shard:long,query:int>>")
    slices = written(_cut_slices(marked, window), "substring-slices")
    loads = slices.where("query = 1").groupBy("shard").agg(F.sum(F.octet_length("words")).alias("bytes"))
    salts = F.ceil(F.col("bytes") / (8 * TASK_WINDOWS)).cast("int")
    sized = slices.join(loads.select("shard", salts.alias("salts")), "shard")
    own = F.pmod(F.xxhash64("doc_id", "first"), F.col("salts")).cast("int")
    dealt = sized.withColumn("salt", F.explode(F.when(F.col("query") == 1, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("salts") - 1))))
    ordered = dealt.drop("salts").repartition("shard", "salt").sortWithinPartitions("shard", "salt", "query", "doc_id", "first")
    matched = written(_stream(ordered, window), "substring-matched")
    rest = matched.select("doc_id", "key", F.inline("rest"))
    first = rest.groupBy("a", "b").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("places"))
    first = written(first.where("lo < hi").select("a", "b", "lo", "places"), "substring-first")
    late = join_facts(rest, first, ["a", "b"]).where("doc_id > lo").select("doc_id", "key", F.array(F.struct("first", F.lit(1).alias("n"))).alias("runs"))
    both = matched.where(F.size("runs") > 0).select("doc_id", "key", "runs").unionByName(late)
    return both.groupBy("doc_id", "key").agg(F.flatten(F.collect_set("runs")).alias("runs"))


def _own_rows(batches):
    """Keep a joined row if the marks belong to this text, where rows repeat an id."""
    for batch in batches:
        keys, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        yield batch.filter(pa.array([t is not None and _text_key(t) == k for k, t in zip(keys, texts, strict=True)]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and kept, the kept words joined by one space."""
    small_batches(docs.sparkSession)
    keyed = keyed_texts(docs, id_col, text_col)
    # An id may repeat, so all marks of an id travel with each of its rows, by text.
    marks = repeated_windows(keyed, window, gram).groupBy("doc_id").agg(F.collect_list(F.struct("key", "runs")).alias("marks"))
    joined = keyed.join(marks, "doc_id", "left").select("doc_id", "text", "marks")

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words, n_removed, kept = [], [], []
            for text, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = word_list(text)
                n_words.append(len(words))
                runs = []
                if marks and text:
                    key = _text_key(text)
                    runs = [r for m in marks if m["key"] == key for r in m["runs"]]
                if runs:
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    for r in runs:
                        gone[r["first"]] += 1
                        gone[r["first"] + r["n"] + window - 1] -= 1
                    stays = np.cumsum(gone[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(" ".join(words))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                              names=["doc_id", "n_words", "n_removed", "kept"])

        return handle

    return map_batches(joined, make, "doc_id long, n_words long, n_removed long, kept string")
