"""Merkle manifest, ranked lexical search and benchmark decontamination."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightloom.llm import ball_tree, decontamination, lexical_search, merkle, queries
from flightloom.llm.terms import terms

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
TABLES = ("documents", "benchmark")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words_of(text):
    return TERM.findall(lowered(text or ""))


@given(st.text(alphabet="aZ09 éÉ中_-İ\x85 \t\n{}@", max_size=40))
def test_terms(text):
    assert [t.decode() for t in terms(text.encode())] == words_of(text)


def against_sql(spark, frames, name, monkeypatch):
    """Rows of a registered query over ``frames`` and those of its SQL, both sorted."""
    con = duckdb.connect()
    for table, frame in frames.items():
        con.register(table, frame.toArrow())
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, table: frames[table])
    frame = queries.QUERIES[name](spark, "")
    asked = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in asked.description]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=key), sorted(asked.fetchall(), key=key)


@pytest.fixture(scope="module")
def edge_tables(spark, edge_docs):
    items = [(1, "two three four five"), (1, "one TWO"), (2, None), (3, ""), (4, " \n"), (None, "a"), (5, "word " * 30), (6, "line a line b"), (6, "line a line b"),
             (7, "one two three four five six seven eight nine ten"), (8, "no such words anywhere in here at all or below, I think so")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumns({"at": F.lit("clash"), "body": F.lit("clash"), "item_at": F.lit("clash")})
    clashes = ["tree", "lo", "hi", "digest", "children", "path", "leaf", "subroot", "body", "row_id", "terms", "tf", "component", "place", "at"]
    return {"documents": edge_docs.withColumns({c: F.lit("clash") for c in clashes}), "benchmark": benchmark}


@pytest.mark.parametrize("name", ["op11_merkle", "op12_lexical_search", "op13_decontamination"])
def test_edges_equal_sql(spark, edge_tables, name, monkeypatch):
    got, want = against_sql(spark, edge_tables, name, monkeypatch)
    assert got == want and got
    for frames in ({t: f.limit(0) for t, f in edge_tables.items()}, edge_tables | {"benchmark": edge_tables["benchmark"].limit(0)}):
        got, want = against_sql(spark, frames, name, monkeypatch)
        assert got == want


@pytest.mark.parametrize("name", ["op11_merkle", "op12_lexical_search", "op13_decontamination"])
def test_given_tables_equal_sql(spark, name, monkeypatch):
    frames = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in TABLES}
    got, want = against_sql(spark, frames, name, monkeypatch)
    assert got == want and len(got) > 100


# Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_by_hand(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_by_hand(nodes):
    """The root of a list of leaves and each leaf's (before, after) from its own level up."""
    found, owner = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(owner):
            run = at - at % 16
            found[leaf].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 16])))
        nodes, owner = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], [at // 16 for at in owner]
    return nodes[0], found


def manifest_by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.source, []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for source in order:
        own = sorted(groups[source], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_by_hand(r, r.text)))
        made[source] = (own, *tree_by_hand([leaf_by_hand(r, r.text) for r in own]))
    root, above = tree_by_hand([made[s][1] for s in order])
    for source, upper in zip(order, above, strict=True):
        own, subroot, paths = made[source]
        for row, path in zip(own, paths, strict=True):
            path = path + upper
            tampered = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0 and row.text is not None
            folded = leaf_by_hand(row, lowered(row.text) if tampered else row.text)
            for before, after in path:
                folded = digest(before + folded + after)
            proof = digest("".join(b + a for b, a in path))
            yield (row.doc_id, leaf_by_hand(row, row.text), subroot, root, proof, folded, folded == root)


def test_merkle_by_hand(spark, monkeypatch):
    """Sources of 1, 16, 17, 256, 257 and 900 rows and one without a name, ids out of order and repeated."""
    sizes = {"a": 1, "b": 16, "é": 17, "c": 256, "d": 257, "B": 900, None: 3, "": 2}
    docs = [((k * 7919) % 4001 if k % 50 else k % 3, f"Text {k}" if k % 11 else None, "EN", source, k if k % 5 else None) for n, (source, size) in enumerate(sizes.items()) for k in range(size)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    monkeypatch.setattr(queries, "table", lambda *_: frame)
    got = sorted(map(tuple, queries.op11_merkle(spark, "").collect()), key=str)
    assert got == sorted(manifest_by_hand(frame.collect()), key=str)
    assert {row[-1] for row in got} == {True, False}


def test_merkle_joins_by_interval(spark, edge_docs):
    found = merkle.manifest(edge_docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


# Ranked lexical search


def ranking_by_hand(docs, items, k):
    held = [(doc_id, words_of(text)) for doc_id, text in docs]
    held = [(d, w, Counter(w)) for d, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w, _ in held)
    holding = Counter(t for _, _, c in held for t in c)
    out = []
    for item_id, text in items:
        asked, found = Counter(words_of(text)), []
        for doc_id, words, counts in held:
            m = 100 - 25 + 25 * len(words) * n_docs // total
            score = sum(often * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
                        for t, often in asked.items() if t in counts)
            if score > 0:
                found.append((-score, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def test_search_by_hand(spark):
    frames = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in TABLES}
    docs = [(r.doc_id, r.text) for r in frames["documents"].collect()]
    items = [(r.item_id, r.text) for r in frames["benchmark"].collect()]
    got = sorted(map(tuple, lexical_search.search(frames["documents"], frames["benchmark"], k=7).collect()))
    assert got == ranking_by_hand(docs, items, 7)
    # Blocks of a few items give the same
    blocks = lexical_search.search(frames["documents"], frames["benchmark"], k=7, block_bytes=2000)
    assert sorted(map(tuple, blocks.collect())) == got


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(1, 9), st.booleans())
def test_tree_search_is_exact(seed, rows, k, wide):
    """Against all inner products, with ties, copies and several trees; as doubles and, with large weights, as integers."""
    rng = np.random.default_rng(seed)
    width, asked = 40, 5
    lists = [np.sort(rng.choice(width, rng.integers(1, 12), replace=False)) for _ in range(rows)]
    lists = [lists[int(rng.integers(0, i + 1))] if rng.random() < 0.3 else t for i, t in enumerate(lists)]
    values = [rng.choice([1, 454545, 625000, 1_000_000], len(t)) for t in lists]
    ids = rng.permutation(rows) * 3
    weights = rng.integers(10**10, 10**11, width) if wide else rng.integers(0, 9000, width)
    counts = rng.integers(0, 3, (width, asked)) * (rng.random((width, asked)) < 0.3)
    search = ball_tree.Search(counts, weights, k)
    assert search.exact != wide or not counts.any()
    for part in np.array_split(np.arange(rows), 3):
        held = ball_tree.Vectors(ids[part], np.zeros(len(part), bool), np.r_[0, np.cumsum([len(lists[i]) for i in part])].astype(np.int64),
                                 np.concatenate([lists[i] for i in part] or [[]]).astype(np.int64), np.concatenate([values[i] for i in part] or [[]]).astype(np.int64))
        for tree in ball_tree.build(held):
            search.visit(ball_tree.Tree.unpack(tree.pack()))
    dense = np.zeros((rows, width), np.int64)
    for i, (t, v) in enumerate(zip(lists, values, strict=True)):
        dense[i, t] = v
    every = dense @ (counts * weights[:, None])
    for q in range(asked):
        want = sorted((-int(s), int(d)) for s, d in zip(every[:, q], ids, strict=True) if s > 0)[:k]
        got = [(-int(s), int(d)) for s, d in zip(search.scores[:, q], search.ids[:, q], strict=True) if s > 0]
        assert got == want


def test_search_leaves_subtrees_out(spark):
    frames = {t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in TABLES}
    assert lexical_search.scored_share(frames["documents"], frames["benchmark"]) < 0.6


# Benchmark decontamination


def marks_by_hand(text, items, width):
    words = words_of(text)
    hit, named = set(), set()
    for item_id, body in items:
        asked = words_of(body)
        for i in range(max(1, len(asked) - width + 1)) if asked else ():
            window = asked[i : i + width]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    named.add(item_id)
    return len(words), len(hit), sorted(x for x in named if x is not None)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=7), max_size=5), st.lists(st.sampled_from("abcd"), max_size=30), st.integers(1, 4))
def test_automaton_by_hand(items, words, width):
    pairs = {(w, n) for n, item in enumerate(items) for w in decontamination.windows([x.encode() for x in item], width)}
    spans, named = decontamination.Windows(sorted(pairs)).find([w.encode() for w in words])
    numbered = [(n, " ".join(item)) for n, item in enumerate(items)]
    assert (len(words), sum(b - a for a, b in spans), sorted(named)) == marks_by_hand(" ".join(words), numbered, width)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_blocks_mark_the_same(spark, edge_tables):
    items = [(r.item_id, r.text) for r in edge_tables["benchmark"].collect()]
    short = [(r.doc_id, r.text) for r in edge_tables["documents"].collect() if len(r.text or "") < 1000]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    want = sorted([(doc_id, *marks_by_hand(text, items, 4)) for doc_id, text in short], key=str)
    for block_pairs in (3, 10**6):
        marked = decontamination.mark(docs, edge_tables["benchmark"], 4, block_pairs)
        assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in marked.collect()], key=str) == want


def test_passages_lead_back_to_the_original(spark):
    docs = spark.createDataFrame([(1, "Éa – Intro, ONE two;\nThree-FOUR five! ünd one two three"), (2, "nothing"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "one two three four five"), (8, "ünd one")], "item_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.passage) for r in decontamination.passages(docs, items, 3).collect())
    assert found == [(1, 7, "ONE two;\nThree-FOUR five"), (1, 7, "one two three"), (1, 8, "ünd one")]
    text = docs.first().text
    assert all(text[r.start : r.end] == r.passage for r in decontamination.passages(docs, items, 3).collect())
