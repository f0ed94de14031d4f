"""Vector near-dedup and nearest neighbours against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightloom.llm import ann, vector_dedup
from flightloom.llm.graph import components
from flightloom.llm.queries import op2_vector_dedup, op5_ann

SF_DIR = "/root/testdata/sf0.01"
INF, NAN = float("inf"), float("nan")


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", F.lit("clash")).withColumn("n", F.lit(1))


def links_by_hand(ids, x, threshold=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (new == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), label, strict=True)}
        label = new


def test_vector_dedup_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    want = links_by_hand([r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float))
    got = op2_vector_dedup(spark, SF_DIR).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("tile", [4096, 16])
def test_vector_dedup_of_a_large_group(spark, tile):
    """Near copies, exact copies, scaled copies and chains, cut into many tiles."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=12)
    x = np.concatenate([base + rng.normal(scale=0.25, size=(120, 12)), rng.normal(size=(60, 12)), np.repeat(base[None], 20, axis=0), 3 * base[None]])
    ids = [int(i) for i in rng.permutation(len(x))]
    got = vector_dedup.near_duplicates(table(spark, [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]), tile=tile).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == links_by_hand(ids, x)


EDGES = [
    (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [NAN, 1.0]), (6, [INF, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0]),
    (None, [1.0, 0.0]), (11, [1.0, 0.0]), (20, [1.0, 0.1]), (40, [0.0, 1.0]), (40, [0.0, 1.0]),
]


def test_vector_edges(spark):
    got = vector_dedup.near_duplicates(table(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    links = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert links[1] == (3, 1, True) and links[2] == links[11] == links[20] == (3, 1, False)
    assert all(links[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)) and links[None] == (0, None, True)
    assert links[40] == (1, 40, True)  # two rows of one id link with each other
    found = [tuple(r) for r in ann.search(table(spark, EDGES), F.col("vec_id") % 20 == 0, k=3, probed=1.0).orderBy("query_id", "rank").collect()]
    assert [(q, r, v) for q, r, v, _ in found] == [(20, 1, 2), (20, 2, 1), (20, 3, 11), (40, 1, 20), (40, 2, 1), (40, 3, 2)]
    empty = table(spark, EDGES).limit(0)
    assert vector_dedup.near_duplicates(empty).count() == 0 == ann.search(empty, F.col("vec_id") % 20 == 0).count()
    unusable = table(spark, [(3, None), (4, [0.0])])
    assert vector_dedup.near_duplicates(unusable).count() == 2 and ann.search(unusable, F.lit(True)).count() == 0


def neighbours(ids, x, k):
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % 20 == 0:
            scores = x @ q
            out[i] = [ids[j] for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
    return out


def test_ann_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float)
    want, got = neighbours(ids, x, 20), {}
    for r in op5_ann(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    place = {v: n for n, v in enumerate(ids)}
    for q, found in got.items():
        assert sorted(found) == list(range(1, len(found) + 1))
        order = [(-s, v) for _, (v, s) in sorted(found.items())]
        assert order == sorted(order) and q not in {v for v, _ in found.values()}
        assert all(abs(s - x[place[q]] @ x[place[v]]) < 1e-12 for v, s in found.values())
    hit = sum(len(set(v) & {f for f, _ in got[q].values()}) for q, v in want.items())
    assert hit / sum(map(len, want.values())) >= 0.9


@pytest.mark.parametrize("kind", ["2", "12", "40", "clumped"])
def test_ann_fills_every_query_with_registered_parameters(spark, kind):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(260 if kind == "clumped" else int(kind), 100))
    if kind == "clumped":
        x[5:] = x[5]  # nearly all rows in one bucket of each table
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    found = Counter(r.query_id for r in ann.search(df, F.col("vec_id") < 5, k=20).collect())
    assert found == {i: min(20, len(x) - 1) for i in range(min(5, len(x)))}


def test_ann_with_every_axis_probed_is_exact_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 40)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 7)) * rng.uniform(0.5, 3, size=(300, 1))
    x[50:150] = x[0]  # a common vector: ties go to smaller ids
    ids = list(range(300))
    got = ann.search(table(spark, [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]), F.col("vec_id") % 20 == 0, k=5, tables=2, probed=1.0)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == neighbours(ids, x, 5)


def test_components_of_paths_stars_and_cliques(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(300, 301), (301, 300), (5, 5), (None, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 7 for i in range(200, 260)} | {301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_length_is_compared_by_itself(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, [0.0, 1.0]), (4, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0]), (6, [0.0, 0.0, 1.0]), (7, [3.0]), (20, [5.0, 0.0, 0.1]), (9, None), (40, [1.0, 1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(table(spark, rows)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (2, 4), 5: (2, 4), 6: (0, 6), 7: (0, 7), 20: (2, 4), 9: (0, 9), 40: (0, 40)}
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(table(spark, rows), F.col("vec_id") % 20 == 0).collect())
    assert found == [(20, 1, 4, 5.0), (20, 2, 5, 5.0), (20, 3, 6, 0.1), (40, 1, 2, 2.01), (40, 2, 1, 1.0), (40, 3, 3, 1.0)]
