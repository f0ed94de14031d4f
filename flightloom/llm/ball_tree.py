"""Ball trees over sparse non-negative vectors, for exact inner-product search with many queries at once.

A node holds the mean of its vectors and the largest distance of one of them from it. For a query q and any vector d below a node with centre c and
radius r, ⟨q, d⟩ <= ⟨q, c⟩ + |q'| r, where q' is q on the terms that occur below the node: on the others both d and c are zero. All sums here
are of non-negative doubles, so their relative error is far below ``SLACK``, by which bounds and radii are widened; a subtree is only
left out if its widened bound lies below a score already held.

Scores are exact integers: term weights times integer components. They are summed as doubles while no sum can reach 2**53, where doubles
are exact on integers, else as 64-bit integers.
"""

from __future__ import annotations

import heapq
import io
from dataclasses import dataclass

import numpy as np

#: Rows of a leaf; a node of equal rows is not split further.
LEAF_ROWS = 8
#: Entries of the dense matrix a tree is built from.
MAX_CELLS = 1 << 24
SLACK = 1e-9


@dataclass
class Vectors:
    """Sparse rows: row i has ``terms[start[i]:start[i + 1]]`` with the integer components ``values`` there."""

    ids: np.ndarray
    no_id: np.ndarray
    start: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def take(self, rows: np.ndarray) -> Vectors:
        sizes = np.diff(self.start)[rows]
        at = np.repeat(self.start[rows] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        return Vectors(self.ids[rows], self.no_id[rows], np.r_[0, np.cumsum(sizes)], self.terms[at], self.values[at])


@dataclass
class Tree:
    vectors: Vectors  # in the order of the leaves
    low: np.ndarray  # rows below node i are low[i] to high[i]
    high: np.ndarray
    right: np.ndarray  # the left child of i is i + 1; 0 for leaves
    radius: np.ndarray
    centre_start: np.ndarray
    centre_terms: np.ndarray
    centre_values: np.ndarray

    def pack(self) -> bytes:
        out = io.BytesIO()
        own = {k: v for k, v in vars(self).items() if k != "vectors"}
        np.savez_compressed(out, **own, **{f"v_{k}": v for k, v in vars(self.vectors).items()})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        held = np.load(io.BytesIO(data))
        vectors = Vectors(**{k.removeprefix("v_"): held[k] for k in held.files if k.startswith("v_")})
        return cls(vectors, **{k: held[k] for k in held.files if not k.startswith("v_")})


def build(vectors: Vectors) -> list[Tree]:
    """Trees over the rows, more than one where the dense matrix would be too large."""
    used, columns = np.unique(vectors.terms, return_inverse=True)
    rows = len(vectors.ids)
    if rows > LEAF_ROWS and rows * len(used) > MAX_CELLS:
        return [t for half in np.array_split(np.arange(rows), 2) for t in build(vectors.take(half))]
    dense = np.zeros((rows, len(used)))
    dense[np.repeat(np.arange(rows), np.diff(vectors.start)), columns] = vectors.values
    low, high, right, radius, centres = [], [], [], [], []
    order = np.arange(rows)

    def grow(first: int, end: int) -> None:
        node, members = len(low), order[first:end]
        centre = dense[members].mean(axis=0)
        distance = np.sqrt(((dense[members] - centre) ** 2).sum(axis=1))
        low.append(first)
        high.append(end)
        right.append(0)
        radius.append(float(distance.max()) * (1 + SLACK) + SLACK * float(np.sqrt((centre**2).sum())))
        support = np.flatnonzero(centre)
        centres.append((used[support], centre[support]))
        if end - first <= LEAF_ROWS or not distance.any():
            return
        far = dense[members[int(distance.argmax())]]
        other = dense[members[int(((dense[members] - far) ** 2).sum(axis=1).argmax())]]
        order[first:end] = members[np.argsort(dense[members] @ (other - far), kind="stable")]
        middle = (first + end) // 2
        grow(first, middle)
        right[node] = len(low)
        grow(middle, end)

    if rows:
        grow(0, rows)
    sizes = [len(t) for t, _ in centres]
    return [Tree(vectors.take(order), np.array(low), np.array(high), np.array(right), np.array(radius), np.r_[0, np.cumsum(sizes)].astype(np.int64),
                 np.concatenate([t for t, _ in centres] or [[]]).astype(np.int64), np.concatenate([v for _, v in centres] or [[]]))]


class Search:
    """The ``k`` best rows of each query over the trees given to it one after the other.

    ``counts`` [terms, queries] says how often a query holds a term. ``least`` are scores that each query is known to reach ``k`` times; only
    rows with such a score are kept.
    """

    def __init__(self, counts: np.ndarray, weights: np.ndarray, k: int, least: np.ndarray | None = None):
        self.integer = counts.astype(np.int64) * weights.astype(np.int64)[:, None]
        # No component exceeds a million, so these sums bound every score.
        self.exact = int(self.integer.sum(axis=0).max(initial=0)) * 1_000_000 < 2**53
        self.weighted = self.integer.astype(float)
        queries = counts.shape[1]
        self.k, self.least = k, np.ones(queries, np.int64) if least is None else np.maximum(least, 1)
        self.scores = np.zeros((k, queries), np.int64)
        self.ids = np.zeros((k, queries), np.int64)
        self.no_id = np.zeros((k, queries), bool)
        self.rows_scored = self.rows_seen = 0

    def threshold(self, queries: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[-1, queries], self.least[queries])

    def bound(self, tree: Tree, node: int, queries: np.ndarray) -> np.ndarray:
        own = slice(tree.centre_start[node], tree.centre_start[node + 1])
        asked = self.weighted[np.ix_(tree.centre_terms[own], queries)]
        to_centre = tree.centre_values[own] @ asked
        reach = np.sqrt(np.einsum("ij,ij->j", asked, asked)) * tree.radius[node]
        return (to_centre + reach) * (1 + SLACK) + SLACK

    def visit(self, tree: Tree, greedy: bool = False) -> None:
        """Search a tree best-first: the node whose bound exceeds some query's threshold most comes next, for all queries that it may still serve.
        ``greedy`` goes with each query into the better child only."""
        if not len(tree.low):
            return
        self.rows_seen += len(tree.vectors.ids) * self.scores.shape[1]
        every = np.arange(self.scores.shape[1])
        waiting: list[tuple[float, int, np.ndarray, np.ndarray]] = []

        def offer(node: int, queries: np.ndarray, bounds: np.ndarray) -> None:
            if len(queries):
                heapq.heappush(waiting, (-float((bounds / self.threshold(queries)).max()), node, queries, bounds))

        offer(0, every, self.bound(tree, 0, every))
        while waiting:
            _, node, queries, bounds = heapq.heappop(waiting)
            open_ = bounds >= self.threshold(queries)
            queries, bounds = queries[open_], bounds[open_]
            if not len(queries):
                continue
            if not tree.right[node]:
                self.score(tree, node, queries)
                continue
            children = [node + 1, int(tree.right[node])]
            # A child's rows are among its parent's.
            found = [np.minimum(self.bound(tree, child, queries), bounds) for child in children]
            for at, child in enumerate(children):
                mine = found[at] >= self.threshold(queries)
                if greedy:
                    mine &= found[at] > found[1 - at] if at else found[at] >= found[1 - at]
                offer(child, queries[mine], found[at][mine])

    def score(self, tree: Tree, leaf: int, queries: np.ndarray) -> None:
        first, end = tree.low[leaf], tree.high[leaf]
        self.rows_scored += (end - first) * len(queries)
        cells = slice(tree.vectors.start[first], tree.vectors.start[end])
        used, columns = np.unique(tree.vectors.terms[cells], return_inverse=True)
        kind = np.float64 if self.exact else np.int64
        dense = np.zeros((end - first, len(used)), kind)
        dense[np.repeat(np.arange(end - first), np.diff(tree.vectors.start[first : end + 1])), columns] = tree.vectors.values[cells]
        found = (dense @ self.integer[np.ix_(used, queries)].astype(kind)).astype(np.int64)
        useful = (found >= self.threshold(queries)).any(axis=0)
        queries, found = queries[useful], found[:, useful]
        if not len(queries):
            return
        found[found < self.least[queries]] = 0
        spread = np.ones((1, len(queries)), np.int64)
        scores = np.vstack([self.scores[:, queries], found])
        ids = np.vstack([self.ids[:, queries], tree.vectors.ids[first:end, None] * spread])
        no_id = np.vstack([self.no_id[:, queries], tree.vectors.no_id[first:end, None] & (spread > 0)])
        best = np.lexsort((ids, no_id, -scores), axis=0)[: self.k]
        for held, new in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id)):
            held[:, queries] = np.take_along_axis(new, best, axis=0)
