"""Gradient-boosted trees: logistic loss, quantile bins, complete trees of fixed depth. ``fit`` takes arrays; ``fit_table`` takes a table of any
size, of which Spark makes the quantiles and each level's histograms, so the driver sees features times bins numbers a node, never a row."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

#: Gradients are summed as whole numbers of such parts, so that sums do not depend on the order of rows.
PARTS = 1 << 30


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Booster:
    """``depth`` levels of (feature, threshold) per tree; leaf values follow the path's bits."""

    rounds: int = 40
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    ridge: float = 1.0
    base: float = 0.0
    trees: list[tuple[list[int], list[float], np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Booster":
        mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = float(np.log(mean / (1 - mean)))
        score = np.full(len(y), self.base)
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        for _ in range(self.rounds):
            p = sigmoid(score)
            grad, hess = y - p, p * (1 - p)
            inner = 2**self.depth - 1
            features, thresholds = [0] * inner, [np.inf] * inner
            node = np.zeros(len(y), dtype=np.int64)
            for at in range(inner):
                rows = np.flatnonzero(node == at)
                if len(rows):
                    found = self._split(binned[rows], grad[rows], hess[rows], edges)
                    if found is not None:
                        features[at], thresholds[at] = found
                node[rows] = 2 * at + 1 + (x[rows, features[at]] > thresholds[at])
            leaf = node - inner
            g, h = np.bincount(leaf, grad, 2**self.depth), np.bincount(leaf, hess, 2**self.depth)
            values = self.rate * g / (h + self.ridge)
            self.trees.append((features, thresholds, values))
            score += values[leaf]
        return self

    def _split(self, binned, grad, hess, edges):
        best, found, g_all, h_all = 1e-6, None, grad.sum(), hess.sum()
        whole = g_all**2 / (h_all + self.ridge)
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            g = np.bincount(binned[:, f], grad, len(cuts) + 1).cumsum()[:-1]
            h = np.bincount(binned[:, f], hess, len(cuts) + 1).cumsum()[:-1]
            gain = g**2 / (h + self.ridge) + (g_all - g) ** 2 / (h_all - h + self.ridge) - whole
            at = int(gain.argmax())
            if gain[at] > best:
                best, found = gain[at], (f, float(cuts[at]))
        return found

    def fit_table(self, examples: DataFrame) -> "Booster":
        """``fit`` on a written table of vectors (x, n, right): an array of numbers, how many rows have it, and how many of them are positive."""
        n, right = examples.agg(F.sum("n"), F.sum("right")).first()
        mean = min(max(right / n, 1e-3), 1 - 1e-3)
        self.base = float(np.log(mean / (1 - mean)))
        values = examples.select(F.posexplode("x").alias("f", "v"), "n").groupBy("f", F.col("v").cast("double").alias("v")).agg(F.sum("n").alias("n"))
        quantiles = F.percentile("v", [float(q) for q in np.linspace(0, 1, self.bins + 1)[1:-1]], F.col("n"))
        edges = [np.unique(r[0]) for r in values.groupBy("f").agg(quantiles.alias("edges")).orderBy("f").select("edges").collect()]

        def make():
            def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
                x = np.array(batch.column(0).to_pylist(), dtype=float)
                binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)
                return pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in binned], pa.binary()), batch.column(1), batch.column(2)], names=["b", "n", "right"])

            return handle

        binned = map_batches(examples.select("x", "n", "right"), make, "b binary, n long, right long").groupBy("b")
        binned = written(binned.agg(F.sum("n").alias("n"), F.sum("right").alias("right")), "boosting")
        grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the trees, with bins for thresholds
        for _ in range(self.rounds):
            inner = 2**self.depth - 1
            features, cuts = np.zeros(inner, np.int64), np.full(inner, self.bins)  # no bin is beyond that cut
            sums = np.zeros((2, 0))
            for level in range(self.depth):
                g, h = self._histograms(binned, len(edges), grown, features, cuts, level)
                sums = np.zeros((2, 2 ** (level + 1)))
                for node in range(2**level):
                    at, total = 2**level - 1 + node, np.array([g[node, 0].sum(), h[node, 0].sum()])
                    best = self._best(g[node], h[node], edges)
                    left = total
                    if best is not None:
                        features[at], cuts[at] = best
                        left = np.array([x[node, best[0], : best[1] + 1].sum() for x in (g, h)])
                    sums[:, 2 * node], sums[:, 2 * node + 1] = left, total - left
            values = self.rate * sums[0] / (sums[1] + self.ridge)
            thresholds = [float(edges[f][c]) if c < self.bins else np.inf for f, c in zip(features, cuts, strict=True)]
            self.trees.append((features.tolist(), thresholds, values))
            grown.append((features, cuts, values))
        return self

    def _histograms(self, binned: DataFrame, n_features: int, grown: list, features: np.ndarray, cuts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums of gradients and of their slopes by node of a level, feature and bin, under the trees grown so far."""
        base, depth, width, shape = self.base, self.depth, self.bins, (2**level, n_features, self.bins)

        def reached(b: np.ndarray, features: np.ndarray, cuts: np.ndarray, levels: int) -> np.ndarray:
            node, rows = np.zeros(len(b), np.int64), np.arange(len(b))
            for _ in range(levels):
                node = 2 * node + 1 + (b[rows, features[node]] > cuts[node])
            return node - (2**levels - 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, 2**level * n_features * width), np.int64)
            for batch in batches:
                b = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, n_features).astype(np.int64)
                n, right = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                margin = np.full(len(b), base)
                for f, c, values in grown:
                    margin += values[reached(b, f, c, depth)]
                p = sigmoid(margin)
                slots = (reached(b, features, cuts, level)[:, None] * n_features + np.arange(n_features)) * width + b
                for total, each in zip(sums, (right * PARTS - n * np.rint(p * PARTS).astype(np.int64), n * np.rint(p * (1 - p) * PARTS).astype(np.int64)), strict=True):
                    np.add.at(total, slots, np.broadcast_to(each[:, None], slots.shape))
            at = np.flatnonzero(sums.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *(pa.array(total[at], pa.int64()) for total in sums)], names=["slot", "g", "h"])

        found = binned.mapInArrow(run, "slot long, g long, h long").groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        g, h = np.zeros(shape), np.zeros(shape)
        for r in found:
            g.flat[r["slot"]], h.flat[r["slot"]] = r["g"] / PARTS, r["h"] / PARTS
        return g, h

    def _best(self, g_bins: np.ndarray, h_bins: np.ndarray, edges: list[np.ndarray]) -> tuple[int, int] | None:
        """The feature and cut of the largest gain."""
        best, found, g_all, h_all = 1e-6, None, g_bins[0].sum(), h_bins[0].sum()
        whole = g_all**2 / (h_all + self.ridge)
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            g, h = g_bins[f].cumsum()[: len(cuts)], h_bins[f].cumsum()[: len(cuts)]
            gain = g**2 / (h + self.ridge) + (g_all - g) ** 2 / (h_all - h + self.ridge) - whole
            at = int(gain.argmax())
            if gain[at] > best:
                best, found = gain[at], (f, at)
        return found

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for features, thresholds, values in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            f, t = np.array(features), np.array(thresholds)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += values[node - len(features)]
        return out


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last one is the intercept."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logistic_fit_table(rows: DataFrame, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """``logistic_fit`` of one number on a written table (x, n, right), as in ``fit_table``; Spark sums each step."""
    w = np.zeros(2)
    x, n = F.col("x"), F.col("n")
    for _ in range(steps):
        p = 1 / (1 + F.exp(-F.greatest(F.least(x * float(w[0]) + float(w[1]), F.lit(40.0)), F.lit(-40.0))))
        slope, off = n * p * (1 - p), F.col("right") - n * p
        xx, x1, one, gx, g1 = rows.agg(*[F.sum(c) for c in (slope * x * x, slope * x, slope, off * x, off)]).first()
        step = np.linalg.solve(np.array([[xx, x1], [x1, one]]) + ridge * np.eye(2), np.array([gx, g1]) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w
