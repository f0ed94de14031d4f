"""Toxic passages: maximum-scoring segments over token log-odds.

Each token has the log-odds of occurring in toxic rather than clean documents, shrunk towards zero by its own uncertainty and less a drift that
makes the expected score of clean text negative. Evidence comes in two layers: a stem, the first ``STEM`` letters, has an informative
Dirichlet prior taken from the counts of *all* documents; a whole token has its own counts, with the split of its stem as prior, so
a token with counts of its own is judged by them and an unseen one by its relatives. What repeats within a text counts less each time: the
k-th occurrence of a token adds a k-th of its evidence, so no repeated phrase makes a passage by itself. A linear scan finds every maximal segment of a
document; Karlin-Altschul statistics of clean text turn segment scores into extreme-value units, comparable over document lengths, and a logistic
calibration on labelled documents that took no part in the counts makes them probabilities. Its slope is never negative: more evidence never lowers a score.

Tokens are runs of letters, marks and digits of any script; in scripts written without spaces they are pairs of neighbouring characters.

Labels of at most ``MAX_LABELS`` documents are used, those with the smallest hashes of their ids; the corpus counts cover every document. Of the
labelled documents' stems and tokens the ``MAX_KEYS`` most frequent are known by their 64-bit keys, a bound for what goes to the tasks; a token beyond it is
judged by its stem, a stem beyond it is neutral.

Null and empty texts have no tokens and score by the calibration's value for nothing found. Rows are scored independently;
repeated rows and rows with a null id are scored alike. Several labels of one id: toxic if any says so. Without labels of
both classes every score is 0. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import logistic_fit
from .common import column, keyed_texts, map_batches, small_batches, written

MAX_LABELS = 100_000
MAX_KEYS = 1 << 19
#: Weight of the stems' prior and of a token's, in tokens.
PRIOR = 1000.0
TOKEN_PRIOR = 20.0
#: Standard deviations by which log-odds are shrunk.
SHRINK = 2.0
#: Extreme-value units from which a segment counts as significant: -ln of its expected number in clean text.
SIGNIFICANT = 1.0
#: Letters of a stem. Inflected and compounded forms share their evidence by it.
STEM = 4
_CACHE = 120_000
#: Counted entries after which a task hands on what it has.
_FLUSH = 100_000

_PLAIN = re.compile(r"[^\W_]+").findall
_BEYOND = re.compile("[\u0300-\U0010ffff]").search
_RUNS = regex.compile(r"[\p{L}\p{M}\p{N}]+").findall
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]+")


def tokens(text: str) -> list[str]:
    text = text.lower()
    if not _BEYOND(text):
        return _PLAIN(text)
    found = []
    for run in _RUNS(text):
        at = 0
        for part in _UNSPACED.finditer(run):
            first, end = part.span()
            if first > at:
                found.append(run[at:first])
            found += [run[i : i + 2] for i in range(first, max(end - 1, first + 1))]
            at = end
        if at < len(run):
            found.append(run[at:])
    return found


def key_of(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode()) >> 1


def fold(id_column) -> F.Column:
    """0 to 4: crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(5))


def training_labels(labels: DataFrame, id_col: str = "doc_id", toxic_col: str = "toxic", max_labels: int = MAX_LABELS, held_out: bool = True) -> DataFrame:
    """(l_id, toxic, fold): a bounded sample of the labelled ids outside fold 0 (or of all, if ``held_out`` is off)."""
    known = labels.select(column(id_col).cast("long").alias("l_id"), column(toxic_col).cast("int").alias("toxic")).where("l_id is not null and toxic is not null")
    known = known.withColumn("fold", fold(F.col("l_id")))
    if held_out:
        known = known.where("fold != 0")
    return known.groupBy("l_id", "fold").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("l_id"), "l_id").limit(max_labels)


def count_tokens(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Written counts by key: (key, stem, n_all, n_toxic, n_clean), over all documents, and over the toxic and the clean ones of the counting folds.
    For a stem ``stem`` is null; whole tokens, which are counted in labelled documents only, name theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems: list[Counter] = [Counter(), Counter(), Counter()]
        whole: list[Counter] = [Counter(), Counter()]

        def flush() -> pa.RecordBatch:
            entries = [(s, None) for s in stems[0]] + [(t, t[:STEM]) for t in {*whole[0], *whole[1]}]
            out = pa.RecordBatch.from_arrays(
                [pa.array([key_of(t) for t, _ in entries], pa.int64()), pa.array([None if s is None else key_of(s) for _, s in entries], pa.int64()),
                 pa.array([stems[0][t] if s is None else 0 for t, s in entries], pa.int64()),
                 *(pa.array([(stems[k + 1] if s is None else whole[k])[t] for t, s in entries], pa.int64()) for k in (0, 1))],
                names=["key", "stem", "n_all", "n_toxic", "n_clean"])
            for counter in (*stems, *whole):
                counter.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                found = tokens(text)
                first = [t[:STEM] for t in found]
                stems[0].update(first)
                if toxic is not None:
                    stems[1 if toxic else 2].update(first)
                    whole[0 if toxic else 1].update([t for t in found if len(t) > STEM])
            if sum(map(len, (stems[0], *whole))) > _FLUSH:
                yield flush()
        yield flush()

    # The labels are a bounded sample, so they can be broadcast. Fold 4 is kept for calibration.
    counting = labels.where("fold != 4").select("l_id", "toxic")
    marked = docs.join(F.broadcast(counting), F.col("doc_id") == F.col("l_id"), "left").select("text", "toxic")
    partial = marked.mapInArrow(run, "key long, stem long, n_all long, n_toxic long, n_clean long")
    return written(partial.groupBy("key", "stem").agg(*[F.sum(c).alias(c) for c in ("n_all", "n_toxic", "n_clean")]), "toxicity-counts")


@dataclass
class Scorer:
    """Scores by key of token or stem, and the extreme-value constants of clean text."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # ascending
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    drift: float = 0.1
    decay: float = 1.0
    log_k: float = 0.0

    def units(self, segment: np.ndarray | float, length) -> np.ndarray | float:
        """-ln of how many segments of this score clean text of this length would hold."""
        return self.decay * segment - self.log_k - np.log(np.maximum(length, 1))

    def known(self, token: str) -> float | None:
        key = key_of(token)
        at = int(np.searchsorted(self.keys, key))
        return float(self.scores[at]) if at < len(self.keys) and self.keys[at] == key else None

    def evidence(self, token: str) -> float:
        """What one occurrence of a token says, before the drift."""
        own = self.known(token)
        if own is None and len(token) > STEM:
            own = self.known(token[:STEM])
        return own or 0.0


def _shrunk(delta: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    spread = SHRINK * deviation
    # Only positive evidence may build a passage; neutral words cost a little, clean ones more.
    return np.clip(np.sign(delta) * np.maximum(np.abs(delta) - spread, 0), -1.0, 6.0)


def log_odds(counts: DataFrame) -> Scorer | None:
    """The scorer that the counts give; none unless both classes have tokens. ``decay`` solves E[exp(decay·score)] = 1 over clean tokens."""
    stems = counts.where("stem is null")
    total, n_toxic, n_clean = stems.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_all", "n_toxic", "n_clean")]).first()
    if not n_toxic or not n_clean:
        return None
    seen = F.col("n_toxic") + F.col("n_clean")

    def most(rows: DataFrame, least: int) -> np.ndarray:
        # MAX_KEYS rows at most.
        frequent = rows.where(seen >= least).orderBy(seen.desc(), "key", "stem").limit(MAX_KEYS)
        found = frequent.select("key", F.coalesce("stem", F.lit(0)).alias("stem"), "n_all", "n_toxic", "n_clean").toArrow()
        return np.stack([c.to_numpy() for c in found.columns], axis=1).reshape(-1, 5)

    # A token seen once says nothing that its stem does not.
    s, w = most(stems, 1), most(counts.where("stem is not null"), 2)
    s = s[np.argsort(s[:, 0])]
    prior = PRIOR * s[:, 2] / total + 1e-2
    t, c = s[:, 3] + prior, s[:, 4] + prior
    deviation = np.sqrt(1 / t + 1 / c)
    of_stem = _shrunk(np.log(t / (n_toxic + PRIOR - t)) - np.log(c / (n_clean + PRIOR - c)), deviation)
    at = np.minimum(np.searchsorted(s[:, 0], w[:, 1]), len(s) - 1)
    w, at = (x[s[at, 0] == w[:, 1]] for x in (w, at))
    toxic_rate, clean_rate = (s[at, 3] + 0.5) / (n_toxic + 1), (s[at, 4] + 0.5) / (n_clean + 1)
    share = toxic_rate / (toxic_rate + clean_rate)
    both = n_toxic + n_clean
    t, c = w[:, 3] + 2 * TOKEN_PRIOR * share * n_toxic / both, w[:, 4] + 2 * TOKEN_PRIOR * (1 - share) * n_clean / both
    # A token is at least as certain as its stem, whose counts its own are added to.
    of_token = _shrunk(np.log(t / n_toxic) - np.log(c / n_clean), np.minimum(np.sqrt(1 / t + 1 / c), deviation[at]))
    # Clean text as a mixture: known tokens, and the rest of each stem.
    rest = np.maximum(s[:, 4] - np.bincount(at, weights=w[:, 4], minlength=len(s)), 0)
    weights, values = np.r_[w[:, 4], rest] / n_clean, np.r_[of_token, of_stem]
    drift = max(0.1, float(weights @ values) + 0.1)
    decay, low, high = 1.0, 1e-3, 20.0
    if (values[weights > 0] > drift).any():
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if weights @ np.exp(middle * (values - drift)) > weights.sum() else (middle, high)
        decay = low
    order = np.argsort(np.r_[s[:, 0], w[:, 0]], kind="stable")
    return Scorer(np.r_[s[:, 0], w[:, 0]][order], np.r_[of_stem, of_token][order], drift, float(decay))


def best_segment(scores: np.ndarray) -> float:
    """The largest sum of adjacent scores, at least 0."""
    if not len(scores):
        return 0.0
    total = np.cumsum(scores)
    floor = np.minimum.accumulate(np.r_[0.0, total[:-1]])
    return max(0.0, float((total - floor).max()))


def maximal_segments(scores: np.ndarray, least: float = 0.0) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end exclusive, sum) with a sum over ``least``, left to right, in linear time.

    Each new positive token starts a segment; it absorbs earlier ones back to the last whose left sum is lower, as long as
    its right sum is higher. Links to that last segment make the search amortised linear.
    """
    segments: list[list] = []  # start, end, sum before it, sum at its end, link to the last segment with a lower sum before
    total, done = 0.0, 0
    positive = np.flatnonzero(scores > 0)
    prefix = np.r_[0.0, np.cumsum(scores)]
    for at in positive:
        left, right = float(prefix[at]), float(prefix[at + 1])
        start = int(at)
        while True:
            link = len(segments) - 1
            while link >= 0 and segments[link][2] >= left:
                link = segments[link][4]
            if link < 0 or segments[link][3] >= right:
                segments.append([start, int(at) + 1, left, right, link])
                break
            start, left = segments[link][0], segments[link][2]
            del segments[link:]
    return [(s, e, r - l) for s, e, l, r, _ in segments if r - l > least]


class Evidence(dict):
    """Evidence by token, remembered."""

    def __init__(self, scorer: Scorer):
        self.scorer = scorer

    def __missing__(self, token: str) -> float:
        if len(self) >= _CACHE:
            self.clear()
        self[token] = found = self.scorer.evidence(token)
        return found

    def scores(self, words: list[str]) -> np.ndarray:
        """Of each word: its evidence, a k-th of it at the k-th occurrence if it speaks for toxicity, less the drift."""
        found = np.fromiter(map(self.__getitem__, words), float, len(words))
        times: Counter = Counter()
        for at in np.flatnonzero(found > 0):
            times[words[at]] += 1
            found[at] /= times[words[at]]
        return found - self.scorer.drift


def _statistics(text: str | None, evidence: Evidence) -> tuple[int, float, float]:
    """Of one text: tokens, best segment score, and the sum of extreme-value units over significant segments."""
    scorer, scores = evidence.scorer, evidence.scores(tokens(text or ""))
    n, best, units = len(scores), best_segment(scores), 0.0
    if n and scorer.units(best, n) >= SIGNIFICANT:
        each = np.array([s for _, _, s in maximal_segments(scores)])
        units = float(np.maximum(scorer.units(each, n) - SIGNIFICANT, 0).sum())
    return n, best, units


@dataclass
class Model:
    scorer: Scorer
    weights: np.ndarray | None = None  # slope, never negative, and intercept

    def probability(self, units) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(units))
        return 1 / (1 + np.exp(np.minimum(-(self.weights[0] * np.log1p(units) + self.weights[1]), 700)))


def segment_statistics(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, tokens, best segment score, the sum of extreme-value units over significant segments, and the score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        evidence = Evidence(held.value.scorer)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, best, units = zip(*(_statistics(text, evidence) for text in batch.column(1).to_pylist()), strict=True)
            columns = [batch.column(0), pa.array(n, pa.int64()), *(pa.array(c, pa.float64()) for c in (best, units, held.value.probability(units)))]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "best", "units", "score"])

        return handle

    return map_batches(docs, make, "doc_id long, n_tokens long, best double, units double, score double")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
          toxic_col: str = "toxic", held_out: bool = True) -> DataFrame:
    """doc_id, n_tokens, best, units, score (0 to 1) and predicted (1 from 0.5 on), one row per row of ``docs``."""
    keyed = keyed_texts(docs, id_col, text_col)
    scored = segment_statistics(keyed, fit(keyed, labels, label_id, toxic_col, held_out))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit(keyed: DataFrame, labels: DataFrame, label_id: str = "doc_id", toxic_col: str = "toxic", held_out: bool = True) -> Model:
    """The model learned from the labels: token scores from the counting folds, all else from fold 4.

    Best segments do not depend on ``log_k``, so it is fitted first; the units that the calibration weighs are then taken with it,
    as everywhere else.
    """
    small_batches(keyed.sparkSession)
    known = written(training_labels(labels, label_id, toxic_col, held_out=held_out), "toxicity-labels")
    scorer = log_odds(count_tokens(keyed, known))
    if scorer is None:
        return Model(Scorer())
    calibrating = F.broadcast(known.where("fold = 4").select("l_id", "toxic"))
    texts = written(keyed.join(calibrating, F.col("doc_id") == F.col("l_id"), "left_semi"), "toxicity-calibration")

    def measured() -> np.ndarray:
        marked = segment_statistics(texts, Model(scorer)).join(calibrating, F.col("doc_id") == F.col("l_id"))
        rows = marked.select("n_tokens", "best", "units", "toxic").orderBy(F.xxhash64("l_id"), "l_id", "best", "n_tokens", "units").limit(MAX_LABELS).collect()
        return np.array([tuple(r) for r in rows], dtype=float).reshape(-1, 4)

    n, best, _, y = measured().T
    if not 0 < y.sum() < len(y):
        return Model(scorer)
    scorer.log_k = float(scorer.decay * best[y == 0].mean() - 0.5772156649 - np.log(np.maximum(n[y == 0], 1)).mean())
    _, _, units, y = measured().T
    slope, intercept = logistic_fit(np.log1p(units)[:, None], y, ridge=1e-2)
    return Model(scorer, np.array([max(slope, 0.0), intercept]))


def passages(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every significant passage: doc_id, first and end token, score and extreme-value units."""

    held = docs.sparkSession.sparkContext.broadcast(scorer)

    def make():
        evidence = Evidence(held.value)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                scores = evidence.scores(tokens(text or ""))
                for start, end, total in maximal_segments(scores):
                    if (units := float(scorer.units(total, len(scores)))) >= SIGNIFICANT:
                        rows.append({"doc_id": doc_id, "first_token": start, "end_token": end, "segment_score": total, "units": units})
            kinds = pa.schema([("doc_id", pa.int64()), ("first_token", pa.int64()), ("end_token", pa.int64()), ("segment_score", pa.float64()), ("units", pa.float64())])
            return pa.RecordBatch.from_pylist(rows, kinds)

        return handle

    return map_batches(keyed_texts(docs, id_col, text_col), make, "doc_id long, first_token long, end_token long, segment_score double, units double")


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", toxic_col: str = "toxic") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns. Scored in a last pass, so no join by id is needed."""
    model = fit(keyed_texts(docs, id_col, text_col), labels, label_id, toxic_col)
    if model.weights is None:
        return docs
    at = docs.columns.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        evidence = Evidence(held.value.scorer)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            units = [_statistics(t, evidence)[2] for t in batch.column(at).to_pylist()]
            return batch.filter(pa.array(held.value.probability(units) < 0.5))

        return handle

    return map_batches(docs, make, docs.schema)
