"""Personal data: fixed base patterns, and boosted candidates on top of them.

Generators with high recall propose overlapping spans: anything that looks a little like one of the four kinds. Gradient
boosted trees score each candidate by format and context features. These hide what tells a base match from other ways to write the same:
``name [at] host [dot] org`` has the features of its address, a phone those of itself without ``+``, and separators between digits are all
alike. So what is learned from base matches holds for the forms that the base patterns do not know. Labels:

* Positive: a candidate that overlaps a base span of its kind.
* Negative: any other, also one inside a base span of another kind, and broken copies of base spans (a wrong check digit, a part over
  255, no domain, too few digits). The latter two are made for a share of the spans only (``SPARE``) and never selected.
* Neither: a candidate that is another form of its kind as far as one can tell (``plausible``). Trees do not learn from it, but judge it.

They learn from every labelled candidate of all documents, but for a quarter held out by a hash: Spark counts equal feature vectors, and sums
the trees' histograms over them. Their margins are calibrated on the held-out candidates, all of them, and the threshold of each kind is the
lowest one that keeps ``PRECISION`` there; a kind without enough held-out examples of both classes adds nothing. Chosen candidates that overlap no base span are added, best
first, without overlaps within a kind. Base spans always stay.

Null texts count as empty and hold nothing. Rows are independent: repeated rows and null ids need no rule. Only the two named
columns are read; ``redact`` returns all columns of its input.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .boosting import Booster, logistic_fit, logistic_fit_table, sigmoid
from .common import column, keyed_texts, map_batches, small_batches, written

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
#: Decimals of the probabilities that are held against thresholds, so that no kind has more than a million of them to try.
DECIMALS = 6
#: Held-out examples of either class that a kind needs before it may add spans.
LEAST_HELD_OUT = 20

# The base patterns. Possessive groups match the same spans in linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")

#: Made counter-examples: one of so many base spans, by a hash of its characters.
SPARE = 4

# Generators: deliberately loose, linear in the text, of any length.
_AT, _DOT = r" ?(?:@|[\[({]at[\])}]) ?", r"(?:\.| ?[\[({](?:dot|\.)[\])}] ?)"
_LOOSE_EMAIL = re.compile(rf"(?<![\w.%+-])[\w.%+-]++{_AT}[\w-]++(?:{_DOT}[\w-]++)*+", re.I)
_LOOSE_IP = re.compile(rf"(?<![0-9])[0-9]++(?:(?: ?[.,] ?|{_DOT})[0-9]++){{3,}}+|(?:[0-9A-Fa-f]{{0,4}}:){{3,7}}[0-9A-Fa-f]{{1,4}}", re.I)
_LOOSE_NUMBER = re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,}+")
_BRACKETED_AT = re.compile(r"[\[({]at[\])}]", re.I)
_ANY_AT, _ANY_DOT = re.compile(_AT, re.I), re.compile(_DOT, re.I)
_MAIL_WORDS = re.compile(r"mail|contact|kontakt|correo|courriel|write|reach|@", re.I)
_PHONE_WORDS = re.compile(r"phone|tel|call|fax|mobil|whatsapp|dial|ring", re.I)
_CARD_WORDS = re.compile(r"card|visa|master|amex|pay|karte|carte|tarjeta|credit", re.I)
_NET_WORDS = re.compile(r"\bip\b|host|server|addr|address|ping|login|client", re.I)
_OTHER_WORDS = re.compile(r"version|order|isbn|id\b|no\.|ref|invoice|token|key|page|sku", re.I)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _emails(text: str):
    """A match holds one @ after its local part, so going from @ to @ finds the leftmost matches in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base matches of the four kinds, by start and then kind."""
    spans = [("email", *s) for s in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                spans.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    spans.append(("phone", m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Loose proposals. They may overlap: a stretch of digits is proposed both as a card and as a phone, and if it is longer than
    either, its undivided parts are proposed as well."""
    found = [("email", m.start(), m.end()) for m in _LOOSE_EMAIL.finditer(text)] if "@" in text or _BRACKETED_AT.search(text) else []
    if _DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in _LOOSE_IP.finditer(text)]
        for m in _LOOSE_NUMBER.finditer(text):
            found += [(kind, m.start(), m.end()) for kind in ("card", "phone")]
            if m.end() - m.start() > 19 and len(parts := list(_DIGITS.finditer(m[0]))) > 1 and sum(len(p[0]) for p in parts) > 19:
                found += [(kind, m.start() + p.start(), m.start() + p.end()) for p in parts if len(p[0]) >= 10 for kind in ("card", "phone")]
    return found


def masked(kind: str, span: str) -> str:
    """A span without what tells a base match from another way to write the same."""
    if kind == "email":
        return _ANY_DOT.sub(".", _ANY_AT.sub("@", span))
    if kind == "ip":
        return _ANY_DOT.sub(".", span).replace(" ", "")
    return ("" if kind == "card" else " ").join(_DIGITS.findall(span))  # cards are grouped in many ways, phones by their parts


def plausible(kind: str, span: str, before: str) -> bool:
    """Whether a span that is no base match is another form of its kind, as far as form and context tell."""
    plain = masked(kind, span)
    if kind == "email":
        name, _, host = plain.partition("@")
        return set(name) <= LOCAL and _DOMAIN.fullmatch(host) is not None
    if kind == "ip":
        return _IP.fullmatch(plain) is not None and _largest(plain) <= 255
    digits = plain.replace(" ", "")
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and bool(_PHONE_WORDS.search(before[-25:]))


def broken(kind: str, span: str) -> str:
    """A copy of a base match that is none."""
    if kind == "email":
        return span[: span.index(".", span.index("@"))]
    if kind == "ip":
        rest, _, last = span.rpartition(".")
        return f"{rest}.{int(last) + 256}"
    if kind == "card":
        return span[:-1] + str((int(span[-1]) + 1) % 10)
    return span[: [m.end() for m in _DIGIT.finditer(span)][7]]


def _largest(plain: str) -> int:
    """The largest number between points, 1,000 at most."""
    return max((1000 if len(p.lstrip("0")) > 3 else int(p or 0) for p in _DIGITS.findall(plain)), default=0)


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the masked span and what stands around it."""
    return _features(kind, text[start:end], text[max(0, start - 40) : start], text[end : end + 20])


def _features(kind: str, span: str, before: str, after: str) -> list[float]:
    plain = masked(kind, span)
    groups = _DIGITS.findall(plain)
    digits, sizes = "".join(groups), list(map(len, groups)) or [0]
    previous, following = before[-1:], after[:1]
    return [
        KINDS.index(kind), len(plain), len(digits), len(set(digits)), len(groups), max(sizes), min(sizes), int(digits[0]) if digits else -1,
        plain.partition("@")[2].count("."), plain.count("."), plain.count(":") + plain.count(","), sum(c.isalpha() for c in plain),
        kind == "card" and luhn(digits), kind == "ip" and _largest(plain) <= 255, previous.isalnum(), following.isalnum(),
        previous in "=\"'_#/", following in "\"'_%/", "." in after[:2], bool(_MAIL_WORDS.search(before)), bool(_PHONE_WORDS.search(before)),
        bool(_CARD_WORDS.search(before)), bool(_NET_WORDS.search(before)), bool(_OTHER_WORDS.search(before)),
    ]


N_FEATURES = len(features("", "email", 0, 0))
FOUND = "doc_id long, base array<struct<kind:string,start:long,end:long>>, proposed array<struct<kind:string,start:long,end:long,x:array<float>,positive:boolean,made:boolean>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_PROPOSED = pa.struct([*_SPAN, ("x", pa.list_(pa.float32())), ("positive", pa.bool_()), ("made", pa.bool_())])


class Apart:
    """Spans of one kind, none of which overlap, by start: what overlaps another is found by bisection."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()):
        self.spans = sorted(spans)

    def meets(self, start: int, end: int) -> bool:
        """Whether one of them shares a character with [start, end)."""
        at = bisect_left(self.spans, (end,))  # those before it start before ``end``
        return at > 0 and self.spans[at - 1][1] > start

    def add(self, start: int, end: int) -> None:
        insort(self.spans, (start, end))


def _by_kind(spans: Iterable[tuple[str, int, int]]) -> dict[str, Apart]:
    apart: dict[str, list] = {kind: [] for kind in KINDS}
    for kind, start, end in spans:
        apart[kind].append((start, end))
    return {kind: Apart(own) for kind, own in apart.items()}


def _scan(text: str, learn: bool = True) -> tuple[list[dict], list[dict]]:
    """Base spans and candidates of a text; with ``learn`` also candidates that are made to learn from only."""
    base = base_spans(text)
    known, proposed = _by_kind(base), []

    def propose(kind: str, start: int, end: int, span: str, positive: bool | None, made: bool) -> None:
        x = _features(kind, span, text[max(0, start - 40) : start], text[end : end + 20])
        proposed.append({"kind": kind, "start": start, "end": end, "x": x, "positive": positive, "made": made})

    def spared(span: str) -> bool:
        return learn and zlib.crc32(span.encode("utf-8", "surrogatepass")) % SPARE == 0

    for kind, start, end in candidates(text):
        own, span = known[kind].meets(start, end), text[start:end]
        if not own and any(spans.meets(start, end) for name, spans in known.items() if name != kind):
            if spared(span):
                propose(kind, start, end, span, False, True)
            continue  # part of a known span of another kind
        propose(kind, start, end, span, True if own else None if plausible(kind, span, text[max(0, start - 40) : start]) else False, False)
    for kind, start, end in base:
        if spared(text[start:end]):
            propose(kind, start, end, broken(kind, text[start:end]), False, True)
    return [{"kind": k, "start": s, "end": e} for k, s, e in base], proposed


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its base spans and its candidates with their features."""
    small_batches(docs.sparkSession)

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            both = [_scan(t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([b for b, _ in both], pa.list_(_SPAN)), pa.array([p for _, p in both], pa.list_(_PROPOSED))]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "proposed"])

        return handle

    return map_batches(keyed_texts(docs, id_col, text_col), make, FOUND)


class Selector:
    """Trees, their calibration, and a threshold for each kind."""

    def __init__(self, x: np.ndarray, positive: np.ndarray, held_out: np.ndarray):
        self.thresholds = dict.fromkeys(KINDS, float("inf"))
        self.booster, self.calibration = Booster(), np.array([1.0, 0.0])
        learn = ~held_out
        if not (0 < positive[learn].sum() < learn.sum()):
            return
        self.booster.fit(x[learn], positive[learn])
        margin, truth, kind = self.booster.margin(x[held_out]), positive[held_out], x[held_out, 0]
        if not (0 < truth.sum() < len(truth)):
            return
        self.calibration = logistic_fit(margin[:, None], truth)
        p = np.round(self.probability(x[held_out]), DECIMALS)
        for k, name in enumerate(KINDS):
            own, right = p[kind == k], truth[kind == k]
            if min(right.sum(), len(right) - right.sum()) >= LEAST_HELD_OUT:
                order = np.argsort(-own, kind="stable")
                precise = np.cumsum(right[order]) / np.arange(1, len(own) + 1) >= PRECISION
                last = np.r_[own[order][1:] != own[order][:-1], True]  # ties stand or fall together
                if (precise & last).any():
                    self.thresholds[name] = float(own[order][np.flatnonzero(precise & last)[-1]])

    @classmethod
    def of_table(cls, examples: DataFrame) -> "Selector":
        """The same of a written table (x, held, n, right) of any size: of each vector, how many candidates have it and how many are positive."""
        self = cls(np.zeros((0, N_FEATURES)), np.zeros(0), np.zeros(0, dtype=bool))
        counts = {r["held"]: (r["n"], r["right"]) for r in examples.groupBy("held").agg(F.sum("n").alias("n"), F.sum("right").alias("right")).collect()}
        (n, right), (n_held, right_held) = (counts.get(held, (0, 0)) for held in (False, True))
        if not 0 < right < n:
            return self
        self.booster.fit_table(examples.where("not held"))
        if not 0 < right_held < n_held:
            return self
        sums = [F.sum("n").alias("n"), F.sum("right").alias("right")]

        def margins(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array(batch.column(0).to_pylist(), dtype=float)
            return pa.RecordBatch.from_arrays([pa.array(x[:, 0].astype(int), pa.int64()), pa.array(self.booster.margin(x)), *batch.columns[1:]], names=["kind", "x", "n", "right"])

        def probabilities(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = np.round(self._of_margin(batch.column(1).to_numpy()), DECIMALS)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), *batch.columns[2:]], names=["kind", "p", "n", "right"])

        judged = map_batches(examples.where("held").select("x", "n", "right"), lambda: margins, "kind long, x double, n long, right long")
        judged = written(judged.groupBy("kind", "x").agg(*sums), "pii-margins")
        self.calibration = logistic_fit_table(judged)
        by_p = map_batches(judged, lambda: probabilities, "kind long, p double, n long, right long").groupBy("kind", "p").agg(*sums)
        above = Window.partitionBy("kind").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        precise = F.sum("right").over(above) / F.sum("n").over(above) >= PRECISION
        lowest = by_p.withColumn("precise", precise).groupBy("kind").agg(*sums, F.min(F.when(F.col("precise"), F.col("p"))).alias("least"))
        for r in lowest.collect():
            if min(r["right"], r["n"] - r["right"]) >= LEAST_HELD_OUT and r["least"] is not None:
                self.thresholds[KINDS[r["kind"]]] = r["least"]
        return self

    def _of_margin(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.calibration[0] * margin + self.calibration[1])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._of_margin(self.booster.margin(x))

    def adds(self, kind: str, p: float) -> bool:
        """Whether a candidate of this probability is taken."""
        return np.round(p, DECIMALS) >= self.thresholds[kind]


def examples(found: DataFrame) -> DataFrame:
    """Every labelled candidate of a written ``scan``, as counts: (x, held, n, right), where a quarter is held out. Copies count once."""
    each = found.select("doc_id", F.explode("proposed").alias("c")).where("c.positive is not null").select("doc_id", "c.*").distinct()
    held = F.pmod(F.xxhash64("doc_id", "kind", "start", "end", "made"), F.lit(4)) == 0
    return each.groupBy("x", held.alias("held")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("positive").cast("long")).alias("right"))


def train(found: DataFrame, max_training: int | None = None) -> Selector:
    """Fit on all labelled candidates of a written ``scan``; copies count once.

    Callers may name a bound instead. Then it is those with the smallest hashes, and a bound on the hash, from the number of candidates, keeps about
    a fifth more than that before any are ordered.
    """
    if max_training is None:
        return Selector.of_table(written(examples(found), "pii-examples"))
    total = found.agg(F.sum(F.size(F.filter("proposed", lambda c: c["positive"].isNotNull())))).first()[0] or 0
    bound = min(1.0, 1.2 * max_training / max(total, 1))
    each = found.select("doc_id", F.explode("proposed").alias("c")).where("c.positive is not null").select("doc_id", "c.*")
    keys = ["h", "doc_id", "kind", "start", "end", "made"]
    near = each.withColumn("h", F.xxhash64("doc_id", "kind", "start", "end", "made")).where(F.col("h") / 2.0**64 + 0.5 <= bound)
    drawn = near.dropDuplicates(keys).orderBy(keys).limit(max_training)
    rows = drawn.select("x", "positive", (F.pmod("h", F.lit(4)) == 0).alias("held")).collect()
    x = np.array([r["x"] for r in rows], dtype=float).reshape(-1, N_FEATURES)
    return Selector(x, np.array([r["positive"] for r in rows], dtype=float), np.array([r["held"] for r in rows], dtype=bool))


def select_spans(found: DataFrame, selector: Selector) -> DataFrame:
    """doc_id, base spans and all spans (base and added), each as an array of (kind, start, end) by start and then kind."""

    def make():
        def chosen(base: list[dict], proposed: list[dict], p: np.ndarray) -> list[dict]:
            spans, known = list(base), _by_kind((s["kind"], s["start"], s["end"]) for s in base)
            taken = {kind: Apart() for kind in KINDS}
            for i in np.argsort(-p, kind="stable"):
                c = proposed[i]
                where = c["start"], c["end"]
                if selector.adds(c["kind"], p[i]) and not taken[c["kind"]].meets(*where) and not any(k.meets(*where) for k in known.values()):
                    taken[c["kind"]].add(*where)
                    spans.append({k: c[k] for k in ("kind", "start", "end")})
            return sorted(spans, key=lambda s: (s["start"], KINDS.index(s["kind"])))

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [r | {"proposed": [c for c in r["proposed"] if not c["made"]]} for r in batch.to_pylist()]
            x = [c["x"] for r in rows for c in r["proposed"]]
            p = selector.probability(np.array(x, dtype=float)) if x else np.zeros(0)
            spans, at = [], 0
            for r in rows:
                n = len(r["proposed"])
                spans.append(chosen(r["base"], r["proposed"], p[at : at + n]) if n else r["base"])
                at += n
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "base", "spans"])

        return handle

    span = "array<struct<kind:string,start:long,end:long>>"
    return map_batches(found.select("doc_id", "base", "proposed"), make, f"doc_id long, base {span}, spans {span}")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base spans, all spans."""
    found = written(scan(docs, id_col, text_col), "pii")
    return select_spans(found, train(found))


def joined(spans) -> F.Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", placeholder: str = "[{}]") -> DataFrame:
    """``docs`` with every span in its text replaced by its kind in brackets. Overlapping spans become one, named by the first.

    Two passes over the text: one scans for spans to learn from, one scans again, selects and replaces, so that no text is
    joined back by an id that may repeat.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Ids only tell copies and what is held out; the text's own hash serves.
    keyed = docs.select(F.xxhash64(column(text_col)).alias("doc_id"), column(text_col).alias("text"))
    selector = train(written(scan(keyed).where(F.size("proposed") > 0), "pii"))
    at, schema = docs.columns.index(text_col), docs.schema

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(at).to_pylist()
            done = [clean(t) if t else t for t in texts]
            columns = [pa.array(done, batch.column(i).type) if i == at else batch.column(i) for i in range(batch.num_columns)]
            return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        def clean(text: str) -> str:
            base, proposed = _scan(text, learn=False)
            spans = [(b["start"], b["end"], b["kind"]) for b in base]
            if proposed:
                p = selector.probability(np.array([c["x"] for c in proposed], dtype=float))
                spans += [(c["start"], c["end"], c["kind"]) for c, q in zip(proposed, p, strict=True) if selector.adds(c["kind"], q)]
            out, done = [], 0
            for start, end, kind in sorted(spans):
                if start >= done:
                    out += [text[done:start], placeholder.format(kind.upper())]
                done = max(done, end)
            return "".join(out) + text[done:]

        return handle

    return map_batches(docs, make, schema)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
