"""URL filter: host and path rules, and for all other URLs a character language-model ratio.

URLs that a rule decides teach two smoothed variable-order Markov models, one of allowed and one of blocked URLs: counts of every byte after its
last 0 to ``ORDERS - 1`` bytes, over all such URLs. A byte's probability backs off from long contexts to short ones. The score of a
URL is the difference of its two log-likelihoods per byte; the cut is the one with the best balanced accuracy on the decided URLs of
fold 0, which take no part in the counts. URLs at or over it are allowed.

Counts are exact and kept as a table, one row for each distinct stretch of ``ORDERS`` bytes, however many there are; shorter contexts are sums over it.
From order to order a stretch joins the one that ends it, so a key has at most 256 rows. A URL's score is the sum of its stretches' log ratios. The most
frequent stretches, which nearly every URL holds, are at most ``FREQUENT`` whatever the data, so they go to the tasks and are summed in place; the
others are joined, and none of them holds more than a ``FREQUENT``-th of all places. Log ratios are whole billionths, so sums do not depend on their order.

A null URL or one without ``://`` has an empty host and path, fits no rule, and is judged by what bytes it has; without any its
difference is 0. Without decided URLs of both kinds every difference and the cut are 0, so everything undecided is allowed. Rows are
independent: repeated rows and null ids need no rule. Only the two named columns are read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, map_batches, small_batches, written

#: A context has 0 to ORDERS - 1 bytes. A stretch of ORDERS bytes fits into a long.
ORDERS = 6
#: Stretches whose ratios go to the tasks.
FREQUENT = 20_000
#: Weight of the shorter context's estimate, in observations.
BACK_OFF = 4.0
#: Score histogram by which the cut is chosen.
BINS, REACH = 800, 4.0
_UNIT = 1e9


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def judged_by_rules(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, url, host, path, rule and decided (the rule's verdict), both null where no rule fits. Built-in functions only.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins, then the first in order.
    """
    url = column(url_col).cast("string")
    base = pages.select(column(id_col).cast("long").alias("page_id"), url.alias("url"))
    at = F.instr("url", "://")
    base = base.withColumn("rest", F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit("")))
    base = base.withColumn("rest", F.coalesce("rest", F.lit("")))
    base = base.withColumn("raw_host", F.regexp_extract("rest", r"^([^/?#]*)", 1))
    after = F.expr("substring(rest, length(raw_host) + 1)")
    base = base.select(
        "page_id", "url", F.translate("raw_host", string.ascii_uppercase, string.ascii_lowercase).alias("host"), F.regexp_extract(after, r"^([^?#]*)", 1).alias("path")
    )
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = lambda r: ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
    choose = lambda value: F.coalesce(*[F.when(fits(r), F.lit(value(r))) for r in ordered], F.lit(None).cast("string"))
    return base.withColumns({"rule": choose(lambda r: r.name), "decided": choose(lambda r: r.verdict)})


def stretches(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each URL, the last ORDERS bytes up to it as one number, with zeros before the start, and the URL it belongs to."""
    data = [u.encode("utf-8", "surrogatepass") for u in urls]
    lengths = np.array([len(d) for d in data], dtype=np.int64)
    padded = np.frombuffer(b"".join(b"\0" * (ORDERS - 1) + d for d in data), dtype=np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(data)), lengths)
    at = np.arange(len(owner)) + (ORDERS - 1) * (owner + 1)
    out = np.zeros(len(at), dtype=np.int64)
    for back in range(ORDERS - 1, -1, -1):
        out = out << 8 | padded[at - back]
    return out, owner


def _last(stretch: str | F.Column, order: int) -> F.Column:
    """The last ``order`` + 1 bytes of a stretch."""
    return (F.col(stretch) if isinstance(stretch, str) else stretch).bitwiseAND((1 << 8 * (order + 1)) - 1)


def count_stretches(judged: DataFrame) -> DataFrame:
    """Written counts (stretch, n, allowed, blocked): over all URLs, and over the decided ones outside fold 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = np.array([{"allow": 1, "block": 2}.get(v, 0) for v in batch.column(1).to_pylist()])
            found, owner = stretches([u or "" for u in batch.column(0).to_pylist()])
            each, at = np.unique(found, return_inverse=True)
            counts = [np.bincount(at, minlength=len(each))] + [np.bincount(at[verdicts[owner] == k], minlength=len(each)) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (each, *counts)], names=["stretch", "n", "allowed", "blocked"])

    teaching = F.when(F.col("fold") != 0, F.col("decided"))
    partial = judged.select("url", teaching.alias("taught")).mapInArrow(run, "stretch long, n long, allowed long, blocked long")
    return written(partial.groupBy("stretch").agg(*[F.sum(c).alias(c) for c in ("n", "allowed", "blocked")]), "url-stretches")


def log_ratios(counts: DataFrame) -> DataFrame:
    """(stretch, ratio): the log-probability of a stretch's last byte after the others under the allowed model less that under the blocked one, in
    billionths. One written table an order."""
    classes = ("allowed", "blocked")
    below = None
    for order in range(ORDERS):
        grams = counts.groupBy(_last("stretch", order).alias("gram")).agg(*[F.sum(c).alias(c) for c in classes])
        # A context is followed by at most 256 bytes.
        same_context = Window.partitionBy(F.shiftright("gram", 8))
        grams = grams.select("gram", *classes, *[F.sum(c).over(same_context).alias(f"seen_{c}") for c in classes])
        if below is None:
            shorter = grams.withColumns({f"p_{c}": F.lit(1 / 256) for c in classes})
        else:
            # At most 256 stretches end in the same shorter one.
            shorter = grams.join(below, _last("gram", order - 1) == F.col("end")).drop("end")
        p = {c: (F.col(c) + BACK_OFF * F.col(f"p_{c}")) / (F.col(f"seen_{c}") + BACK_OFF) for c in classes}
        below = written(shorter.select(F.col("gram").alias("end"), *[p[c].alias(f"p_{c}") for c in classes]), "url-orders")
    return below.select(F.col("end").alias("stretch"), F.round((F.log("p_allowed") - F.log("p_blocked")) * _UNIT).cast("long").alias("ratio"))


def differences(judged: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The written table ``judged``, whose rows have a ``row_id``, with ``difference``: log-likelihood per byte under the allowed model less that under the blocked one."""
    spark = judged.sparkSession
    counts = count_stretches(judged)
    places, allowed, blocked = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "allowed", "blocked")]).first()
    if not allowed or not blocked:
        return judged.withColumn("difference", F.lit(0.0))
    ratios = written(log_ratios(counts), "url-ratios")
    # Fewer than ``frequent`` stretches can have as many places.
    often = F.col("n") > F.lit(places / frequent)
    known = ratios.join(counts.where(often).select("stretch"), "stretch", "left_semi").orderBy("stretch").toArrow()
    held = spark.sparkContext.broadcast((known.column("stretch").to_numpy(), known.column("ratio").to_numpy()))

    def make():
        keys, values = held.value

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            """Per URL one row with the sum over its frequent stretches and its length, and one row for each other stretch."""
            found, owner = stretches([u or "" for u in batch.column(1).to_pylist()])
            rows = batch.column(0).to_numpy()
            at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
            there = keys[at] == found if len(keys) else np.zeros(len(found), bool)
            total = np.zeros(len(rows), np.int64)
            np.add.at(total, owner[there], values[at[there]])
            length = np.bincount(owner, minlength=len(rows)).astype(np.int64)
            others = len(found) - int(there.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.r_[rows, rows[owner[~there]]]), pa.array(np.r_[np.zeros(len(rows), np.int64), found[~there]], mask=np.r_[np.ones(len(rows), bool), np.zeros(others, bool)]),
                 pa.array(np.r_[total, np.zeros(others, np.int64)]), pa.array(np.r_[length, np.zeros(others, np.int64)])],
                names=["row_id", "stretch", "total", "length"])

        return handle

    parts = written(map_batches(judged.select("row_id", "url"), make, "row_id long, stretch long, total long, length long"), "url-parts")
    summed = parts.where("stretch is null").select("row_id", "total", "length")
    joined = parts.where("stretch is not null").select("row_id", "stretch").join(ratios, "stretch").select("row_id", F.col("ratio").alias("total"), F.lit(0).cast("long").alias("length"))
    whole = summed.unionByName(joined).groupBy(F.col("row_id").alias("of_row")).agg(F.sum("total").alias("total"), F.sum("length").alias("length"))
    difference = F.col("total") / _UNIT / F.greatest(F.col("length"), F.lit(1))
    return judged.join(whole, F.col("row_id") == F.col("of_row")).select(*judged.columns, difference.alias("difference"))


def cut_of(histogram: dict[tuple[int, str], int]) -> float:
    """The bin edge with the best balanced accuracy; among equals the one nearest 0, then the lower."""
    counts = np.zeros((2, BINS + 1))
    for (b, verdict), n in histogram.items():
        counts[int(verdict == "block"), min(max(b, 0), BINS)] += n
    if not counts.sum(axis=1).all():
        return 0.0
    share = counts / counts.sum(axis=1, keepdims=True)
    below = np.c_[np.zeros(2), share.cumsum(axis=1)]
    quality = (1 - below[0]) + below[1]
    edges = (np.arange(BINS + 2) / BINS * 2 - 1) * REACH
    best = np.flatnonzero(quality >= quality.max() - 1e-12)
    return float(edges[best[np.lexsort((edges[best], np.abs(edges[best])))[0]]])


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", frequent: int = FREQUENT) -> DataFrame:
    """page_id, host, path, rule, verdict, difference: one row per row of ``pages``."""
    small_batches(pages.sparkSession, rows=10_000)
    judged = judged_by_rules(pages, rules, id_col, url_col).withColumn("fold", F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(5)))
    judged = written(judged.withColumn("row_id", F.monotonically_increasing_id()), "urls-judged")
    scored = written(differences(judged, frequent), "urls")
    bin_of = F.floor((F.col("difference") / REACH + 1) / 2 * BINS).cast("int")
    held = scored.where("decided is not null and fold = 0").groupBy(F.greatest(F.least(bin_of, F.lit(BINS)), F.lit(0)).alias("b"), "decided")
    cut = cut_of({(r["b"], r["decided"]): r["n"] for r in held.agg(F.count(F.lit(1)).alias("n")).collect()})
    verdict = F.coalesce("decided", F.when(F.col("difference") >= cut, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "difference")
