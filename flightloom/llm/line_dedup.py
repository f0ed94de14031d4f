"""Line dedup by winnowing over line hashes. Built-in functions only.

A run of at least ``min_lines`` lines that stands earlier, in an earlier document or further up in the same one, is deleted.
Exactly: number the lines that hold more than white space; a window is ``min_lines`` of them in a row; a window is
repeated if the same lines also start at an earlier place, by document id and then position. Repeated windows that overlap or
touch form a run, and every line of the run goes, blank ones inside included. Each place is judged on the input. With ``min_words``
fewer lines in a row are windows too if they hold that many words; the pipeline asks for ``LONG_WORDS``, the SQL of op6 has none.

* Of each window the smallest line hash is its fingerprint, so equal windows have equal fingerprints, wherever they stand.
* Fingerprints that stand at one place only cannot repeat; they are counted first, map-side, and drop most of the text.
* Around the others a match is extended both ways: all windows that hold the fingerprint as their minimum compare their lines by
  a 128-bit hash with the first place of the same window. One aggregation finds the first place, so no list of places
  is ever gathered, however common a line is. Very common fingerprints and windows get theirs by a broadcast (``hot``).
* Neighbouring repeated windows join into maximal runs, and texts are cut at the runs' ends by slices.

Null texts stay null and have no lines. Texts of fewer than ``min_lines`` lines stay as they are, but for long lines if ``min_words`` is given. Documents stand in the order of
their id, null first, and of a hash of their text where an id repeats; rows equal in both stand at the same place and share one fate.
All columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, written
from .hot import join_facts

MIN_LINES = 3
#: Words from which one or two repeated lines are a passage of their own.
LONG_WORDS = 50
_SOLID = r"[^ \t\r\x0b\x0c]"
_WORD = r"[^ \t\r\x0b\x0c]+"


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """Every window: its document, number, lines, fingerprint, two hashes of its lines, and its first and last line."""
    text = column(text_col)
    lines = F.transform(
        F.split(text, "\n", -1),
        lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), x.rlike(_SOLID).alias("solid"),
                              (F.lit(0) if min_words is None else F.regexp_count(x, F.lit(_WORD))).alias("words")),
    )
    solid = docs.select(column(id_col).alias("d"), F.xxhash64(text).alias("k"), F.filter(lines, lambda s: s["solid"]).alias("s"))
    solid = solid.where(F.size("s") >= (min_lines if min_words is None else 1))
    at = lambda name: F.transform("s", lambda s: s[name])
    arrays = solid.select("d", "k", at("i").alias("i"), at("a").alias("a"), at("b").alias("b"), at("words").alias("words"))
    # The generator keeps the arrays from being computed again for every window.
    if min_words is None:
        each = arrays.select("d", "k", "i", "a", "b", F.explode(F.sequence(F.lit(0), F.size("i") - min_lines)).alias("j"), F.lit(min_lines).alias("n"))
    else:
        each = arrays.select("d", "k", "i", "a", "b", "words", F.explode(F.sequence(F.lit(0), F.size("i") - 1)).alias("j"))
        held = lambda n: F.aggregate(F.slice("words", F.col("j") + 1, n), F.lit(0), lambda t, w: t + w)
        wide = [F.when((F.col("j") + n <= F.size("i")) & (F.lit(n == min_lines) | (held(n) >= min_words)), F.lit(n)) for n in range(1, min_lines + 1)]
        each = each.select("d", "k", "i", "a", "b", "j", F.explode(F.array_compact(F.array(*wide))).alias("n"))
    part = lambda name: F.slice(name, F.col("j") + 1, F.col("n"))
    return each.select(
        "d", "k", "j", "n", F.array_min(part("a")).alias("f"), F.xxhash64(part("a")).alias("w1"), F.xxhash64(part("b")).alias("w2"),
        F.element_at("i", F.col("j") + 1).alias("first_line"), F.element_at("i", F.col("j") + F.col("n")).alias("last_line"),
    )


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """One row per document with runs: d, k and its runs as a sorted array of (first_line, last_line), apart from each other."""
    found = written(windows(docs, id_col, text_col, min_lines, min_words), "line-windows")
    place = F.struct("d", "k", "j")
    # Neighbouring windows mostly share the line that is their minimum, so a fingerprint counts once for each such line at most
    # min_lines times; only one whose windows all hold the same single place may be dropped.
    spread = found.groupBy("f").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count(F.lit(1)).alias("places"))
    same = (F.col("lo.d").eqNullSafe(F.col("hi.d"))) & (F.col("lo.k") == F.col("hi.k")) & (F.col("hi.j") == F.col("lo.j"))
    shared = join_facts(found, written(spread.where(~same).select("f", "places"), "line-fingerprints"), ["f"])
    shared = written(shared.drop("f"), "line-shared")
    first = shared.groupBy("n", "w1", "w2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places")).where("places > 1")
    later = join_facts(shared, written(first, "line-first"), ["n", "w1", "w2"]).where(place > F.col("first"))
    later = later.select("d", "k", "j", "n", "first_line", "last_line").distinct()
    order = Window.partitionBy("d", "k").orderBy("j", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.when(F.col("j") <= F.max(F.col("j") + F.col("n")).over(before), 0).otherwise(1)
    runs = later.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order)).groupBy("d", "k", "run")
    runs = runs.agg(F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line"))
    return runs.groupBy("d", "k").agg(F.sort_array(F.collect_list(F.struct("first_line", "last_line"))).alias("runs"))


def without_runs(text: Column, runs: Column) -> Column:
    """``text`` without the lines of ``runs``: the slices between one run's end and the next one's start."""
    lines = F.split(text, "\n", -1)
    ends = F.concat(F.array(F.lit(-1)), F.transform(runs, lambda r: r["last_line"]))
    starts = F.concat(F.transform(runs, lambda r: r["first_line"]), F.array(F.size(lines)))
    kept = F.transform(F.arrays_zip(ends.alias("e"), starts.alias("s")), lambda g: F.struct(g["e"].alias("e"), g["s"].alias("s")))
    return F.array_join(F.flatten(F.transform(kept, lambda g: F.slice(lines, g["e"] + 2, g["s"] - g["e"] - 1))), "\n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` in a struct ``row``, with ``kept`` (the text that stays), ``n_lines`` and ``n_removed``."""
    runs = repeated_runs(docs, id_col, text_col, min_lines, min_words)
    keyed = docs.select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("key"), F.struct(*map(column, docs.columns)).alias("row"))
    joined = keyed.join(runs, F.col("id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    text = F.col("row").getField(text_col)
    removed = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last_line"] - r["first_line"] + 1)
    return joined.select(
        "row",
        F.when(F.col("runs").isNull(), text).otherwise(without_runs(text, F.col("runs"))).alias("kept"),
        F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
    )
