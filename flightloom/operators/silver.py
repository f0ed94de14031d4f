"""Rolling route delay and dedup.

The rolling mean is taken *before* duplicates are removed, so duplicates sit inside its frame. Both windows need a total
order to give the same answer in every run; callers name it in ``order_by`` (columns of any type that sorts), or leave it out
and get a hash of the row followed by the row itself.

A window group is one task's work and cannot be split by Spark, and a single busy route may hold a large share of all rows.
So group sizes are checked first (one narrow, map-side combined count, which runs while the plan is built). If there are
groups beyond ``max_group_rows``, the rows are written once to the shared folder, those of large groups apart; these are then
dealt by range partitioning on group and order columns and sorted, and every ``max_group_rows`` of a range's rows are a piece, so pieces
follow the rows' own order, whatever the type or spread of the key, and small pieces need no more tasks. Each piece is its own window group, and the last rows of the pieces before it -- six values -- are carried
in by a join. The result is the same to the last digit.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import count_rows, row_hash, surrogate_key
from ..session import shared_dir
from ..sources.sinks import write_mart
from ..sources.tables import partition_dates, read_dates, read_fact

ROUTE = ("dep_iata", "arr_iata")
FLIGHT = ("flight_iata_full", "flight_date")
FRAME_ROWS = 7  # fixed value: this row and the six before it
MAX_GROUP_ROWS = 5_000_000
#: Rows of a range, at least: tasks, files and the sample that finds the ranges follow the input, not the number of pieces.
RANGE_ROWS = 250_000
#: Rows that a stored tail holds beyond those a frame reaches.
TAIL_SPARE = 6

# What the fact needs of a staged flight; the rest is dropped before the first shuffle.
SILVER_COLUMNS = (
    "flight_iata_full", "flight_number", "airline_iata", "dep_iata", "arr_iata", "flight_date", "dep_scheduled",
    "dep_actual", "arr_scheduled", "arr_actual", "flight_status", "dep_delay_min", "arr_delay_min", "ingestion_date",
)

_POSITION = "_position"
_PIECE = "_piece"
_ROW = "_row"
_GROUP = "_group"
_COPY = "_copy"
_LARGE = "_large"


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def _descending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in columns]


def _roll_whole_groups(
    flights: DataFrame, group: Sequence[str], order: Sequence[str], value: str, output: str
) -> DataFrame:
    in_order = Window.partitionBy(*group).orderBy(*_ascending(order))
    frame = in_order.rowsBetween(-(FRAME_ROWS - 1), Window.currentRow)
    return flights.withColumns(
        {output: F.avg(value).over(frame), _POSITION: F.row_number().over(in_order).cast("bigint")}
    )


def _stored(rows: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write once to the shared folder and read back."""
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.partitionBy(*partition_by).parquet(path)
    return rows.sparkSession.read.parquet(path)


def _numbered_copies(rows: DataFrame, at_most: int | None) -> DataFrame:
    """Tell exact copies apart by a number, so that even they can be cut into pieces.

    Copies are counted on the map side: a group of copies never travels as a whole. ``at_most`` shortens their runs.
    """
    counted = rows.groupBy(*rows.columns).agg(count_rows().alias("_copies"))
    last = F.least(F.col("_copies"), F.lit(at_most)) if at_most else F.col("_copies")
    return counted.withColumn(_COPY, F.explode(F.sequence(F.lit(1).cast("bigint"), last))).drop("_copies")


def _roll_cut_groups(
    rows: DataFrame, total: int, group: Sequence[str], order: Sequence[str], value: str, output: str, max_group_rows: int, shorten_copies: bool
) -> DataFrame:
    """The rolling mean for groups too large for one task. ``total`` is the number of rows."""
    # Copies are adjacent in any order, a frame spans seven rows, and dedup keeps only the first copy, so where dedup
    # follows, copies beyond the seventh can affect no result.
    numbered = _numbered_copies(rows, FRAME_ROWS if shorten_copies else None)
    group_key = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in group])
    order = [*order, _COPY]
    keyed = numbered.withColumn(_GROUP, group_key)
    # Twice as many ranges as needed: they are drawn from a sample.
    ranges = -(-2 * total // max(max_group_rows, RANGE_ROWS))
    dealt = keyed.repartitionByRange(ranges, _GROUP, *_ascending(order)).sortWithinPartitions(_GROUP, *_ascending(order))
    # The lower 33 bits of this id number a range's rows, the upper ones the ranges. A piece is named by its first row.
    numbered_rows = dealt.withColumn(_ROW, F.monotonically_increasing_id())
    first = F.col(_ROW) - F.col(_ROW).bitwiseAND(F.lit((1 << 33) - 1)) % max_group_rows
    rows = _stored(numbered_rows.withColumn(_PIECE, first), "pieces")
    piece = [_GROUP, _PIECE]

    # The last rows of every piece. Ranking with a limit is cut down on the map side, so only these rows are shuffled.
    backwards = Window.partitionBy(*piece).orderBy(*_descending(order))
    tails = (
        rows.select(*piece, *order, value)
        .withColumn("_back", F.row_number().over(backwards))
        .where(F.col("_back") < FRAME_ROWS)
        .groupBy(*piece)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("at"), F.col(value).alias("v")))).alias("tail"))
        .select(*piece, F.col("tail.v").alias("tail"))
    )
    # Every piece has at least one row, so the six pieces before it always hold the six rows before it.
    before = Window.partitionBy(_GROUP).orderBy(_PIECE).rowsBetween(-(FRAME_ROWS - 1), -1)
    carry = tails.select(*piece, F.flatten(F.collect_list("tail").over(before)).alias("_carried"))

    in_order = Window.partitionBy(*piece).orderBy(*_ascending(order))
    frame = in_order.rowsBetween(-(FRAME_ROWS - 1), Window.currentRow)
    own = rows.withColumns(
        {
            "_sum": F.sum(value).over(frame),
            "_known": F.count(value).over(frame),
            "_at": F.row_number().over(in_order).cast("bigint"),
        }
    )
    joined = own.join(carry, piece, "left")

    # A row near the start of its piece still lacks (7 - position) rows; they are the last ones carried in.
    lacking = (F.lit(FRAME_ROWS) - F.col("_at")).cast("int")
    available = F.coalesce(F.array_size("_carried"), F.lit(0))
    taken = F.when(
        (lacking > 0) & (available > 0),
        F.slice("_carried", F.greatest(available - lacking + 1, F.lit(1)), F.greatest(lacking, F.lit(0))),
    ).otherwise(F.slice("_carried", F.lit(1), F.lit(0)))
    known = F.filter(taken, lambda v: v.isNotNull())
    extra = F.coalesce(F.aggregate(known, F.lit(0).cast("bigint"), lambda a, v: a + v), F.lit(0))
    total_value = F.coalesce(F.col("_sum"), F.lit(0)) + extra
    count = F.col("_known") + F.coalesce(F.array_size(known), F.lit(0))
    return joined.withColumns({output: F.try_divide(total_value.cast("double"), count), _POSITION: F.col(_ROW)}).drop(
        _GROUP, _PIECE, _ROW, _COPY, "_sum", "_known", "_at", "_carried"
    )


def _roll(
    flights: DataFrame,
    order_by: Sequence[str],
    batch: Sequence[str],
    within: Sequence[str],
    value: str,
    output: str,
    max_group_rows: int,
    shorten_copies: bool,
) -> DataFrame:
    group, order = [*batch, *ROUTE], [*within, *order_by]
    large = flights.groupBy(*group).count().where(F.col("count") > max_group_rows)
    total = large.agg(F.sum("count")).first()[0]
    if total is None:
        return _roll_whole_groups(flights, group, order, value, output)

    listed = large.select(*[F.col(c).alias(f"_large_{c}") for c in group], F.lit(True).alias(_LARGE))
    is_listed = F.lit(True)
    for c in group:
        is_listed = is_listed & F.col(c).eqNullSafe(F.col(f"_large_{c}"))
    marked = flights.join(listed, is_listed, "left").select(*flights.columns, F.coalesce(_LARGE, F.lit(False)).alias(_LARGE))
    copy = _stored(marked, "routes", [_LARGE])
    part = lambda which: copy.where(F.col(_LARGE) == which).select(*flights.columns)
    whole = _roll_whole_groups(part(False), group, order, value, output)
    cut = _roll_cut_groups(part(True), total, group, order, value, output, max_group_rows, shorten_copies)
    return whole.unionByName(cut)


def rolling_route_delay(
    flights: DataFrame,
    order_by: Sequence[str],
    batch: Sequence[str] = (),
    value: str = "dep_delay_min",
    output: str = "avg_delay_7d",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Mean delay over this row and the six before it on the same route, in date order.

    Seven *rows*, not seven days. ``order_by`` must order rows of equal date totally. ``batch`` columns keep batches apart.
    """
    rolled = _roll(flights, order_by, batch, ["flight_date"], value, output, max_group_rows, shorten_copies=False)
    return rolled.drop(_POSITION)


def dedup_flights(flights: DataFrame, order_by: Sequence[str], latest_first: Sequence[str] = ("ingestion_date",)) -> DataFrame:
    """One row per flight and date: the latest ingested, then the first in ``order_by``.

    All flights of a date whose identity is unknown collapse into one row. Spark limits the rank on the map side, so such a
    group reaches its reducer as one row per input partition.
    """
    best_first = [F.col(c).desc_nulls_last() for c in latest_first] + _ascending(order_by)
    rank = F.row_number().over(Window.partitionBy(*FLIGHT).orderBy(*best_first))
    return flights.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _ordered(staged: DataFrame, order_by: Sequence[str] | None, keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    columns = list(dict.fromkeys([*SILVER_COLUMNS, *keep, *(order_by or ())]))
    rows = staged.select(*columns)
    if order_by:
        return rows, list(order_by)
    return rows.withColumn("_row_hash", row_hash(columns)), ["_row_hash", *columns]


def silver_flights(
    staged: DataFrame,
    order_by: Sequence[str] | None = None,
    batch: str | None = None,
    rolling: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Staged flights with their rolling delay, one row per flight and date.

    ``batch`` names the column that tells batches apart when several are processed at once: frames do not cross batches, and
    the latest batch wins, which is what running the batches one after the other gives. ``rolling=False`` leaves the rolling
    delay out, for readers that do not need it.
    """
    batches = [batch] if batch else []
    rows, order = _ordered(staged, order_by, batches)
    latest_first = [*batches, "ingestion_date"]
    if not rolling:
        return dedup_flights(rows, order, latest_first).drop("_row_hash")
    rolled = _roll(
        rows, order, batches, ["flight_date"], "dep_delay_min", "avg_delay_7d", max_group_rows, shorten_copies=True
    )
    return dedup_flights(rolled, [*order, _POSITION], latest_first).drop("_row_hash", _POSITION)


def incremental_window(
    fact: DataFrame | str,
    staged: DataFrame,
    order_by: Sequence[str] | None = None,
    days: int = 7,
    latest: date | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``silver_flights`` for a new batch whose frames may reach back into the stored fact.

    Only fact rows of the last ``days`` days before ``latest`` are read (partition-pruned), without the flights the batch
    replaces. ``latest`` is the fact's last flight date; without it, it is taken from the partition directories if ``fact`` is
    a path, and looked up in the rows if it is a frame. At equal date, stored rows come before the batch's, by their key.
    """
    rows, order = _ordered(staged, order_by, ())
    if isinstance(fact, str):
        last = latest or max(partition_dates(staged.sparkSession, fact, "flight_date"), default=None)
        fact = read_fact(staged.sparkSession, fact)
    else:
        last = latest or fact.agg(F.max("flight_date")).first()[0]
    batch = _keyed_batch(rows)
    if last is None:
        history = batch.limit(0)
    else:
        history = _as_history(_without(fact.where(F.col("flight_date") >= F.lit(last - timedelta(days=days))), batch))
    return _framed(batch, history, order, max_group_rows)


def _keyed_batch(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"_in_batch": F.lit(1), "_stored_key": F.lit(None).cast("string"), "_flight_key": surrogate_key(*map(F.col, FLIGHT))}
    )


def _without(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows but for the flights that the batch replaces."""
    return stored.join(batch.select(F.col("_flight_key").alias("flight_key")), "flight_key", "left_anti")


def _as_history(stored: DataFrame) -> DataFrame:
    return stored.select(*ROUTE, "flight_date", "dep_delay_min", F.col("flight_key").alias("_stored_key"), F.lit(0).alias("_in_batch"))


def _framed(batch: DataFrame, history: DataFrame, order: Sequence[str], max_group_rows: int) -> DataFrame:
    together = batch.unionByName(history, allowMissingColumns=True)
    rolled = _roll(
        together,
        ["_stored_key", *order],
        (),
        ["flight_date", "_in_batch"],
        "dep_delay_min",
        "avg_delay_7d",
        max_group_rows,
        shorten_copies=True,
    ).where(F.col("_in_batch") == 1)
    return dedup_flights(rolled, [*order, _POSITION]).drop("_row_hash", _POSITION, "_in_batch", "_stored_key", "_flight_key")


def route_tails(fact: DataFrame, spare: int = TAIL_SPARE) -> DataFrame:
    """Per route and date the last stored rows that a later frame can reach: six, and ``spare`` ones in place of flights that a batch replaces.

    Spark limits the rank on the map side, so a busy route arrives as a few rows per input partition. ``place`` counts from the last row.
    """
    last_first = Window.partitionBy(*ROUTE, "flight_date").orderBy(F.col("flight_key").desc())
    narrow = fact.select(*ROUTE, "dep_delay_min", "flight_key", "flight_date")
    return narrow.withColumn("place", F.row_number().over(last_first)).where(F.col("place") < FRAME_ROWS + spare)


def carried_window(
    tails_path: str,
    fact_path: str,
    staged: DataFrame,
    order_by: Sequence[str] | None = None,
    days: int = 7,
    spare: int = TAIL_SPARE,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``incremental_window`` with the frames' beginnings carried by a stored table of ``route_tails``, a few rows a route and date, instead of all
    rows of the last days.

    At equal date stored rows stand before the batch's, so a frame takes of a date's stored rows the last ones only. The fact is read for those
    dates alone on which a batch replaces more of a route's tail than the spare rows make up for.
    """
    spark = staged.sparkSession
    rows, order = _ordered(staged, order_by, ())
    batch = _keyed_batch(rows)
    stored_dates = partition_dates(spark, tails_path, "flight_date")
    recent = [day for day in stored_dates if day >= max(stored_dates) - timedelta(days=days)]
    if not recent:
        return _framed(batch, batch.limit(0), order, max_group_rows)
    tails = read_dates(spark, tails_path, recent)
    left = _without(tails, batch)
    group = [*ROUTE, "flight_date"]
    # Cut tails are full ones of which too little is left. One narrow aggregate over a few rows a route.
    full = tails.groupBy(*group).agg(count_rows().alias("held")).where(F.col("held") == FRAME_ROWS - 1 + spare)
    kept = left.groupBy(*[F.col(c).alias(f"_kept_{c}") for c in group]).agg(count_rows().alias("kept"))
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_kept_{c}"))
    cut = full.join(kept, same, "left").where(F.coalesce("kept", F.lit(0)) < FRAME_ROWS - 1).select(*[F.col(c).alias(f"_cut_{c}") for c in group])
    cut_dates = [r[0] for r in cut.select("_cut_flight_date").distinct().collect()]  # at most ``days`` and one
    history = _as_history(left)
    if cut_dates:
        is_cut = F.lit(True)
        for c in group:
            is_cut = is_cut & F.col(c).eqNullSafe(F.col(f"_cut_{c}"))
        deeper = _without(read_dates(spark, fact_path, cut_dates), batch).join(cut, is_cut, "left_semi")
        history = _as_history(left.join(cut, is_cut, "left_anti")).unionByName(_as_history(deeper))
    return _framed(batch, history, order, max_group_rows)


def keep_tails(spark: SparkSession, fact_path: str, tails_path: str, touched: Sequence[date] | None = None, spare: int = TAIL_SPARE) -> None:
    """Bring the stored tails up to date with the fact, for the dates an upsert touched or for all."""
    changed = read_fact(spark, fact_path) if touched is None else read_dates(spark, fact_path, touched)
    if changed is not None:
        write_mart(route_tails(changed, spare), tails_path, ["flight_date"], only_touched=touched is not None)
