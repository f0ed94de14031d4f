"""Rolling delay and dedup: order independence, brute force, and the path for groups too large for one task."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flightloom.operators import dedup_flights, incremental_window, rolling_route_delay, silver_flights
from flightloom.operators.silver import SILVER_COLUMNS
from flightloom.plans.marts import fact_flights

SCHEMA = (
    "flight_iata_full string, flight_number string, airline_iata string, dep_iata string, arr_iata string, "
    "flight_date date, dep_scheduled timestamp_ntz, dep_actual timestamp_ntz, arr_scheduled timestamp_ntz, "
    "arr_actual timestamp_ntz, flight_status string, dep_delay_min int, arr_delay_min int, ingestion_date date, "
    "insert_date date, event_id bigint"
)


def make_flights(seed, n=400, copies=0, hot_share=0.5):
    """Random flights: one hot route, some unknown airports, delays and identities, and runs of exact copies."""
    rng = random.Random(seed)
    rows = []
    for event_id in range(n):
        dep = "HOT" if rng.random() < hot_share else rng.choice(["A", "B", None])
        arr = "HOT" if dep == "HOT" else rng.choice(["X", None])
        number = str(rng.randint(1, 12))
        airline = rng.choice(["AA", "BB", None])
        day = date(2024, 1, 1) + timedelta(days=rng.choice([0, 0, 0, 1, 2, 5]))
        rows.append(
            (
                airline + number if airline else None, number, airline, dep, arr, day, None, None, None, None, "landed",
                rng.choice([None, *range(-20, 60)]), None, day + timedelta(days=rng.randint(0, 2)),
                date(2024, 2, 1 + rng.randint(0, 2)), event_id,
            )
        )
    for _ in range(copies):
        rows.append(rows[7])
    rng.shuffle(rows)
    return rows


def rolled_by_hand(rows, batch=False):
    """Rolling mean per row, by walking each route in order."""
    places = {c.split()[0]: i for i, c in enumerate(SCHEMA.split(", "))}
    get = lambda row, name: row[places[name]]
    routes = {}
    for row in rows:
        key = (get(row, "insert_date") if batch else None, get(row, "dep_iata"), get(row, "arr_iata"))
        routes.setdefault(key, []).append(row)
    result = []
    for members in routes.values():
        members.sort(key=lambda r: (get(r, "flight_date"), get(r, "event_id")))
        for i, row in enumerate(members):
            known = [d for d in (get(r, "dep_delay_min") for r in members[max(0, i - 6) : i + 1]) if d is not None]
            result.append((row, sum(known) / len(known) if known else None))
    return result, get


def silver_by_hand(rows, batch=False):
    rolled, get = rolled_by_hand(rows, batch)
    best = {}
    for position, (row, mean) in enumerate(rolled):
        key = (get(row, "flight_iata_full"), get(row, "flight_date"))
        newest = (-get(row, "insert_date").toordinal() if batch else 0, -get(row, "ingestion_date").toordinal())
        rank = (*newest, get(row, "event_id"), position)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, get(row, "event_id"), mean)
    return sorted(((event_id, mean) for _, event_id, mean in best.values()), key=lambda pair: pair[0])


def results(df):
    return sorted(((r.event_id, r.avg_delay_7d) for r in df.collect()), key=lambda pair: pair[0])


@pytest.mark.parametrize("max_group_rows", [5_000_000, 60, 7, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_rolling_matches_brute_force(spark, seed, max_group_rows):
    rows = make_flights(seed)
    expected, get = rolled_by_hand(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    rolled = rolling_route_delay(df, ["event_id"], max_group_rows=max_group_rows)
    key = lambda pair: pair[0]
    got = sorted(((r.event_id, r.avg_delay_7d) for r in rolled.collect()), key=key)
    assert got == sorted(((get(row, "event_id"), mean) for row, mean in expected), key=key)


@pytest.mark.parametrize("max_group_rows", [5_000_000, 50, 3])
@pytest.mark.parametrize("batch", [None, "insert_date"])
def test_silver_matches_brute_force_with_many_copies(spark, batch, max_group_rows):
    rows = make_flights(3, n=250, copies=120)
    df = spark.createDataFrame(rows, SCHEMA)
    silver = silver_flights(df, ["event_id"], batch=batch, max_group_rows=max_group_rows)
    assert results(silver) == silver_by_hand(rows, batch=bool(batch))


@pytest.mark.parametrize("max_group_rows", [5_000_000, 40])
def test_hash_order_does_not_depend_on_input_order(spark, max_group_rows):
    rows = make_flights(4, n=200, copies=60)
    again = list(rows)
    random.Random(99).shuffle(again)
    outcomes = []
    for given, partitions in ((rows, 3), (again, 7)):
        df = spark.createDataFrame(given, SCHEMA).repartition(partitions).drop("event_id")
        silver = silver_flights(df, max_group_rows=max_group_rows)
        assert set(silver.columns) == {*SILVER_COLUMNS, "avg_delay_7d"}
        outcomes.append(sorted(map(str, silver.collect())))
    assert outcomes[0] == outcomes[1]


def test_hash_order_is_the_same_on_both_paths(spark):
    df = spark.createDataFrame(make_flights(5, n=300, copies=90), SCHEMA).drop("event_id")
    whole = sorted(map(str, silver_flights(df).collect()))
    assert whole == sorted(map(str, silver_flights(df, max_group_rows=20).collect()))


def test_windows_come_before_dedup(spark):
    """A duplicate that dedup removes still counts in the frames after it."""
    day = date(2024, 1, 1)
    base = ("AA1", "1", "AA", "A", "B", day, None, None, None, None, "landed")
    rows = [
        (*base, 10, None, day, day, 1),
        (*base, 40, None, day, day, 2),
        ("AA2", "2", "AA", "A", "B", day, None, None, None, None, "landed", 10, None, day, day, 3),
    ]
    silver = silver_flights(spark.createDataFrame(rows, SCHEMA), ["event_id"])
    assert results(silver) == [(1, 10.0), (3, 20.0)]


def test_unknown_flights_of_a_date_become_one(spark):
    rows = [r for r in make_flights(6) if r[0] is None]
    kept = dedup_flights(spark.createDataFrame(rows, SCHEMA), ["event_id"])
    assert kept.count() == len({r[5] for r in rows})


def test_rolling_delay_is_optional(spark):
    df = spark.createDataFrame(make_flights(7), SCHEMA)
    with_it, without = silver_flights(df, ["event_id"]), silver_flights(df, ["event_id"], rolling=False)
    assert sorted(map(str, with_it.drop("avg_delay_7d").collect())) == sorted(map(str, without.collect()))


@pytest.mark.parametrize("max_group_rows", [5_000_000, 10])
def test_incremental_window_reaches_into_the_fact(spark, max_group_rows):
    rows = make_flights(8, n=120)
    df = spark.createDataFrame(rows, SCHEMA)
    split = F.lit("2024-01-03").cast("date")
    fact = fact_flights(df.where(F.col("flight_date") < split), "2024-02-01", ["event_id"])
    batch = df.where(F.col("flight_date") >= split)
    silver = incremental_window(fact, batch, ["event_id"], max_group_rows=max_group_rows)
    got = {r.event_id: r.avg_delay_7d for r in silver.collect()}
    last = fact.agg(F.max("flight_date")).first()[0]
    assert results(incremental_window(fact, batch, ["event_id"], latest=last)) == results(silver)

    stored = sorted(fact.collect(), key=lambda r: (r.flight_date, r.flight_key))
    incoming = sorted(batch.collect(), key=lambda r: (r.flight_date, r.event_id))
    for row in incoming:
        route = [r.dep_delay_min for r in stored if (r.dep_iata, r.arr_iata) == (row.dep_iata, row.arr_iata)]
        route += [
            r.dep_delay_min
            for r in incoming
            if (r.dep_iata, r.arr_iata) == (row.dep_iata, row.arr_iata)
            and (r.flight_date, r.event_id) <= (row.flight_date, row.event_id)
        ]
        known = [d for d in route[-7:] if d is not None]
        if row.event_id in got:
            assert got[row.event_id] == (sum(known) / len(known) if known else None)
    assert len(got) == len({(r.flight_iata_full, r.flight_date) for r in incoming})


@pytest.mark.parametrize("max_group_rows", [50, 1])
@pytest.mark.parametrize("kind", ["digits", "letters", "timestamp", "nulls", "far off"])
def test_any_key_gives_the_same_rows_at_any_limit(spark, kind, max_group_rows):
    ids = F.col("event_id")
    keys = {
        "digits": ids.cast("string"),
        "letters": F.concat(F.lit("AAL"), ids.cast("string")),
        "timestamp": F.expr("timestampadd(SECOND, cast(event_id * 97 as int), timestamp_ntz'2024-01-01 00:00:00')"),
        "nulls": F.when(ids != 5, ids.cast("string")),
        "far off": F.when(ids == 7, F.lit(10**12)).otherwise(ids),
    }
    df = spark.createDataFrame(make_flights(9, n=150, hot_share=0.9), SCHEMA).withColumn("k", keys[kind])
    whole = results(rolling_route_delay(df, ["k"]))
    assert results(rolling_route_delay(df, ["k"], max_group_rows=max_group_rows)) == whole


def test_pieces_stay_small_whatever_the_keys_look_like(spark):
    """One far-off key and many exact copies."""
    rows = make_flights(10, n=300, hot_share=1.0)
    df = spark.createDataFrame(rows + [rows[3]] * 300, SCHEMA)
    df = df.withColumn("k", F.when(F.col("event_id") == 7, F.lit(10**12)).otherwise(F.col("event_id")))
    rolling_route_delay(df, ["k"], max_group_rows=50).collect()
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "flightloom"
    newest = max(root.glob("pieces-*"), key=lambda p: p.stat().st_mtime)
    sizes = [r["count"] for r in spark.read.parquet(str(newest)).groupBy("_group", "_piece").count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 600


def test_incremental_window_orders_by_text(spark, tmp_path):
    df = spark.createDataFrame(make_flights(11, n=120), SCHEMA).withColumn("k", F.concat(F.lit("AAL"), F.col("event_id").cast("string")))
    split = F.lit("2024-01-03").cast("date")
    fact_flights(df.where(F.col("flight_date") < split), "2024-02-01", ["k"]).write.partitionBy("flight_date").parquet(str(tmp_path / "f"))
    batch = df.where(F.col("flight_date") >= split)
    pairs = lambda frame: sorted((r.k, r.avg_delay_7d) for r in incremental_window(frame, batch, ["k"]).collect())
    assert pairs(str(tmp_path / "f")) == pairs(spark.read.parquet(str(tmp_path / "f"))) != []


def test_small_pieces_need_no_more_tasks(spark):
    """A piece used to be a task and a file, and so a result sent to the driver."""
    df = spark.createDataFrame(make_flights(11, n=2000, hot_share=1.0), SCHEMA)
    got = results(rolling_route_delay(df, ["event_id"], max_group_rows=5))
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "flightloom"
    newest = max(root.glob("pieces-*"), key=lambda p: p.stat().st_mtime)
    sizes = [r["count"] for r in spark.read.parquet(str(newest)).groupBy("_group", "_piece").count().collect()]
    assert max(sizes) <= 5 and len(sizes) >= 400 and len(list(newest.glob("*.parquet"))) <= 8
    assert got == results(rolling_route_delay(df, ["event_id"]))
