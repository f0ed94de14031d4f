"""Frames carried by stored tails, and the bucketed fact."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from flightloom.operators import carried_window, create_fact_table, incremental_window, keep_tails, route_tails, stage_upsert, table_path, upsert_fact, upsert_table
from flightloom.operators.bucketed import stored_rows
from flightloom.operators.upsert import leased, survivors
from flightloom.plans.marts import fact_flights
from flightloom.sources import read_fact
from tests.test_silver import SCHEMA, make_flights


def results(frame):
    return sorted(str(r.asDict()) for r in frame.select(*sorted(frame.columns)).collect())


def plan(frame):
    return frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("spare", [0, 2, 6])
@pytest.mark.parametrize("max_group_rows", [5_000_000, 10])
def test_tails_carry_the_same_frames(spark, tmp_path, spare, max_group_rows):
    """A batch that replaces some flights, most of a route's last ones, and none; late flights among older ones."""
    df = spark.createDataFrame(make_flights(21, n=160, hot_share=0.7), SCHEMA)
    fact, tails = str(tmp_path / "fact"), str(tmp_path / "tails")
    stored = fact_flights(df.where("event_id % 4 != 0"), "2024-02-01", ["event_id"])
    upsert_fact(spark, fact, stored)
    keep_tails(spark, fact, tails, spare=spare)
    fresh = df.where("event_id % 4 = 0")
    for batch in (fresh, df.where("event_id % 4 = 0 OR event_id % 3 = 0"), df.where("flight_date >= '2024-01-04'"), fresh.limit(0)):
        want = results(incremental_window(fact, batch, ["event_id"], max_group_rows=max_group_rows))
        assert results(carried_window(tails, fact, batch, ["event_id"], spare=spare, max_group_rows=max_group_rows)) == want


def test_the_fact_is_not_read_while_tails_suffice(spark, tmp_path):
    df = spark.createDataFrame(make_flights(22, n=200), SCHEMA)
    fact, tails = str(tmp_path / "the-fact"), str(tmp_path / "tails")
    upsert_fact(spark, fact, fact_flights(df.where("flight_date < '2024-01-03'"), "2024-02-01", ["event_id"]))
    keep_tails(spark, fact, tails)
    framed = carried_window(tails, fact, df.where("flight_date >= '2024-01-03'"), ["event_id"])
    read = framed.inputFiles()
    assert read and all("/tails/" in file for file in read)
    assert "WindowGroupLimit" in plan(route_tails(read_fact(spark, fact)))


def test_tails_follow_the_fact_by_touched_dates(spark, tmp_path):
    df = spark.createDataFrame(make_flights(23, n=120), SCHEMA)
    fact, tails, whole = (str(tmp_path / n) for n in ("fact", "tails", "whole"))
    for part in ("event_id % 3 = 0", "event_id % 3 = 1"):
        _, touched = upsert_fact(spark, fact, fact_flights(df.where(part), "2024-02-01", ["event_id"]))
        keep_tails(spark, fact, tails, touched)
    keep_tails(spark, fact, whole)
    assert results(read_fact(spark, tails)) == results(read_fact(spark, whole))


def test_bucketed_upserts_equal_plain_ones(spark, tmp_path):
    df = spark.createDataFrame(make_flights(24, n=200), SCHEMA)
    table, path, plain = f"fact_{uuid.uuid4().hex}", str(tmp_path / "bucketed"), str(tmp_path / "plain")
    batches = [fact_flights(df.where(f"event_id % 3 <= {n}"), f"2024-02-0{n + 1}", ["event_id"]) for n in (0, 2, 1)]
    create_fact_table(spark, table, path, batches[0], buckets=4)
    for batch in batches:
        assert upsert_table(spark, table, batch)[0] == upsert_fact(spark, plain, batch)[0]
        spark.catalog.refreshTable(table)
        assert results(spark.table(table)) == results(read_fact(spark, plain))
    assert table_path(spark, table).endswith("/bucketed")
    files = [len(list(d.glob("*.parquet"))) for d in (tmp_path / "bucketed").glob("flight_date=*")]
    assert max(files) <= 4
    # A marked upsert is finished by the next one, with its buckets.
    with leased(spark, path, "w") as lease:
        stage_upsert(spark, path, batches[1], lease, lambda dates: stored_rows(spark, table, dates))
    upsert_table(spark, table, batches[0])
    for batch in (batches[1], batches[0]):
        upsert_fact(spark, plain, batch)
    assert results(spark.table(table)) == results(read_fact(spark, plain))
    spark.sql(f"DROP TABLE {table}")


def test_stored_rows_of_a_bucketed_fact_do_not_move(spark, tmp_path):
    df = spark.createDataFrame(make_flights(25, n=200), SCHEMA)
    table = f"fact_{uuid.uuid4().hex}"
    batch = fact_flights(df, "2024-02-01", ["event_id"])
    create_fact_table(spark, table, str(tmp_path / "bucketed"), batch, buckets=4)
    upsert_table(spark, table, batch)
    batch.write.parquet(str(tmp_path / "incoming"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dates = [r[0] for r in batch.select("flight_date").distinct().collect()][:2]
        joined = survivors(stored_rows(spark, table, dates), spark.read.parquet(str(tmp_path / "incoming")))
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in text and len(re.findall(r"Exchange hashpartitioning\(flight_key", text)) == 1
    stored_side = next(part for part in re.split(r"\+- Sort", text) if table in part or "Bucketed: true" in part)
    assert "Exchange" not in stored_side.split("FileScan")[0] and "Bucketed: true" in text
    assert re.search(r"PartitionFilters: \[.*flight_date", text)
    assert joined.select(F.count("*")).first()[0] == 0
    spark.sql(f"DROP TABLE {table}")
