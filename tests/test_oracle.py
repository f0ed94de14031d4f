"""Every registered query against its SQL, on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from flightloom.verification.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = [tuple(row[c] for c in columns) for row in frame.collect()]

    result = duck.execute(entry.oracle_sql()[name])
    described = {d[0]: str(d[1]).replace(" ", "") for d in result.description}
    order = [list(described).index(c) for c in columns]
    want = [tuple(row[i] for i in order) for row in result.fetchall()]

    assert sorted(described) == columns
    assert in_order(got) == in_order(want)
    if "ORDER BY" in entry.oracle_sql()[name].rpartition(")\n")[2] and name.startswith("k_"):
        assert got == want  # the answer's own order
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    assert {c: TYPES.get(kinds[c], kinds[c].upper()) for c in columns} == {c: described[c] for c in columns}


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[:2] == ["insert_date_ci", "flight_key"]
    assert frame.count() > 0
