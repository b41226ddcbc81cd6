"""Every registered query against its SQL on whole tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from retail_lake.checks import ORACLES, registered

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents".split()

#: DuckDB's names of the types Spark returns.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql(spark, duck, name):
    result = registered()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    described = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema} == described
    ours = sorted(
        (tuple(_plain(v) for v in r) for r in result.select(*columns).collect()), key=repr
    )
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = duck.execute(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()
    theirs = sorted((tuple(_plain(v) for v in r) for r in theirs), key=repr)
    assert ours == theirs
    assert ours
