"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from check import SAME_TYPES, bag
from entitylake.suite.oracles import ORACLES
from entitylake.suite.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    found = duck.execute(ORACLES[name])
    columns = [item[0] for item in found.description]
    types = {item[0]: SAME_TYPES.get(str(item[1]), str(item[1])) for item in found.description}
    assert types == dict(df.dtypes)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(columns, found.fetchall())
