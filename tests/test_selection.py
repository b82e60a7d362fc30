from __future__ import annotations

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from entitylake import session
from entitylake.functions.ordering import sort_columns, sort_keys
from entitylake.operators import selection
from entitylake.operators.query import query


@pytest.fixture(scope="module")
def table(spark):
    """Ties, nulls, a key that a third of all rows have."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, 5).otherwise((n * 7919) % 40).cast("int").alias("kind"),
        F.when(n % 11 > 0, F.concat(F.lit("t"), ((n * 31) % 500).cast("string"))).alias("name"),
        F.when(n % 7 > 0, (n.cast("decimal(12,2)") / 8).cast("decimal(12,2)")).alias("price"),
        F.timestamp_micros(n * 1_000_001 % 77_777_777).cast("timestamp_ntz").alias("at"),
        "id",
    )


ORDERS = ["id", "id desc", "kind", "kind desc, name", "name desc, kind", "price desc", "at, id desc", "name, price"]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("bounds, gap_rows", [(8, 50), (1024, 200_000)])
def test_first_rows_and_the_last_key(table, monkeypatch, order, bounds, gap_rows):
    monkeypatch.setattr(selection, "BOUNDS", bounds)
    keys = sort_keys(order)
    names = [key.name for key in keys]
    ordered = [tuple(r) for r in table.orderBy(*sort_columns(keys)).select(*names).collect()]
    for count in (1, 700, 1000, 2999, 3000):
        _, before, same = selection.key_at(table, keys, count, gap_rows)
        last = ordered[count - 1]
        assert before == ordered.index(last) and same == ordered.count(last)
        found = selection.first_rows(table, keys, count, gap_rows)
        got = found.orderBy(*sort_columns(keys)).select(*names).collect()
        assert [tuple(r) for r in got] == ordered[:count] and found.distinct().count() == count
    assert selection.key_at(table, keys, 3001, gap_rows) is None
    assert selection.first_rows(table, keys, 3001, gap_rows).count() == 3000


def test_nothing_is_stored_where_keys_are_unique(spark, table):
    before = len(session._made)
    found = query(table, orderby="price desc, id", top=500, one_task=100)
    assert len(session._made) == before
    assert "Window" not in plan_of(found)
    expected = query(table, orderby="price desc, id", top=500)
    assert found.collect() == expected.collect()


def test_ties_and_empty_tables(spark, table):
    same = spark.range(900).select(F.lit(1).alias("k"), "id")
    assert query(same, orderby="k", top=450, one_task=100).distinct().count() == 450
    assert query(table.limit(0), orderby="id", top=450, one_task=100).count() == 0
    nulls = spark.range(300).select(F.lit(None).cast("int").alias("k"), "id")
    assert query(nulls, orderby="k desc", top=150, one_task=100).distinct().count() == 150
    nested = spark.range(300).select(F.struct("id").alias("k"))
    assert [r.k.id for r in query(nested, orderby="k desc", top=150, one_task=100).collect()][:2] == [299, 298]
