from __future__ import annotations

import pytest
from helpers import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entitylake.operators import numbering, paging
from entitylake.schemas import NEXT_LINK, VALUE


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(2500).select("id", (F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("s"))


def test_pages_are_full_but_the_last(table):
    pages = paging.paginate(table, "id", 1000).groupBy("page_number").agg(
        F.count("*").alias("n"), F.min("id"), F.max("id")
    )
    assert rows(pages) == [(1, 1000, 0, 999), (2, 1000, 1000, 1999), (3, 500, 2000, 2499)]


@pytest.mark.parametrize("per_block", [200, 10_000])
def test_envelopes(table, per_block):
    found = paging.all_pages(table, "things", "k desc, id", 100, rows_per_block=per_block).orderBy("page_number")
    pages = found.collect()
    assert [len(page[VALUE]) for page in pages] == [100] * 25
    assert [page[NEXT_LINK] for page in pages] == [f"things?page={i}" for i in range(2, 26)] + [None]
    flat = [record for page in pages for record in page[VALUE]]
    assert [(r["k"], r["id"]) for r in flat] == sorted(((i % 7, i) for i in range(2500)), key=lambda p: (-p[0], p[1]))


def test_records_are_shuffled_once(table):
    plan = plan_of(paging.all_pages(table, "things", "id", 100, rows_per_block=500))
    assert plan.count("Exchange") == 1
    assert "SinglePartition" not in plan


def test_pages_of_very_many_blocks(table, monkeypatch):
    """Blocks of two pages each, many of them to a task: the same pages, and the records are shuffled once."""
    monkeypatch.setattr(numbering, "GROUPS", 5)
    expected = paging.all_pages(table, "things", "k desc, id", 2)
    found = paging.all_pages(table, "things", "k desc, id", 2, rows_per_block=4)
    plan = plan_of(found)
    assert plan.count("Exchange") == 1 and "SinglePartition" not in plan
    assert found.rdd.getNumPartitions() <= 5
    assert found.columns == expected.columns and rows(found) == rows(expected)


def test_records_are_packed_before_they_are_collected(table):
    """As the lake of ``saved_page_behind`` is written; the aggregate would hold an object for every value of its pages."""
    plan = plan_of(paging.all_pages(table, "things", "id", 100, rows_per_block=500))
    assert "collect_list(item#" in plan and "collect_list(struct(" not in plan


def test_numbers_of_very_many_blocks(table, monkeypatch):
    monkeypatch.setattr(numbering, "GROUPS", 5)
    numbered = paging.paginate(table, "k desc, id", 2, rows_per_block=4)
    assert numbered.columns == [*table.columns, "position", "page_number"]
    assert numbered.rdd.getNumPartitions() <= 5
    assert rows(numbered) == rows(paging.paginate(table, "k desc, id", 2))


def test_unpage_gives_the_records_back(table):
    pages = paging.all_pages(table, "things", "id", 300, rows_per_block=600)
    assert rows(paging.records_of(pages)) == rows(table)
    first = paging.unpage(pages).filter("page_number = 2 and position = 0").select("entity", "id").first()
    assert tuple(first) == ("things", 300)


def test_exact_multiple_has_no_empty_page(table):
    pages = paging.all_pages(table.filter("id < 2000"), "things", "id", 1000)
    assert pages.count() == 2


def test_empty_entity_is_one_empty_page(table):
    pages = paging.all_pages(table.filter("id < 0"), "things", "id").collect()
    assert [(p["page_number"], p[VALUE], p[NEXT_LINK]) for p in pages] == [(1, [], None)]
    assert paging.unpage(paging.all_pages(table.filter("id < 0"), "things", "id")).count() == 0


def test_links(table):
    links = paging.page_links(table, "things", 1000)
    assert rows(links) == [(1, 1000, "things?page=2"), (2, 1000, "things?page=3"), (3, 500, None)]
    assert rows(paging.page_links(table.filter("id < 0"), "things")) == [(1, 0, None)]


def walk(df, order, size):
    seen, last = [], None
    while True:
        page = paging.next_page(df, order, last, size)
        got = page.collect()
        seen += got
        if len(got) < size:
            return seen
        last = paging.last_key(page, order)


@pytest.mark.parametrize("order", ["id", "k, id desc", "v desc, id", "v, id", "t desc", "z", "z desc"])
def test_following_pages_visits_every_row_in_order(spark, order):
    df = spark.range(40).select(
        "id",
        (F.col("id") % 3).alias("k"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 5).alias("v"),
        F.when(F.col("id") != 9, F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id)")).alias("t"),
        # an hour that the clocks show twice
        F.expr("timestamp'2024-10-27 00:30:00Z' + make_dt_interval(0, 0, 3 * id)").alias("z"),
    )
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        expected = paging.first_page(df, order, 100).collect()
        assert walk(df, order, 7) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_next_page_reaches_the_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    page = paging.next_page(spark.read.parquet(str(tmp_path / "t")), "id", {"id": 50}, 10)
    plan = plan_of(page)
    assert "GreaterThan(id,50)" in plan and "TakeOrderedAndProject" in plan


def test_first_page_of_nothing(table):
    empty = table.filter("id < 0")
    assert paging.last_key(paging.first_page(empty, "id"), "id") is None


def test_estimates(spark):
    n = F.col("n")
    df = spark.createDataFrame([(2500,), (1000,), (0,)], "n bigint").select(
        paging.estimated_pages(n), paging.estimated_pages(n, mode="floor_plus_one"),
        paging.estimated_pages(n, paging.UNSET_PAGE_SIZE, "ratio"),
    )
    assert [tuple(row) for row in df.collect()] == [(3, 3, 0.5), (1, 2, 0.2), (0, 1, 0.0)]
    with pytest.raises(ValueError):
        paging.estimated_pages(n, mode="round")


def test_page_stats(spark, table):
    pages = paging.all_pages(table, "things", "id", 1000)
    repeated = pages.unionByName(pages.filter("page_number = 1"))
    counts = spark.createDataFrame([("things", 2600), ("none", 0)], "entity string, record_count bigint")
    stats = paging.page_stats(repeated, counts, 1000)
    found = {r["entity"]: r.asDict() for r in stats.collect()}
    assert found["things"]["pages"] == 3 and found["things"]["records"] == 2500
    assert found["things"]["expected_pages"] == 3 and found["things"]["expected_records"] == 2600
    assert found["none"]["pages"] == 0 and found["none"]["records"] == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    ids=st.lists(st.integers(-50, 50), unique=True, max_size=30),
    size=st.integers(1, 7),
    per_block=st.integers(1, 12),
)
def test_paging_properties(spark, ids, size, per_block):
    df = spark.createDataFrame([(i,) for i in ids], "id int")
    pages = paging.all_pages(df, "e", "id", size, rows_per_block=per_block).orderBy("page_number").collect()
    assert [r["id"] for page in pages for r in page[VALUE]] == sorted(ids)
    assert all(len(page[VALUE]) == size for page in pages[:-1])
    assert [page["page_number"] for page in pages] == list(range(1, len(pages) + 1))
