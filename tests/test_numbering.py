from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import plan_of
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entitylake.functions.ordering import SortKey, sort_columns, sort_keys
from entitylake.operators import numbering


@pytest.fixture(scope="module")
def table(spark):
    n = F.col("id")
    return (
        spark.range(3000)
        .select(
            n,
            F.when(n < 1000, "hot").otherwise(F.concat(F.lit("é"), F.pmod(F.xxhash64(n), F.lit(40)))).alias("text"),
            F.when(n == 7, float("nan")).when(n % 5 > 0, F.pmod(F.xxhash64(n), F.lit(97)) / 7).alias("num"),
            F.expr("timestamp_ntz'2024-03-31 00:00:00' + make_dt_interval(0, 0, id, id / 1000)").alias("local"),
            F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, -id, id / 1000)").alias("instant"),
            F.expr("date_add(date'2024-01-01', cast(id % 60 as int))").alias("day"),
            (F.pmod(F.xxhash64(n), F.lit(500)) / 100).cast("decimal(10,2)").alias("price"),
            (n % 2 == 0).alias("flag"),
            F.unhex(F.md5(n.cast("string"))).alias("digest"),
        )
        .repartition(4)
    )


@pytest.mark.parametrize(
    "order",
    [
        "id",
        "id desc",
        "text, id",
        "text desc, num, id desc",
        "num, id",
        "num desc, id",
        "local",
        "instant desc",
        "day, price desc, id",
        "flag, id",
        "digest",
    ],
)
def test_blocks_number_like_one_window(table, order):
    blocks = numbering.cut_blocks(table, order, align=10, rows_per_block=250)
    assert blocks.count == 12 and len(blocks.ends) == 11
    numbered = numbering.number_in_blocks(table, blocks, "n")
    sizes = [row["count"] for row in numbered.groupBy(numbering.BLOCK).count().collect()]
    assert sizes == [250] * 12
    window = W.orderBy(*sort_columns(sort_keys(order)))
    expected = table.withColumn("n", F.row_number().over(window).cast("bigint"))
    got = {row["id"]: row["n"] for row in numbered.select("id", "n").collect()}
    assert got == {row["id"]: row["n"] for row in expected.select("id", "n").collect()}


@pytest.mark.parametrize("order", ["id", "hot, id desc"])
def test_many_blocks_of_a_stored_table(spark, tmp_path, order):
    path = str(tmp_path / "t")
    spark.range(4000, numPartitions=4).withColumn("hot", F.expr("if(id % 3 = 0, 7, id)")).write.parquet(path)
    stored = spark.read.parquet(path)
    blocks = numbering.cut_blocks(stored, order, rows_per_block=50)
    assert blocks.count == 80
    numbered = numbering.number_in_blocks(stored, blocks, "n").select("id", "n").collect()
    rows = sorted(((7 if i % 3 == 0 else i, -i) if "hot" in order else (i, i)) + (i,) for i in range(4000))
    assert {r["id"]: r["n"] for r in numbered} == {row[-1]: n for n, row in enumerate(rows, 1)}


def test_blocks_are_multiples_of_the_page_size(table):
    blocks = numbering.cut_blocks(table, "id", align=70, rows_per_block=250)
    assert blocks.size == 280


def test_no_task_gets_all_rows(table):
    blocks = numbering.cut_blocks(table, "text, id", rows_per_block=500)
    plan = plan_of(numbering.number_in_blocks(table, blocks, "n"))
    assert "SinglePartition" not in plan
    assert plan.count("direct_shuffle_partition_id(__block") == 1 and "hashpartitioning" not in plan


def test_small_and_empty_tables(spark, table):
    assert numbering.cut_blocks(table, "id").ends == []
    empty = table.filter("id < 0")
    assert numbering.number_rows(empty, "id").count() == 0


def test_repeated_keys_fail_early(table):
    with pytest.raises(ValueError, match="not unique"):
        numbering.cut_blocks(table, "flag", rows_per_block=300)


def test_repeated_keys_fail_in_the_job(spark):
    twice = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int")
    with pytest.raises(Exception, match="not unique: id"):
        numbering.number_rows(twice, "id").collect()


def test_wrong_total_is_noticed(table):
    with pytest.raises(ValueError, match="total"):
        numbering.cut_blocks(table, "id", rows_per_block=300, total=2999)


def test_an_order_is_required(table):
    with pytest.raises(ValueError, match="order_by"):
        numbering.number_rows(table, "")


def test_unordered_types_are_refused(spark):
    nested = spark.createDataFrame([([1], 1), ([2], 2)], "a array<int>, b int")
    with pytest.raises(TypeError, match="'a'"):
        numbering.cut_blocks(nested, "a", rows_per_block=1)


def test_sort_keys():
    assert sort_keys("a desc, b") == [SortKey("a", True), SortKey("b")]
    assert sort_keys(["a asc", SortKey("b c")]) == [SortKey("a"), SortKey("b c")]
    assert sort_keys(None) == []
    with pytest.raises(ValueError):
        sort_keys("a down")


def test_literal_types(spark):
    values = [(date(1969, 12, 31), datetime(1969, 12, 31, 23, 59, 59, 5), Decimal("-0.10"), i) for i in range(2)]
    df = spark.createDataFrame(values, "d date, t timestamp_ntz, p decimal(5,2), i int")
    blocks = numbering.cut_blocks(df, "d, t desc, p, i desc", rows_per_block=1)
    numbered = numbering.number_in_blocks(df, blocks, "n")
    assert sorted(numbered.select("i", "n").collect()) == [(0, 2), (1, 1)]


@pytest.mark.parametrize("order", ["id", "id desc", "day", "instant desc", "id2 desc"])
def test_sketches_give_the_bounds_of_one_whole_number(table, order, monkeypatch):
    """Nothing is sampled, and the blocks are the same as those of a known total, which samples."""
    rows = table.filter("id < 60" if order == "day" else "true").withColumn("id2", F.expr("nullif(id, 5)"))
    size = 7 if order == "day" else 250
    sampled = numbering.cut_blocks(rows, order, rows_per_block=size, total=rows.count())
    monkeypatch.setattr(numbering, "_sample_bounds", lambda *_: pytest.fail("sampled"))
    assert numbering.cut_blocks(rows, order, rows_per_block=size) == sampled
    assert sampled.count > 5


def test_sketches_without_values(table):
    nulls = table.limit(1).select(F.lit(None).cast("long").alias("id"))
    assert numbering.cut_blocks(nulls, "id").total == 1
    assert numbering.cut_blocks(nulls.limit(0), "id").total == 0
    two = nulls.union(nulls.select(F.lit(3).cast("long")))
    assert numbering.cut_blocks(two, "id", rows_per_block=1).ends == [(None,)]


def test_many_blocks_are_sampled(table):
    blocks = numbering.cut_blocks(table, "id", rows_per_block=10)
    assert blocks.count == 300 > numbering.SKETCHED_BLOCKS
    assert blocks.ends == [(10 * i - 1,) for i in range(1, 300)]


@pytest.mark.parametrize("order", ["id", "text desc, id"])
@pytest.mark.parametrize("groups", [1, 5])
def test_very_many_blocks_go_to_tasks_in_groups(table, order, groups, monkeypatch):
    """No bound, end or task for each of them; numbers, blocks and last keys are those of single blocks."""
    monkeypatch.setattr(numbering, "GROUPS", groups)
    blocks = numbering.cut_blocks(table, order, rows_per_block=2)
    assert blocks.count == 1500 > numbering.SINGLE_BLOCKS
    assert len(blocks.ends) + 1 == blocks.groups == groups
    numbered = numbering.number_in_blocks(table, blocks, "n")
    assert numbered.rdd.getNumPartitions() <= max(2, groups)
    window = W.orderBy(*sort_columns(sort_keys(order)))
    expected = table.withColumn("n", F.row_number().over(window).cast("bigint")).select("id", "n").collect()
    got = numbered.select("id", "n", numbering.BLOCK).collect()
    assert sorted((r["id"], r["n"]) for r in got) == sorted(map(tuple, expected))
    assert all(r[numbering.BLOCK] == (r["n"] - 1) // 2 for r in got)
    last = {(r["n"] - 1) // 2: r["id"] for r in expected if r["n"] % 2 == 0 and r["n"] < 3000}
    ends = numbering.keys_by_block(table.sparkSession, table, blocks)
    assert {r["block"]: r["k0" if order == "id" else "k1"] for r in ends.collect()} == last


def test_groups_are_no_larger_than_a_task_needs(table, monkeypatch):
    monkeypatch.setattr(numbering, "GROUPS", 2)
    monkeypatch.setattr(numbering, "_rows_per_block", lambda *_: 100)
    blocks = numbering.cut_blocks(table, "id", rows_per_block=2)
    assert (blocks.grouped, blocks.groups, len(blocks.ends)) == (50, 30, 29)


def test_parts_are_whole_groups(table, monkeypatch):
    monkeypatch.setattr(numbering, "GROUPS", 5)
    blocks = numbering.cut_blocks(table, "id", rows_per_block=2)
    assert blocks.grouped == 300
    assert blocks.parts(800) == [(0, 600), (600, 1200), (1200, 1500)]
    assert blocks.parts(1)[:2] == [(0, 300), (300, 600)]
    part = numbering.number_in_blocks(numbering.rows_of_blocks(table, blocks, 600, 1200), blocks.part(600, 1200), "n")
    assert {r["id"]: r["n"] for r in part.select("id", "n").collect()} == {i: i - 1199 for i in range(1200, 2400)}
    with pytest.raises(ValueError, match="whole groups"):
        blocks.part(600, 1000)
    with pytest.raises(ValueError, match="whole groups"):
        numbering.rows_of_blocks(table, blocks, 1, 600)


def test_repeated_keys_in_a_group_fail_in_the_job(table):
    twice = table.select("id").union(table.select("id").filter("id = 2000"))
    with pytest.raises(Exception, match="not unique: id"):
        numbering.number_rows(twice, "id", rows_per_block=2).collect()


def test_the_plan_holds_a_bound_once_or_twice(table):
    """Not once for every step of the search and every comparison in it."""
    keys = sort_keys("text, id desc")
    bounds = [(f"bound-{i:04}", 7_000_000 + i) for i in range(1000)]

    def times(**options):
        found = numbering.with_position(table, keys, numbering.key_columns(table, keys), bounds, "gap", **options)
        assert found.columns == [*table.columns, "gap"]
        plan = plan_of(found.groupBy("gap").count())
        counts = [(plan.count(text), plan.count(str(number))) for text, number in bounds]
        # the first step compares with the same bound for all rows, a constant
        return set(counts[:511] + counts[512:])

    assert times() == {(1, 1)}
    assert times(by_leading=True) == {(2, 1)}


@pytest.mark.parametrize("n_bounds", [0, 1, 2, 7, 8, 63])
@pytest.mark.parametrize("order", ["num desc, id desc", "id desc, num"])
def test_positions_among_any_number_of_bounds(table, order, n_bounds):
    keys = sort_keys(order)
    some = table.filter("id < 400").select("id", "num")
    ordered = [tuple(row) for row in some.orderBy(*sort_columns(keys)).select(*[key.name for key in keys]).collect()]
    places = [(i + 1) * len(ordered) // (n_bounds + 1) for i in range(n_bounds)]
    columns, bounds = numbering.key_columns(some, keys), [ordered[i] for i in places]
    found = numbering.with_position(some, keys, columns, bounds, "gap", by_leading=n_bounds % 2 > 0)
    got = {row["id"]: row["gap"] for row in found.collect()}
    at = [key.name for key in keys].index("id")
    assert got == {row[at]: sum(place < rank for place in places) for rank, row in enumerate(ordered)}


def test_columns_that_tell_bounds_apart():
    nan = float("nan")

    def needed(*bounds):
        return numbering._telling_apart(bounds, 3)

    assert needed() == needed((1.0, 1, "x")) == 1
    assert needed((1.0, 1, "x"), (2.0, 1, "x"), (3.0, 1, "x")) == 1
    assert needed((None, 1, "x"), (None, 2, "x"), (0.5, 1, "x")) == 2
    assert needed((-0.0, 1, "x"), (0.0, 2, "x")) == needed((nan, 1, "x"), (float("nan"), 2, "x")) == 2
    assert needed((1.0, 1, "x"), (1.0, 1, "y")) == needed((1.0, 1, "x"), (1.0, 1, "x")) == 3


def test_positions_where_a_collation_makes_bounds_alike(spark):
    df = spark.createDataFrame([("a", 1), ("A", 2), ("a", 3), ("A", 4), ("b", 5)], "d string collate UTF8_LCASE, n long")
    keys = sort_keys("d, n")
    found = numbering.with_position(df, keys, numbering.key_columns(df, keys), [("a", 1), ("A", 2), ("a", 3)], "gap")
    assert {row["n"]: row["gap"] for row in found.collect()} == {1: 0, 2: 1, 3: 2, 4: 3, 5: 3}


def test_numbered_rows_have_few_copies_of_the_ends_in_their_plan(table):
    """As the lake of ``saved_page_behind`` is written: wide rows, ends of several columns."""
    ends = [(7_000_000 + i, f"end-{i:03}") for i in range(255)]
    blocks = numbering.Blocks(sort_keys("id, text desc"), 256, 1, ends)
    plan = plan_of(numbering.number_in_blocks(table, blocks, "n"))
    assert max(plan.count(text) for _, text in ends) == 1
    assert sum(plan.count(str(number)) for number, _ in ends) < 2.1 * len(ends)
