from __future__ import annotations

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from entitylake.operators.query import Navigation, counted, equals, get_by_key, query
from entitylake.operators.ranking import ranked


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame(
        [(1, "a", 10.0), (2, "b", None), (3, "c", 30.0), (4, None, 20.0)], "id int, name string, v double"
    )


@pytest.fixture(scope="module")
def contacts(spark):
    made = [(i, 1, f"n{i}") for i in range(5)] + [(9, 2, "x"), (10, None, "orphan")]
    return spark.createDataFrame(made, "cid int, account int, label string")


def test_falsy_options_do_not_apply(accounts):
    assert query(accounts, select="", filter=" ", expand=[], top=0, orderby=None).count() == 4


def test_options_together(accounts):
    found = query(accounts, select="id", filter="v > 5", orderby="v desc", top=2, count=True)
    assert found.columns == ["id", "@odata.count"]
    assert [tuple(r) for r in found.collect()] == [(3, 3), (4, 3)]


def test_null_sorts_lowest(accounts):
    assert [r["id"] for r in query(accounts, orderby="v").collect()] == [2, 1, 4, 3]
    assert [r["id"] for r in query(accounts, orderby="v desc").collect()] == [3, 4, 1, 2]


def test_select_keeps_the_given_order(accounts):
    assert query(accounts, select=["v", "id"]).columns == ["v", "id"]


def test_eq_and_null(accounts):
    assert [r["id"] for r in query(accounts, filter=equals("name", None)).collect()] == [4]
    assert [r["id"] for r in query(accounts, filter=equals("name", "a")).collect()] == [1]


def test_count_alone(accounts):
    assert counted(accounts, "v > 10").first()[0] == 2


def test_key_lookup(accounts):
    assert get_by_key(accounts, {"id": 3}, select="name").collect()[0]["name"] == "c"
    assert get_by_key(accounts, {"name": None, "id": 4}).count() == 1
    with pytest.raises(Exception, match="no record"):
        get_by_key(accounts, {"id": 8}).collect()
    with pytest.raises(Exception, match="more than one"):
        get_by_key(accounts.union(accounts), {"id": 1}, select="name").collect()


def test_key_lookup_with_related_rows(accounts, contacts):
    found = get_by_key(contacts, {"cid": 9}, select="label", expand=Navigation("owner", accounts, "account", "id"))
    assert found.columns == ["label", "owner"] and found.first()["owner"]["name"] == "b"


def test_key_lookup_reads_its_columns_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("a"), F.lit("y").alias("b")).write.parquet(path)
    plan = plan_of(get_by_key(spark.read.parquet(path), {"id": 3}, select="a"))
    assert "ReadSchema: struct<id:bigint,a:string>" in plan


def test_to_one_needs_a_unique_key(spark, accounts, contacts):
    twice = accounts.union(accounts.filter("id = 1"))
    with pytest.raises(Exception, match="not unique: 1"):
        query(contacts, expand=Navigation("owner", twice, "account", "id")).collect()
    nulls = accounts.select(F.lit(None).cast("int").alias("id"), "name")
    assert query(contacts, expand=Navigation("owner", nulls, "account", "id")).count() == 7


def test_to_one(accounts, contacts):
    nav = Navigation("owner", accounts, "account", "id", select="name")
    found = query(contacts, select="cid", expand=nav, orderby="cid").collect()
    assert len(found) == 7
    assert found[0]["owner"]["name"] == "a"
    assert found[-1]["owner"] is None


def _many(contacts, **options):
    return Navigation(
        "contacts", contacts, "id", "account", many=True, select="cid", order_by=["cid"], key=["cid"], **options
    )


def test_to_many(accounts, contacts):
    found = query(accounts, select="id", expand=_many(contacts), orderby="id").collect()
    assert [[c["cid"] for c in r["contacts"]] for r in found] == [[0, 1, 2, 3, 4], [9], [], []]
    assert found[0].__fields__ == ["id", "contacts"]


def test_to_many_counts(accounts, contacts):
    found = query(accounts, select="id", expand=_many(contacts, count_only=True))
    assert rows(found) == [(1, 5), (2, 1), (3, 0), (4, 0)]


def test_top_restricts_the_related_rows(accounts, contacts):
    found = query(accounts, expand=_many(contacts), orderby="v desc", top=3).collect()
    assert [(r["id"], len(r["contacts"])) for r in found] == [(3, 0), (4, 0), (1, 5)]


@pytest.mark.parametrize("max_items", [1, 7, 200, 5000])
def test_item_pages(spark, max_items):
    parents = spark.range(6).withColumnRenamed("id", "pid")
    children = spark.range(2000).select(
        F.col("id").alias("cid"),
        F.when(F.col("id") < 900, 0).when(F.col("id") < 1500, 1).otherwise(2 + F.col("id") % 3).alias("parent"),
        (F.col("id") * 7919 % 1009).alias("rank"),
    )
    nav = Navigation(
        "kids", children, "pid", "parent", many=True, select="cid", order_by=["rank", "cid"], max_items=max_items
    )
    found = query(parents, expand=nav)
    assert found.columns == ["pid", "kids", "kids@page"]
    got = {}
    for row in found.orderBy("pid", "`kids@page`").collect():
        pages = got.setdefault(row["pid"], [])
        assert row["kids@page"] == len(pages) + 1 and len(row["kids"]) <= max_items
        pages.append([kid["cid"] for kid in row["kids"]])
    expected = {}
    for row in children.orderBy("rank", "cid").collect():
        expected.setdefault(row["parent"], []).append(row["cid"])
    assert {p: [x for page in pages for x in page] for p, pages in got.items()} == {**expected, 5: []}
    assert all(len(page) == max_items for pages in got.values() for page in pages[:-1])


def test_equal_related_rows_are_split(spark):
    same = spark.range(1000, numPartitions=4).select(F.lit(1).alias("parent"), F.lit("x").alias("text"))
    parents = spark.range(2).withColumnRenamed("id", "pid")
    found = query(parents, expand=Navigation("kids", same, "pid", "parent", many=True, max_items=100)).collect()
    assert sorted((r["pid"], r["kids@page"], len(r["kids"])) for r in found) == [(0, 1, 0)] + [(1, i, 100) for i in range(1, 11)]


def test_top_with_a_large_parent_keeps_one_row(spark):
    kids = spark.range(12_000).select(F.lit(0).alias("parent"), F.col("id").alias("cid"))
    nav = Navigation("kids", kids, "id", "parent", many=True, key=["cid"])
    found = query(spark.range(5), expand=nav, orderby="id", top=1, count=True).collect()
    assert [(r["id"], len(r["kids"]), r["@odata.count"]) for r in found] == [(0, 12_000, 5)]


def test_large_top_is_cut_by_rank(spark):
    df = spark.range(1000, numPartitions=5).select((F.col("id") % 10).alias("v"), "id")
    found = query(df, orderby="v desc", top=450, one_task=100)
    plan = plan_of(found)
    assert "Limit" not in plan and "TakeOrdered" not in plan
    values = [r["v"] for r in found.collect()]
    assert values == [9] * 100 + [8] * 100 + [7] * 100 + [6] * 100 + [5] * 50
    assert query(df, top=450, one_task=100).distinct().count() == 450


def test_ranks_in_groups(spark):
    df = spark.createDataFrame([(i % 3 if i % 7 else None, i * 37 % 11) for i in range(200)], "g int, v int")
    found = ranked(df, "v desc", "rank", group="g").collect()
    by_group = {}
    for row in found:
        by_group.setdefault(row["g"], []).append((row["rank"], row["v"]))
    assert by_group.keys() == {0, 1, 2} and len(found) == df.filter("g is not null").count()
    for ranks in by_group.values():
        ranks.sort()
        assert [r for r, _ in ranks] == list(range(1, len(ranks) + 1))
        assert [v for _, v in ranks] == sorted((v for _, v in ranks), reverse=True)
    assert ranked(df.limit(0), "v", "rank").count() == 0


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("kind"), F.lit(1.0).alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_of(query(df, select="id", filter=equals("kind", "x")))
    assert "PushedFilters: [EqualNullSafe(kind,x)]" in plan or "EqualTo(kind,x)" in plan
    assert "ReadSchema: struct<id:bigint,kind:string>" in plan
    assert "TakeOrderedAndProject" in plan_of(query(df, orderby="v", top=3))


def test_equal_sort_values_are_spread(spark):
    hot = F.col("id").bitwiseAND(F.lit(0))
    df = spark.range(1000, numPartitions=4).withColumn("hot", hot).withColumn("m", F.create_map("id", "hot"))
    found = query(df, select="id,hot", orderby="hot")
    assert "rangepartitioning(hot" in plan_of(found) and "xxhash64(id" in plan_of(found)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = query(df, select="id,hot", orderby="hot")
        sizes = found.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 500
    assert query(df, orderby="id desc").first()["id"] == 999
