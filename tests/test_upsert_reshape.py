from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from entitylake.operators import reshape, upsert


def test_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y"), ("a", 2, "w")], "k string, seq int, v string")
    assert rows(upsert.last_wins(df, ["k"], "seq")) == [("a", 3, "z"), ("b", 2, "y")]
    assert rows(upsert.last_wins(df, ["k"], "seq desc")) == [("a", 1, "x"), ("b", 2, "y")]


def test_last_wins_cuts_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"))
    plan = plan_of(upsert.last_wins(df, ["k"], "seq"))
    assert plan.index("WindowGroupLimit [k") < plan.index("Exchange") < plan.rindex("WindowGroupLimit [k")


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), (None, 9)], "k string, v int")
    new = spark.createDataFrame([("b", 5), ("c", 6)], "k string, v int")
    once = upsert.upsert(base, new, ["k"])
    assert rows(once) == rows(spark.createDataFrame([("a", 1), ("b", 5), ("c", 6), (None, 9)], "k string, v int"))
    assert rows(upsert.upsert(once, new, ["k"])) == rows(once)


def test_skip_done(spark):
    work = spark.createDataFrame([("a",), ("b",)], "k string")
    done = spark.createDataFrame([("b",), ("b",), ("z",)], "k string")
    assert rows(upsert.skip_done(work, done, ["k"])) == [("a",)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_fresh_and_stale_are_everything(spark, kind):
    now = datetime(2024, 1, 2, 12)
    df = spark.sql(
        f"""SELECT * FROM VALUES (1, {kind}'2024-01-02 11:55:00'), (2, {kind}'2024-01-02 11:54:59.999999'),
        (3, {kind}'2024-01-03 00:00:00'), (4, NULL) AS t(id, at)"""
    )
    fresh = upsert.fresh_rows(df, "at", now, timedelta(minutes=5))
    stale = upsert.stale_rows(df, "at", now, timedelta(minutes=5))
    assert sorted(r["id"] for r in fresh.collect()) == [1, 3]
    assert sorted(r["id"] for r in stale.collect()) == [2, 4]


def test_freshness_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp_ntz'2024-01-01' AS at").write.parquet(path)
    fresh = upsert.fresh_rows(spark.read.parquet(path), "at", datetime(2024, 1, 2), timedelta(days=1))
    assert "GreaterThanOrEqual(at,2024-01-01T00:00)" in plan_of(fresh)


def test_flatten(spark):
    df = spark.createDataFrame(
        [(1, (("x",), [1, 2])), (2, None)], "id int, n struct<inner:struct<`a.b`:string>,list:array<int>>"
    )
    flat = reshape.flatten(df)
    assert flat.columns == ["id", "n.inner.a.b", "n.list"]
    assert [tuple(r) for r in flat.orderBy("id").collect()] == [(1, "x", [1, 2]), (2, None, None)]


def test_keep_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, c int, `d@e` int")
    assert reshape.keep_columns(df, ["d@e", "a.b"]).collect() == [(3, 1)]
    with pytest.raises(KeyError, match="zz"):
        reshape.keep_columns(df, ["c", "zz"])


def test_annotations(spark):
    df = reshape.annotated(spark.createDataFrame([(0,)], "statecode int"), {"statecode": F.lit("Active")})
    assert df.columns == ["statecode", "statecode@FormattedValue"]
    assert reshape.annotations(df, True).columns == df.columns
    assert reshape.annotations(df, False).columns == ["statecode"]


def test_map_rows(spark):
    df = spark.createDataFrame([("u", {"a": 1, "b": 2}), ("v", {}), ("w", None)], "url string, m map<string,int>")
    assert rows(reshape.map_rows(df, "m", "k", "v")) == [("u", "a", 1), ("u", "b", 2)]


def test_union_and_allow_list(spark):
    one = spark.createDataFrame([(1, "x")], "id int, a string")
    two = spark.createDataFrame([(2, 0.5)], "id int, b double")
    both = reshape.union_entities({"one": one, "two": two})
    assert rows(both) == [("one", 1, "x", None), ("two", 2, None, 0.5)]
    assert reshape.only_entities(both, ["two"]).count() == 1


def test_upsert_replaces_null_keys_and_keeps_the_last_of_repeated_rows(spark):
    base = spark.createDataFrame([("a", 1), (None, 9)], "k string, v int")
    new = spark.createDataFrame([("a", 5), (None, 7), ("a", 6), (None, 8)], "k string, v int").coalesce(1)
    assert rows(upsert.upsert(base, new, ["k"])) == rows(spark.createDataFrame([("a", 6), (None, 8)], "k string, v int"))
    assert rows(upsert.upsert(base, new, ["k"], arrival="v desc")) == rows(
        spark.createDataFrame([("a", 5), (None, 7)], "k string, v int")
    )


def test_dates_lie_before_a_time_of_their_day(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'2024-01-29'), (DATE'2024-01-30'), (NULL) AS t(d)")
    noon, midnight = datetime(2024, 1, 30, 12), datetime(2024, 1, 30)
    day = timedelta(days=1)
    assert [str(r[0]) for r in upsert.fresh_rows(df, "d", noon, day).collect()] == ["2024-01-30"]
    assert upsert.fresh_rows(df, "d", midnight, day).count() == 2
    assert upsert.stale_rows(df, "d", noon, day).count() == 2
