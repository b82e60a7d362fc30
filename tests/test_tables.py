from __future__ import annotations

import os

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from entitylake.operators.reshape import only_entities, union_entities
from entitylake.sources import tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Entities as folders, as single files, with a name that is escaped, and without rows."""
    top = tmp_path_factory.mktemp("lake") / "tables"
    for i in range(12):
        made = spark.range(i * 10, i * 10 + 3).select("id", F.lit(f"n{i}").alias(f"name_{i % 3}"))
        made.repartition(2).write.parquet(f"{top}/entity {i}.parquet")
    spark.range(5).coalesce(1).write.parquet(f"{top}/one")
    (file,) = [name for name in os.listdir(top / "one") if name.endswith(".parquet")]
    os.rename(top / "one" / file, top / "single.parquet")
    return str(top)


def test_one_read_equals_the_union(spark, folder):
    names = tables.entities_in(spark, folder)
    assert names == sorted(["single", *(f"entity {i}" for i in range(12))])
    every = tables.read_many(spark, folder)
    union = union_entities(tables.read_collections(spark, folder, names))
    assert set(every.columns) == set(union.columns)
    assert rows(every.select(*union.columns)) == rows(union)
    few = tables.read_many(spark, folder + "/", ["entity 3", "single"])
    assert rows(few.groupBy("entity").count()) == [("entity 3", 3), ("single", 5)]


def test_the_plan_does_not_grow(spark, folder):
    def scans(df):
        return plan_of(df).count("FileScan"), len(df._jdf.queryExecution().analyzed().toString().splitlines())

    two = tables.read_many(spark, folder, ["entity 0", "entity 1"])
    assert scans(two) == scans(tables.read_many(spark, folder)) and scans(two)[0] == 1


def test_an_entity_chooses_its_files(spark, folder):
    chosen = only_entities(tables.read_many(spark, folder), ["entity 4"])
    assert rows(chosen.select("id")) == [(40,), (41,), (42,)]
    scan = chosen._jdf.queryExecution().executedPlan()
    chosen.collect()
    found = [line for line in str(scan.treeString()).splitlines() if "FileScan" in line]
    assert found
    leaves = scan.collectLeaves()
    files = sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numFiles"))
    assert files <= 2


def test_no_entities(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_many(spark, str(tmp_path))
