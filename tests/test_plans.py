from __future__ import annotations

from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from entitylake import Lake
from entitylake.operators.query import Navigation
from entitylake.plans.extract import Collection, extract_all, extract_from_csv, smallest_first, wanted
from entitylake.plans.reports import counts_of, counts_report
from entitylake.schemas import COUNT_SNAPSHOT, COUNTS_REPORT, DEFINITION, ENVIRONMENT
from entitylake.sources.csvfiles import read_csv, write_csv
from entitylake.sources.pages import read_pages


def definition(code, logical, plural, display=None, described=None):
    values = {
        "MetadataId": str(code), "LogicalName": logical, "SchemaName": logical.title(),
        "LogicalCollectionName": plural, "EntitySetName": plural, "ObjectTypeCode": code,
        "DisplayName": display, "DisplayCollectionName": display, "Description": described,
    }
    return tuple(values.get(name) for name in DEFINITION.fieldNames())


@pytest.fixture(scope="module")
def definitions(spark):
    label = (("Account",),)
    made = [
        definition(1, "account", "accounts", label, ((None,),)),
        definition(2, "contact", "contacts"),
        definition(3, "ghost", "ghosts"),
        definition(4, "lead", "leads"),
    ]
    return spark.createDataFrame(made, DEFINITION)


@pytest.fixture(scope="module")
def snapshots(spark):
    day = datetime(2024, 1, 1)
    return spark.createDataFrame([(1, 25, day), (2, 3, day), (3, 9, day)], COUNT_SNAPSHOT)


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "accounts": Collection(spark.range(25).withColumn("updatetime", F.lit("x")), "id"),
        "contact": Collection(spark.range(3).select((F.col("id") % 2).alias("account"), "id"), "id"),
        "leads": Collection(spark.range(0), "id"),
    }


def saved(spark, path):
    sizes = read_pages(spark, path).select("entity", "page_number", F.size("value"))
    return rows(sizes)


EXPECTED = [("account", 1, 10), ("account", 2, 10), ("account", 3, 5), ("contact", 1, 3), ("lead", 1, 0)]


def test_extract_all(spark, definitions, snapshots, tables, tmp_path):
    names = extract_all(definitions, snapshots, tables, str(tmp_path / "lake"), 10)
    assert names == ["lead", "contact", "account"]
    assert saved(spark, str(tmp_path / "lake")) == EXPECTED


def test_extract_nothing(spark, definitions, snapshots, tmp_path):
    assert extract_all(definitions, snapshots, {}, str(tmp_path / "lake")) == []


def worklist_csv(spark, path, entries):
    made = [(name, name, name, 'with "quotes", commas', count) for name, count in entries]
    write_csv(spark.createDataFrame(made, COUNTS_REPORT), path)


def test_extract_from_csv(spark, definitions, tables, tmp_path):
    csv, lake = str(tmp_path / "csv"), str(tmp_path / "lake")
    entries = [("account", 25), ("contact", 3), ("lead", 0), ("", 7), (None, 8), ("unknown", 5), ("broken", 4), ("plain", 1)]
    worklist_csv(spark, csv, entries)

    def missing():
        raise OSError("gone")

    failing = spark.range(3).select(F.when(F.col("id") > 1, F.raise_error(F.lit("bad row"))).cast("int").alias("id"))
    more = {
        **tables, "broken": Collection(failing, "id"), "plain": Collection(spark.range(1), "id"), "unknown": missing
    }
    status = extract_from_csv(spark, csv, definitions, more, lake, 10)
    assert {name: text for name, text in status.items() if text == "saved"}.keys() == {"account", "contact", "plain"}
    assert status["unknown"] == "OSError: gone" and "bad row" in status["broken"]
    assert saved(spark, lake) == [row for row in EXPECTED if row[0] != "lead"] + [("plain", 1, 1)]


def test_worklist(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("z", 1), ("n", None)], "LogicalName string, Count bigint")
    assert [r[0] for r in smallest_first(df).collect()] == ["n", "z", "a", "b"]
    assert wanted(df).count() == 3


def test_counts_report(spark, definitions, tmp_path):
    state = {
        "last_updated": "x", "endpoints": {}, "entities": {},
        "record_counts": {"account": (25, "t"), "contact": (25, "t"), "ghost": (9, "t")},
    }
    environment = spark.createDataFrame([tuple(state[name] for name in ENVIRONMENT.fieldNames())], ENVIRONMENT)
    path = str(tmp_path / "report")
    report = counts_report(counts_of(environment), definitions, path)
    assert [tuple(r) for r in report.collect()] == [
        ("contact", "contact", "contact", "", 25),
        ("account", "account", "Account", "", 25),
        ("ghost", "ghost", "ghost", "", 9),
    ]
    back = read_csv(spark, path, COUNTS_REPORT)
    assert [r["Count"] for r in back.collect()] == [25, 25, 9]
    unknown = spark.createDataFrame([("nobody", 1)], "entity string, record_count bigint")
    with pytest.raises(Exception, match="nobody"):
        counts_report(unknown, definitions).collect()


def test_lake(spark, definitions, snapshots, tables, tmp_path):
    nav = Navigation("contacts", tables["contact"].df, "id", "account", many=True, select="id", order_by=["id"])
    lake = Lake(spark, tables, definitions, snapshots, {"accounts": [nav]})
    found = lake.get_entities("accounts", select="id", filter="id < 3", expand="contacts", orderby="id", count=True)
    assert [(r["id"], [x["id"] for x in r["contacts"]], r["@odata.count"]) for r in found.collect()] == [
        (0, [0, 2], 3), (1, [1], 3), (2, [], 3),
    ]
    assert lake.get_entity("accounts", {"id": 3}, select="id").collect()[0]["id"] == 3
    assert lake.get_all_records("contact").count() == 3
    assert [r["id"] for r in lake.get_first_page("accounts", 2).collect()] == [0, 1]
    assert [r["id"] for r in lake.get_next_page("accounts", {"id": 1}, 2).collect()] == [2, 3]
    assert lake.get_all_pages("accounts", 10).count() == 3
    assert lake.get_names().count() == 40
    assert {r["endpoint"] for r in lake.get_endpoints().collect()} == {"accounts", "contact", "leads", None}
    assert lake.get_record_counts().count() == 3
    profiles = {r["entity"]: r for r in lake.get_profiles().collect()}
    assert profiles["account"]["time_fields"] == ["updatetime"] and profiles["contact"]["record_count"] == 3
    assert lake.counts_report().first()["Entity"] == "account"
    lake.save_pages(str(tmp_path / "p"), ["accounts"], 10)
    lake.save_records(str(tmp_path / "r"))
    assert len(saved(spark, str(tmp_path / "p"))) == 3
    assert lake.extract_all(str(tmp_path / "x"), 10) == ["lead", "contact", "account"]
    with pytest.raises(LookupError):
        lake.get_entities("nothing")
    with pytest.raises(LookupError):
        Lake(spark, tables).get_names()
