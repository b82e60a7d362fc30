from __future__ import annotations

from datetime import date

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.operators import documents, profile
from entitylake.plans.dictionary import attribute_dictionary, dictionary_table
from entitylake.schemas import ATTRIBUTE
from entitylake.sources.documents import read_documents

SCHEMA = T.StructType().add("value", T.ArrayType(T.StructType().add("id", T.IntegerType())))
TEXTS = ['{"value":[{"id":1}]}', '{"value":[]}', '{"error":{"code":"0x1","message":"not found"}}', '{"value": [', ""]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "n int, body string")
    return documents.parse_documents(df, "body", SCHEMA)


def test_status(parsed):
    assert [(r["n"], r["status"]) for r in parsed.orderBy("n").collect()] == [
        (0, "ok"), (1, "ok"), (2, "error"), (3, "corrupt"), (4, "corrupt"),
    ]


def test_documents_are_parsed_once(parsed):
    assert plan_of(documents.data_only(parsed)).count("from_json") == 1


def test_split(parsed):
    assert documents.data_only(parsed).select("document.value").orderBy("n").collect()[0][0][0]["id"] == 1
    assert documents.quarantine(parsed).count() == 3


def test_strict_fails_at_an_error_page(parsed):
    with pytest.raises(Exception, match="error page: 0x1: not found"):
        documents.data_only(parsed, strict=True).select("n").collect()
    assert documents.data_only(parsed.filter("n <> 2"), strict=True).count() == 2


def test_tolerant_folder(spark, tmp_path):
    for i, text in enumerate(TEXTS):
        (tmp_path / f"d{i}.json").write_text(text.replace("{", "{\n", 1))
    found = read_documents(spark, str(tmp_path), SCHEMA, whole_files=True)
    # a file without any text holds no document
    assert sorted(r["status"] for r in found.collect()) == ["corrupt", "error", "ok", "ok"]


@pytest.fixture(scope="module")
def table(spark):
    made = [(i, "é" * (i % 3), None if i else 1.5, date(2024, 1, 1 + i), [i], f"t{i}") for i in range(4)]
    ddl = "id bigint, short string, v double, due date, list array<int>, text string"
    return spark.createDataFrame(made, ddl).withColumn("price", F.col("id").cast("decimal(10,2)"))


def test_profile(table):
    found = {r["field"]: r for r in profile.attribute_profile(table, "e").collect()}
    assert len(found) == 7
    assert found["short"]["max_length"] == 2 and found["short"]["database_length"] == 4
    assert found["v"]["n_nulls"] == 3 and found["v"]["max_value"] == 1.5
    assert found["due"]["min_time"] == "2024-01-01" and found["due"]["attribute_type"] == "DateTime"
    assert found["list"]["attribute_type"] == "Virtual" and found["list"]["n_records"] == 4
    assert found["price"]["precision"] == 2
    unique = {name for name, row in found.items() if row["is_unique"]}
    assert unique == {"id", "due", "text", "price"}


def test_a_single_repeat_is_found(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") == 4999, 17).otherwise(F.col("id")).alias("n"),
        F.concat(F.lit("x"), F.when(F.col("id") == 4999, 17).otherwise(F.col("id"))).alias("s"),
        F.concat(F.lit("y"), F.col("id")).alias("u"),
    )
    found = {r["field"]: r["is_unique"] for r in profile.attribute_profile(df, "e").collect()}
    assert found == {"n": False, "s": False, "u": True}


def test_empty_table(table):
    found = profile.attribute_profile(table.filter("false"), "e").collect()
    assert len(found) == 7 and not any(r["is_unique"] for r in found)


def test_dictionary_of_attribute_metadata(spark):
    made = {"LogicalName": "ownerid", "AttributeType": "Owner", "Targets": ["user", "team"],
            "DisplayName": (("Owner",),), "Description": None}
    df = spark.createDataFrame([tuple(made.get(name) for name in ATTRIBUTE.fieldNames())], ATTRIBUTE)
    table = dictionary_table(df)
    assert table.columns == profile.KEPT_ATTRIBUTES and len(table.columns) == 20
    row = table.first()
    assert row["DisplayName.UserLocalizedLabel.Label"] == "Owner"
    assert row["Description.UserLocalizedLabel.Label"] is None and row["Targets"] == ["user", "team"]


def test_attribute_dictionary(spark, table, tmp_path):
    frames = {"one": table, "two": table.select("id"), "three": table}
    found = attribute_dictionary(
        frames, ["one", "two"], str(tmp_path / "docs"), str(tmp_path / "csv"), {"one": {"id": ["two"]}}
    )
    assert found.groupBy("EntityLogicalName").count().count() == 2
    assert (tmp_path / "docs" / "entity=one").is_dir() and not (tmp_path / "docs" / "entity=three").exists()
    lookup = found.filter("EntityLogicalName = 'one' and SchemaName = 'id'").first()
    assert lookup["AttributeType"] == "Lookup" and lookup["Targets"] == ["two"] and lookup["IsPrimaryId"]
    csv = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert csv.count() == 8 and csv.columns == found.columns
    again = attribute_dictionary(frames, ["two"], str(tmp_path / "docs"))
    assert rows(again.select("EntityLogicalName", "SchemaName")) == [("two", "id")]
    assert (tmp_path / "docs" / "entity=one").is_dir()


def test_hashes_that_collide_are_looked_at(spark, monkeypatch):
    """With a hash of one bit nearly all values collide, and every answer is exact all the same."""
    df = spark.range(40).select(
        "id",
        F.concat(F.lit("t"), F.col("id") % 39).alias("once_again"),
        (F.col("id") / 3).alias("share"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        F.encode(F.col("id").cast("string"), "utf-8").alias("raw"),
    )
    candidates = {"e": df.columns, "f": ["id", "once_again"]}
    expected = {("e", name) for name in ("id", "share", "day", "raw")} | {("f", "id")}
    assert profile.unique_columns({"e": df, "f": df}, candidates) == expected
    real = F.xxhash64
    monkeypatch.setattr(profile.F, "xxhash64", lambda *cols: real(*cols) % 2)
    assert profile.unique_columns({"e": df, "f": df}, candidates) == expected
    assert profile.unique_columns({"e": df}, {}) == set()
