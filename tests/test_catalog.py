from __future__ import annotations

from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from entitylake.functions import columns as c
from entitylake.functions import labels
from entitylake.operators import catalog
from entitylake.schemas import COUNT_SNAPSHOT, DEFINITION


def label(text):
    return ((text,),)


def definition(code, logical, plural, schema, display, displays, described, **more):
    values = {
        "MetadataId": f"{code}:{plural}", "LogicalName": logical, "SchemaName": schema,
        "LogicalCollectionName": plural, "EntitySetName": plural, "ObjectTypeCode": code,
        "DisplayName": display, "DisplayCollectionName": displays, "Description": described, **more,
    }
    return tuple(values.get(name) for name in DEFINITION.fieldNames())


@pytest.fixture(scope="module")
def definitions(spark):
    made = [
        definition(1, "account", "accounts", "Account", label("Account"), label("Accounts"), label("A company")),
        definition(2, "contact", "contacts", "Contact", label("Contact"), (None,), label(None)),
        definition(4, "lead", "leads", "Lead", None, None, None),
        definition(99, "ghost", "ghosts", "Ghost", label("Ghost"), label("Ghosts"), label("…")),
        definition(5, "", "things", "Thing", label("Thing"), label("Things"), label("…")),
    ]
    return spark.createDataFrame(made, DEFINITION)


@pytest.fixture(scope="module")
def available(spark):
    names = ["accounts", "account", "contact", "lead", "leads", "things", "leads"]
    return spark.createDataFrame([(name,) for name in names], "name string")


@pytest.fixture(scope="module")
def snapshots(spark):
    day = datetime(2023, 5, 1)
    made = [(1, 2000, day), (1, 2500, day.replace(day=2)), (2, 1000, day), (4, 0, day), (77, 3, day)]
    return spark.createDataFrame(made, COUNT_SNAPSHOT)


def test_harvest(definitions):
    names = catalog.harvest_names(definitions)
    assert names.count() == 50
    account = {r["kind"]: r["name"] for r in names.filter("LogicalName = 'account'").collect()}
    assert account["display_name"] == "Account" and account["schema_name"] == "Account"
    assert account["physical_name"] is None
    contact = {r["kind"]: r["name"] for r in names.filter("LogicalName = 'contact'").collect()}
    assert contact["display_name"] is None and contact["display_collection_name"] is None
    assert catalog.harvest_names(definitions, short=True).count() == 35


def test_report_labels(definitions):
    name, description = labels.report_labels(F.col("LogicalName"))
    found = {r[0]: (r[1], r[2]) for r in definitions.select("LogicalName", name, description).collect()}
    assert found["account"] == ("Account", "A company")
    assert found["contact"] == ("Contact", "")
    assert found["lead"] == ("lead", "")


def test_index_last_wins(spark, definitions):
    newer = spark.createDataFrame(
        [definition(1, "account", "accounts2", "Account", label("Account"), label("Accounts"), label("newer"))],
        DEFINITION,
    )
    both = definitions.withColumn("seq", F.lit(1)).unionByName(newer.withColumn("seq", F.lit(2)))
    index = catalog.catalog_index(both, "seq")
    assert index.count() == 5
    assert index.filter("LogicalName = 'account'").first()["LogicalCollectionName"] == "accounts2"


def endpoints(found):
    return {r["MetadataId"].split(":")[1]: r["endpoint"] for r in found.collect()}


def test_longest_endpoint(definitions, available):
    found = endpoints(catalog.resolve_endpoints(definitions, available))
    assert found == {"accounts": "accounts", "contacts": "contact", "leads": "leads", "ghosts": None, "things": "things"}


def test_priority_endpoint(definitions, available):
    found = endpoints(catalog.resolve_endpoints(definitions, available, rule="priority"))
    assert found == {"accounts": "accounts", "contacts": "contact", "leads": "leads", "ghosts": None, "things": "things"}
    by_name = endpoints(catalog.resolve_endpoints(definitions, available, "priority", fields=["LogicalName", "SchemaName"]))
    assert by_name["accounts"] == "account" and by_name["leads"] == "lead" and by_name["things"] is None
    with pytest.raises(ValueError):
        catalog.resolve_endpoints(definitions, available, rule="shortest")


def test_known_endpoints_are_kept(spark, definitions, available):
    known = spark.createDataFrame([("1:accounts", "elsewhere"), ("99:ghosts", None)], "MetadataId string, endpoint string")
    found = endpoints(catalog.resolve_remaining(definitions, known, available, rule="priority"))
    assert found == {"accounts": "elsewhere", "contacts": "contact", "leads": "leads", "ghosts": None, "things": "things"}


def test_equal_length_takes_the_first_in_the_alphabet(spark):
    made = [definition(1, "bbb", "aaa", "ccc", None, None, None)]
    df = spark.createDataFrame(made, DEFINITION)
    found = catalog.resolve_endpoints(df, spark.createDataFrame([("ccc",), ("bbb",)], "name string"))
    assert found.first()["endpoint"] == "bbb"


def test_display_names_count_only_in_the_short_harvest(spark):
    df = spark.createDataFrame(
        [definition(1, "a", "as", "A", label("Big Thing"), label("Big Things"), None)], DEFINITION
    )
    names = spark.createDataFrame([("bigthing",), ("a",)], "name string")
    assert catalog.resolve_endpoints(df, names).first()["endpoint"] == "a"
    assert catalog.resolve_endpoints(df, names, short=True).first()["endpoint"] == "bigthing"


def test_record_counts(definitions, snapshots):
    counts = {r["entity"]: r["record_count"] for r in catalog.record_counts(definitions, snapshots).collect()}
    assert counts == {"account": 2500, "contact": 1000, "lead": 0}
    every = {r["entity"]: (r["record_count"], r["last_updated"]) for r in
             catalog.record_counts_or_zero(definitions, snapshots).collect()}
    assert every["ghost"] == (0, None) and every["Thing"] == (0, None)
    assert every["account"] == (2500, datetime(2023, 5, 2))


def test_strict_lookup(spark):
    entries = spark.createDataFrame([("a", 1)], "name string, v int")
    good = spark.createDataFrame([("a",), ("a",)], "k string")
    assert catalog.strict_lookup(good, entries, "k", "name").count() == 2
    for bad in ("b", None):
        lookup = catalog.strict_lookup(spark.createDataFrame([("a",), (bad,)], "k string"), entries, "k", "name")
        with pytest.raises(Exception, match="no entry for k"):
            lookup.select("k").collect()


def test_entity_counts(spark):
    one = spark.sql("SELECT * FROM VALUES (timestamp_ntz'2024-01-01'), (NULL) AS t(at)")
    found = catalog.entity_counts({"one": one, "two": one.filter("false")}, {"one": "at"})
    assert rows(found) == [("one", 2, datetime(2024, 1, 1)), ("two", 0, None)]


def test_fields(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 3, None)], "createdate int, updatetime int, Date string")
    listing = catalog.field_listing({"e": df})
    assert rows(listing) == [("e", "Date", 1), ("e", "createdate", 2), ("e", "updatetime", 1)]
    marked = {r["field"]: (r["is_date"], r["is_time"]) for r in catalog.time_fields(listing).collect()}
    assert marked == {"Date": (False, False), "createdate": (True, False), "updatetime": (True, True)}


def test_json_fields(spark):
    texts = [("e", '{"a":1,"b":null}'), ("e", '{"a":2}'), ("f", '{"c":{"d":1}}'), ("f", "broken")]
    records = spark.createDataFrame(texts, "entity string, record string")
    assert rows(catalog.json_field_listing(records)) == [("e", "a", 2), ("e", "b", 1), ("f", "c", 1)]


def test_profile(spark, definitions, available, snapshots):
    fields = spark.createDataFrame(
        [("accounts", "updatetime", True, True), ("accounts", "x", False, False)],
        "entity string, field string, is_date boolean, is_time boolean",
    )
    profile = catalog.entity_profile(
        definitions,
        catalog.resolve_endpoints(definitions, available),
        catalog.record_counts_or_zero(definitions, snapshots),
        fields,
    )
    found = {r["entity"]: r for r in profile.collect()}
    assert found["account"]["label"] == "Account<Endpoint=accounts, Count=2500>"
    assert found["account"]["estimated_pages"] == 3 and found["account"]["catalog_size"] == 5
    assert found["account"]["date_fields"] == ["updatetime"] == found["account"]["time_fields"]
    assert found["ghost"]["endpoint"] is None
    assert found["lead"]["label"] == "None<Endpoint=leads, Count=0>"


def test_scalars(spark):
    row = spark.sql("SELECT 'A b.C' AS s, '' AS e").select(
        c.lowered(F.col("s")), c.without_spaces(F.col("s")), c.part_of(F.col("s"), ".", 2),
        c.part_of(F.col("s"), ".", 3), c.text_or(F.col("e"), "d"), c.page_file(F.col("s"), F.lit(3)),
        c.parsed_time(F.lit("2023-05-01 10:11:12.123456")), c.parsed_time(F.lit("2023-05-01 10:11:12")),
        c.parsed_time(F.lit("None")), c.printed_time(F.lit("2023-05-01 10:11:12").cast("timestamp_ntz")),
    ).first()
    gap = "2024-03-31 02:30:00"  # skipped by the clocks in Berlin
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        printed = spark.range(1).select(c.printed_time(c.parsed_time(F.lit(gap)))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert printed == gap + ".000000"
    assert tuple(row) == (
        "a b.c", "Ab.C", "C", None, "d", "A b.C_page_3.json",
        datetime(2023, 5, 1, 10, 11, 12, 123456), datetime(2023, 5, 1, 10, 11, 12), None,
        "2023-05-01 10:11:12.000000",
    )
