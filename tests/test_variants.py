from __future__ import annotations

import json

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.operators import variants

RECORDS = [
    ("a", '{"x": 1, "y": "t", "z": {"p": 1.5, "q": [1, 2, null]}, "we ird": true, "OBJECT": null}'),
    ("a", '{"x": 2.5, "y": null, "z": {"VOID": "s"}}'),
    ("a", "broken{"), ("a", None), ("a", ""), ("a", "[1]"), ("a", '{"x": 1, "x": 2}'),
    ("b", '{"k": 1e300, "n": 12345678901234567890123}'), ("b", "{}"),
    ("c", '{"m": 1}'), ("c", '{"m": "one"}'), ("c", '{"a,b: >": [{"u": 1}, {"u": "x"}]}'),
    ("d", "[]"), ("d", "7"),
]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(RECORDS, "entity string, record string").repartition(3)


def plain() -> dict:
    """Counts by plain code."""
    found = {}
    for entity, text in RECORDS:
        try:
            pairs = json.loads(text or "", object_pairs_hook=lambda pairs: pairs if len(dict(pairs)) == len(pairs) else [])
        except json.JSONDecodeError:
            continue
        for name, value in pairs if text.startswith("{") else []:
            n, nulls = found.get((entity, name), (0, 0))
            found[entity, name] = (n + 1, nulls + (value is None))
    return found


def test_fields_and_types_from_one_aggregate(records):
    found = variants.field_types(records)
    counts = {(r["entity"], r["field"]): (r["n_records"], r["n_nulls"]) for r in found.collect()}
    assert counts == plain()
    types = {(r["entity"], r["field"]): r["kind"] for r in found.select("*", variants.kind(F.col("type")).alias("kind")).collect()}
    assert types == {
        ("a", "x"): "DECIMAL", ("a", "y"): "STRING", ("a", "z"): "OBJECT", ("a", "we ird"): "BOOLEAN", ("a", "OBJECT"): "VOID",
        ("b", "k"): "DOUBLE", ("b", "n"): "DECIMAL", ("c", "m"): "VARIANT", ("c", "a,b: >"): "ARRAY",
    }
    assert plan_of(found).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    assert rows(variants.field_types(records.where("entity = 'none'"))) == []


def test_schema_and_records(records):
    schemas = variants.found_schemas(records)
    assert set(schemas) == {"a", "b", "c"}
    assert schemas["a"].names == ["OBJECT", "we ird", "x", "y", "z"]
    assert schemas["a"]["z"].dataType.names == ["VOID", "p", "q"] and schemas["a"]["OBJECT"].dataType == T.StringType()
    assert isinstance(schemas["c"]["m"].dataType, T.VariantType)
    found = variants.typed(records, schemas["a"], "a")
    shown = found.select("`we ird`", F.col("x").cast("double"), "y", F.col("z.p").cast("double"), "z.q", "z.VOID")
    assert sorted(map(tuple, shown.collect()), key=repr) == sorted(
        [(True, 1.0, "t", 1.5, [1, 2, None], None), (None, 2.5, None, None, None, "s")], key=repr
    )
    odd = variants.typed(records, schemas["c"], "c").select(F.col("m").cast("string"), F.size("`a,b: >`"))
    assert sorted(map(tuple, odd.collect()), key=repr) == sorted([("1", None), ("one", None), (None, 2)], key=repr)


def test_records_in_their_own_types(spark):
    table = spark.createDataFrame([(1, "a'b", 1.25, None), (2, None, -3.5, "x")], "id long, `na'me` string, v double, w string")
    saved = table.select(F.lit("t").alias("entity"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))
    schema = variants.found_schemas(saved)["t"]
    back = variants.typed(saved, schema, "t").select("id", "`na'me`", F.col("v").cast("double"), "w")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))


def test_a_type_that_does_not_fit_gives_null(records):
    schema = T.StructType([T.StructField("m", T.LongType()), T.StructField("none", T.StringType())])
    found = variants.typed(records, schema, "c").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, None), (None, None), (None, None)], key=repr)
