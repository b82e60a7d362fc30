"""JSON records as variants: parsed once, with fields, types and schema found from the data.

``parsed`` turns the text of a record into a variant. Fields and types come from one aggregate over
the variants, combined on the map side, so no schema needs to be known beforehand; what reaches the
driver of a found schema is one text per entity.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named
from entitylake.schemas import ENTITY

VARIANT = "variant"
FIELDS = "map<string, variant>"


def parsed(records: DataFrame, column: str = "record", out: str = VARIANT) -> DataFrame:
    """Adds the record as a variant; null if the text is null or malformed, or has a key twice."""
    # as the output of a generator it stays one expression, which later filters do not repeat
    return records.select("*", F.explode(F.array(F.try_parse_json(named(column)))).alias(out))


def field_types(records: DataFrame, column: str = "record", out_type: str = "type") -> DataFrame:
    """``(entity, field, n_records, n_nulls, type)`` of records as JSON text (entity, record).

    ``n_records`` counts the records that have the field, ``n_nulls`` those in which it is null.
    ``type`` is the least that holds all values, ``VOID`` if all are null and ``VARIANT`` if they
    have nothing in common. Records that are malformed, or no objects, have no fields.
    """
    entries = F.try_variant_get(F.col(VARIANT), "$", FIELDS)
    fields = parsed(records, column).select(ENTITY, F.explode(entries).alias("field", "value"))
    return fields.groupBy(ENTITY, "field").agg(
        F.count("*").alias("n_records"),
        F.count_if(F.is_variant_null("value")).alias("n_nulls"),
        F.schema_of_variant_agg("value").alias(out_type),
    )


def kind(type_text: Column) -> Column:
    """A found type without its parameters: ``DECIMAL(9,2)`` is ``DECIMAL``, ``OBJECT<a: STRING>`` is ``OBJECT``."""
    return F.regexp_extract(type_text, "^[A-Z]+", 0)


def found_schemas(records: DataFrame, column: str = "record") -> dict[str, T.StructType]:
    """The schema of each entity's records, by entity; entities without an object among them have none.

    Fields come in alphabetical order. One whose values are all null is text; values without a
    common type stay variants. An empty object is a variant too, for a struct needs a field.
    """
    # other values than objects would leave the records no common type
    objects = parsed(records, column).where(F.try_variant_get(F.col(VARIANT), "$", FIELDS).isNotNull())
    found = objects.groupBy(ENTITY).agg(F.schema_of_variant_agg(VARIANT).alias("type"))
    schemas = {row[ENTITY]: T._parse_datatype_string(ddl(row["type"])) for row in found.collect()}
    return {entity: schema for entity, schema in schemas.items() if isinstance(schema, T.StructType)}


def ddl(type_text: str) -> str:
    """A type as ``schema_of_variant_agg`` gives it, as one that a table can have."""

    def plain(part: str) -> str:
        part = re.sub(r"OBJECT<>", "VARIANT", part)
        return re.sub(r"\bVOID\b", "STRING", part.replace("OBJECT<", "STRUCT<"))

    # names that look like types are either quoted or stand before a colon
    pieces = re.split(r"(`(?:[^`]|``)*`|[^\s<>,:`]+(?=: ))", type_text)
    quoted = [piece if piece.startswith("`") else f"`{piece}`" for piece in pieces[1::2]]
    return "".join(part for pair in zip(map(plain, pieces[::2]), [*quoted, ""]) for part in pair)


def typed(records: DataFrame, schema: T.StructType, entity: str, column: str = "record") -> DataFrame:
    """The records of one entity with the columns of ``schema``.

    A field that a record lacks, or that does not fit its type, is null; records that are malformed,
    or no objects, give no row.
    """
    own = parsed(records.where(F.col(ENTITY) == entity).select(ENTITY, named(column)), column)
    # by name, as a path cannot hold every name; exploded once, so that it stays one expression
    objects = own.select(F.explode(F.array(F.try_variant_get(F.col(VARIANT), "$", FIELDS))).alias("fields"))
    objects = objects.where(F.col("fields").isNotNull())
    values = [
        F.try_variant_get(F.try_element_at("fields", F.lit(item.name)), "$", item.dataType.simpleString()).alias(item.name)
        for item in schema.fields
    ]
    return objects.select(*values)
