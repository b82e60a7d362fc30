"""Attribute profiles: what the data itself says about each column."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named
from entitylake.schemas import ATTRIBUTE, ENTITY

# --- fixed values: attribute types, and the columns of the dictionary -------
ATTRIBUTE_TYPES = {
    "string": "String",
    "boolean": "Boolean",
    "tinyint": "Integer",
    "smallint": "Integer",
    "int": "Integer",
    "bigint": "BigInt",
    "float": "Double",
    "double": "Double",
    "decimal": "Decimal",
    "date": "DateTime",
    "timestamp": "DateTime",
    "timestamp_ntz": "DateTime",
}
KEPT_ATTRIBUTES = [
    "AttributeType",
    "DisplayName.UserLocalizedLabel.Label",
    "Format",
    "LogicalName",
    "SchemaName",
    "MaxLength",
    "DatabaseLength",
    "ImeMode",
    "AttributeOf",
    "Targets",
    "IsPrimaryId",
    "IsPrimaryName",
    "IsCustomAttribute",
    "EntityLogicalName",
    "Description.UserLocalizedLabel.Label",
    "MaxValue",
    "MinValue",
    "Precision",
    "MinSupportedValue",
    "MaxSupportedValue",
]
# --------------------------------------------------------------------------

DISTINCT = "__distinct"
LEAST_SHARE = 0.5
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
NESTED = (T.ArrayType, T.MapType, T.StructType)


def attribute_type(dtype: T.DataType) -> str:
    return ATTRIBUTE_TYPES.get(dtype.simpleString().split("(")[0], "Virtual")


def _measures(item: T.StructField, prefix: str) -> list[Column]:
    """Aggregates of one column, named ``<prefix>_…``; all of them combine on the map side."""
    col, dtype = named(item.name), item.dataType
    found = [F.count(col).alias(f"{prefix}_filled")]
    if isinstance(dtype, T.StringType):
        found.append(F.max(F.length(col)).cast("bigint").alias(f"{prefix}_length"))
        found.append(F.max(F.octet_length(col)).cast("bigint").alias(f"{prefix}_bytes"))
    if isinstance(dtype, NUMERIC + TIMES):
        plain = "double" if isinstance(dtype, NUMERIC) else "string"
        found += [F.min(col).cast(plain).alias(f"{prefix}_min"), F.max(col).cast(plain).alias(f"{prefix}_max")]
    if isinstance(dtype, EXACT):
        found += [F.min(col).cast("string").alias(f"{prefix}_least"), F.max(col).cast("string").alias(f"{prefix}_most")]
    if not isinstance(dtype, NESTED):
        found.append(F.approx_count_distinct(col).alias(f"{prefix}_distinct"))
    return found


def _row(item: T.StructField, prefix: str) -> Column:
    dtype = item.dataType

    def measure(kind: str, present: bool, type_: str) -> Column:
        return (F.col(f"{prefix}_{kind}") if present else F.lit(None)).cast(type_)

    text, number, time = (isinstance(dtype, kinds) for kinds in ((T.StringType,), NUMERIC, TIMES))
    precision = dtype.scale if isinstance(dtype, T.DecimalType) else None
    return F.struct(
        F.lit(item.name).alias("field"),
        F.lit(attribute_type(dtype)).alias("attribute_type"),
        F.col(f"{prefix}_filled").alias("n_records"),
        (F.col("total") - F.col(f"{prefix}_filled")).alias("n_nulls"),
        measure("length", text, "bigint").alias("max_length"),
        measure("bytes", text, "bigint").alias("database_length"),
        measure("min", number, "double").alias("min_value"),
        measure("max", number, "double").alias("max_value"),
        measure("least", isinstance(dtype, EXACT), "string").alias("min_exact"),
        measure("most", isinstance(dtype, EXACT), "string").alias("max_exact"),
        measure("min", time, "string").alias("min_time"),
        measure("max", time, "string").alias("max_time"),
        F.lit(precision).cast("int").alias("precision"),
        measure("distinct", not isinstance(dtype, NESTED), "bigint").alias(DISTINCT),
    )


def _measured(df: DataFrame, entity: str) -> DataFrame:
    """One row per column, from one pass over the table."""
    prefixed = [(item, f"c{i}") for i, item in enumerate(df.schema.fields)]
    measures = [measure for item, prefix in prefixed for measure in _measures(item, prefix)]
    totals = df.agg(F.count("*").alias("total"), *measures)
    return totals.select(
        F.lit(entity).alias(ENTITY), F.inline(F.array(*[_row(item, prefix) for item, prefix in prefixed]))
    )


def attribute_profiles(frames: Mapping[str, DataFrame], least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per column of every entity: type, lengths, bounds, null count, uniqueness.

    ``min_value`` and ``max_value`` are doubles; for integers and decimals,
    ``min_exact`` and ``max_exact`` have all digits, as text.

    One pass per table measures all its columns. Whether a column identifies its
    records needs an exact answer, which a sketch cannot give; but the sketch of
    that pass, which is some 5 % off, rules out all columns with fewer different
    values than ``least_share`` of the records (0: none). The rest are answered
    together, see ``unique_columns``. What comes to the driver is a row per column.
    """
    measured = reduce(DataFrame.unionByName, [_measured(df, entity) for entity, df in frames.items()])
    rows = measured.collect()
    candidates: dict[str, list[str]] = {}
    for row in rows:
        if row[DISTINCT] is not None and row["n_nulls"] == 0 and row["n_records"] > 0:
            if row[DISTINCT] >= row["n_records"] * least_share:
                candidates.setdefault(row[ENTITY], []).append(row["field"])
    unique = unique_columns(frames, candidates)
    profile = measured.sparkSession.createDataFrame(rows, measured.schema).drop(DISTINCT)
    known = F.array(*[F.struct(F.lit(entity).alias(ENTITY), F.lit(name).alias("field")) for entity, name in sorted(unique)])
    found = F.array_contains(known, F.struct(ENTITY, "field")) if unique else F.lit(False)
    return profile.withColumn("is_unique", found)


def unique_columns(frames: Mapping[str, DataFrame], candidates: Mapping[str, list[str]]) -> set[tuple[str, str]]:
    """The candidate columns, by entity, in which no value occurs twice.

    One job counts 64-bit hashes of all candidates' values. A column without a repeated hash has no
    repeated value. Of every other column one repeated hash is looked at: if rows with it have equal values,
    the column is not unique, and only if they do not are all its values grouped.
    """
    hashes = [
        _each(frames[entity], entity, names, lambda df, name: F.xxhash64(named(name))) for entity, names in candidates.items()
    ]
    if not hashes:
        return set()
    repeated = reduce(DataFrame.union, hashes).groupBy(ENTITY, "field", "v").agg(F.count("*").alias("n")).filter("n > 1")
    witness = {(row[ENTITY], row["field"]): row["v"] for row in repeated.groupBy(ENTITY, "field").agg(F.min("v").alias("v")).collect()}
    repeats = set()
    if witness:
        values = []
        for entity in candidates:
            names = [name for name in candidates[entity] if (entity, name) in witness]
            if names:
                same = lambda df, name: F.when(F.xxhash64(named(name)) == witness[entity, name], _exact(df, name))
                values.append(_each(frames[entity], entity, names, same).filter(F.col("v").isNotNull()))
        twice = reduce(DataFrame.union, values).groupBy(ENTITY, "field", "v").agg(F.count("*").alias("n")).filter("n > 1")
        repeats = {(row[ENTITY], row["field"]) for row in twice.select(ENTITY, "field").distinct().collect()}
    every = {(entity, name) for entity, names in candidates.items() for name in names}
    unclear = witness.keys() - repeats
    return {one for one in every - repeats if one not in unclear or _repeats(frames[one[0]], one[1]).isEmpty()}


def _each(df: DataFrame, entity: str, names: list[str], value: Callable[[DataFrame, str], Column]) -> DataFrame:
    """``(entity, field, v)``: a row per record and column, from one scan."""
    items = F.array(*[F.struct(F.lit(name).alias("field"), value(df, name).alias("v")) for name in names])
    return df.select(F.lit(entity).alias(ENTITY), F.inline(items))


def _exact(df: DataFrame, name: str) -> Column:
    """A text that is equal for equal values; texts are compared by their SHA-256 digests."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.sha2(named(name), 256)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (named(name) + F.lit(0.0)).cast("string")  # no negative zero
    return F.hex(named(name)) if isinstance(kind, T.BinaryType) else named(name).cast("string")


def attribute_profile(df: DataFrame, entity: str) -> DataFrame:
    return attribute_profiles({entity: df})


def _repeats(df: DataFrame, name: str) -> DataFrame:
    """Values of a column that occur more than once."""
    return df.select(_exact(df, name).alias("v")).groupBy("v").agg(F.count("*").alias("n")).filter("n > 1")


def _label(text: Column) -> Column:
    return F.struct(F.struct(text.alias("Label")).alias("UserLocalizedLabel"))


def attribute_documents(
    profile: DataFrame, targets: Mapping[str, Mapping[str, list[str]]] | None = None
) -> DataFrame:
    """A profile as nested attribute documents, the shape attribute metadata has.

    ``targets`` gives, per entity and lookup column, the entities referred to.
    What only a server could know (format, input mode, parent attribute) is null.
    """
    null = F.lit(None)
    key = F.concat_ws(".", ENTITY, "field")
    pairs = [
        (F.lit(f"{entity}.{name}"), F.array(*[F.lit(one) for one in found]))
        for entity, lookups in (targets or {}).items()
        for name, found in lookups.items()
    ]
    referred = F.try_element_at(F.create_map(*[c for pair in pairs for c in pair]), key) if pairs else null
    columns = {
        "LogicalName": F.lower("field"),
        "SchemaName": F.col("field"),
        "EntityLogicalName": F.col(ENTITY),
        "AttributeType": F.when(referred.isNotNull(), F.lit("Lookup")).otherwise(F.col("attribute_type")),
        "MaxLength": F.col("max_length"),
        "DatabaseLength": F.col("database_length"),
        "Precision": F.col("precision"),
        "MinValue": F.col("min_value"),
        "MaxValue": F.col("max_value"),
        "MinSupportedValue": F.col("min_time"),
        "MaxSupportedValue": F.col("max_time"),
        "IsPrimaryId": F.col("is_unique"),
        "IsPrimaryName": F.lit(False),
        "IsCustomAttribute": F.lit(False),
        "Targets": referred,
        "DisplayName": _label(F.initcap(F.replace(F.col("field"), F.lit("_"), F.lit(" ")))),
        "Description": _label(null.cast("string")),
    }
    return profile.select(
        *[columns.get(item.name, null).cast(item.dataType).alias(item.name) for item in ATTRIBUTE.fields]
    )
