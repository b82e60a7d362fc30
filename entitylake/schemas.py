"""Schemas of the JSON shapes at the edges.

They are explicit because inference cannot type an empty ``value: []`` and
costs a pass over the files.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: keys of the page envelope ------------------------------
VALUE = "value"
NEXT_LINK = "@odata.nextLink"
COUNT = "@odata.count"
ERROR = "error"
CORRUPT = "_corrupt_record"
# --------------------------------------------------------------------------

ENTITY = "entity"
PAGE_NUMBER = "page_number"

LABEL = T.StructType(
    [T.StructField("UserLocalizedLabel", T.StructType([T.StructField("Label", T.StringType())]))]
)

ERROR_BODY = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("message", T.StringType())]
)

# --- fixed values: fields of an entity definition -------------------------
DEFINITION_NAMES = [
    "MetadataId",
    "LogicalName",
    "Name",
    "SchemaName",
    "CollectionName",
    "CollectionSchemaName",
    "LogicalCollectionName",
    "PhysicalName",
    "BaseTableName",
    "EntitySetName",
]
DEFINITION_LABELS = ["DisplayName", "DisplayCollectionName", "Description"]
# --------------------------------------------------------------------------

DEFINITION = T.StructType(
    [T.StructField(name, T.StringType()) for name in DEFINITION_NAMES]
    + [T.StructField("ObjectTypeCode", T.LongType())]
    + [T.StructField(name, LABEL) for name in DEFINITION_LABELS]
)

# --- fixed values: fields of an attribute; their types are our choice ------
ATTRIBUTE = T.StructType(
    [
        T.StructField("LogicalName", T.StringType()),
        T.StructField("SchemaName", T.StringType()),
        T.StructField("EntityLogicalName", T.StringType()),
        T.StructField("AttributeType", T.StringType()),
        T.StructField("AttributeOf", T.StringType()),
        T.StructField("Format", T.StringType()),
        T.StructField("ImeMode", T.StringType()),
        T.StructField("MaxLength", T.LongType()),
        T.StructField("DatabaseLength", T.LongType()),
        T.StructField("Precision", T.IntegerType()),
        T.StructField("MinValue", T.DoubleType()),
        T.StructField("MaxValue", T.DoubleType()),
        T.StructField("MinSupportedValue", T.StringType()),
        T.StructField("MaxSupportedValue", T.StringType()),
        T.StructField("IsPrimaryId", T.BooleanType()),
        T.StructField("IsPrimaryName", T.BooleanType()),
        T.StructField("IsCustomAttribute", T.BooleanType()),
        T.StructField("Targets", T.ArrayType(T.StringType())),
        T.StructField("DisplayName", LABEL),
        T.StructField("Description", LABEL),
    ]
)
# --------------------------------------------------------------------------

COUNT_SNAPSHOT = T.StructType(
    [
        T.StructField("objecttypecode", T.LongType()),
        T.StructField("count", T.LongType()),
        T.StructField("lastupdated", T.TimestampNTZType()),
    ]
)

RECORD_COUNT = T.StructType(
    [
        T.StructField("record_count", T.LongType()),
        T.StructField("last_updated", T.StringType()),
    ]
)

ENVIRONMENT = T.StructType(
    [
        T.StructField("last_updated", T.StringType()),
        T.StructField("endpoints", T.MapType(T.StringType(), T.StringType())),
        T.StructField("record_counts", T.MapType(T.StringType(), RECORD_COUNT)),
        T.StructField("entities", T.MapType(T.StringType(), DEFINITION)),
    ]
)

COUNTS_REPORT = T.StructType(
    [
        T.StructField("Entity", T.StringType()),
        T.StructField("LogicalName", T.StringType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Count", T.LongType()),
    ]
)


def envelope(record: T.DataType | None) -> T.StructType:
    """Schema of one page document; ``record=None`` keeps records as JSON text."""
    return T.StructType(
        [
            T.StructField(PAGE_NUMBER, T.LongType()),
            T.StructField(COUNT, T.LongType()),
            T.StructField(VALUE, T.ArrayType(record or T.StringType())),
            T.StructField(NEXT_LINK, T.StringType()),
            T.StructField(ERROR, ERROR_BODY),
        ]
    )
