"""JSON text that keeps every field and every digit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Without these, null fields vanish on writing and times lose their microseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
READ_OPTIONS = {key: value for key, value in JSON_OPTIONS.items() if key != "ignoreNullFields"}


def json_text(value: Column) -> Column:
    return F.to_json(value, JSON_OPTIONS)


def json_value(text: Column, schema: T.DataType | str) -> Column:
    return F.from_json(text, schema, READ_OPTIONS)
