"""CSV files with a header: work lists and reports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named

# Quotes are doubled, as spreadsheet programs do; line breaks may occur in quotes.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


# Line breaks in texts as two characters each; a backslash is always the first of two.
ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def _texts(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    def changed(name: str) -> Column:
        return reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), pairs, named(name)).alias(name)

    kinds = {item.name: item.dataType for item in df.schema.fields}
    return df.select(*[changed(name) if isinstance(kinds[name], T.StringType) else named(name) for name in df.columns])


def write_csv(df: DataFrame, path: str, escaped: bool = False) -> None:
    """Save a report; texts keep their outer blanks, times their microseconds.

    ``escaped`` writes every record in one line, line breaks in texts escaped.
    """
    df = _texts(df, ESCAPES) if escaped else df
    writer = df.write.mode("overwrite").options(header=True, quote='"', escape='"')
    writer = writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, escaped: bool = False) -> DataFrame:
    """Read typed columns. An empty text reads back as null: the format knows no difference.

    A file may have line breaks in quotes, and so is read by one task; files written with
    ``escaped`` have none, and large ones are split.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", not escaped)
    rows = reader.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    return _texts(rows, [(text, plain) for plain, text in reversed(ESCAPES)]) if escaped else rows
