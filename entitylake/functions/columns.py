"""Names and scalar functions used across the operators."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quote(name: str) -> str:
    """A column name with ``@``, ``.`` or blanks, safe for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(quote(name))


def split_names(names: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` as a list; empty for None or ``""``."""
    if not names:
        return []
    parts = names.split(",") if isinstance(names, str) else names
    return [part.strip() for part in parts if part.strip()]


def lowered(name: Column) -> Column:
    return F.lower(name)


def without_spaces(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit(""))


def part_of(text: Column, separator: str, position: int) -> Column:
    """The ``position``-th part (from 1) of a text, null past the end."""
    return F.try_element_at(F.split(text, f"\\Q{separator}\\E"), F.lit(position))


def text_or(text: Column, default: Column | str) -> Column:
    """The text, or ``default`` where it is null or empty."""
    other = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(text, F.lit("")), other)


def page_file(entity: Column, number: Column) -> Column:
    """Name of the file of one page in the one-file-per-page layout."""
    return F.format_string("%s_page_%d.json", entity, number)


# --- fixed values: notation of snapshot times ------------------------------
SNAPSHOT_TIME = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,6})?$"
SNAPSHOT_TIME_LENGTH = 26
# --------------------------------------------------------------------------


def parsed_time(text: Column) -> Column:
    """A snapshot time, with or without fraction; other text gives null.

    It has no zone, and is read without one: no clock change can shift it.
    """
    return F.when(text.rlike(SNAPSHOT_TIME), text.try_cast("timestamp_ntz"))


def printed_time(time: Column) -> Column:
    """A time in the notation of snapshots, always with six fraction digits."""
    text = time.cast("string")
    dotted = F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".")))
    return F.rpad(dotted, SNAPSHOT_TIME_LENGTH, "0")


def time_literal(df: DataFrame, column: str, value: date) -> Column:
    """``value`` in the very type of ``column``, so that comparisons reach the scan.

    For dates it is the first that is not before ``value``: a date lies before a time
    of its own day.
    """
    dtype = df.schema[column].dataType
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    text = value.isoformat(sep=" ")
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    if isinstance(dtype, T.DateType):
        late = value.replace(tzinfo=None) > datetime(value.year, value.month, value.day)
        return F.expr(f"DATE'{(value.date() + timedelta(days=late)).isoformat()}'")
    return F.expr(f"TIMESTAMP'{text}'")
