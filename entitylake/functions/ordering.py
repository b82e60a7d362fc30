"""Sort keys: parsing, Spark sort order, and comparison against literal bounds.

Null sorts lowest, so first in ascending and last in descending order. That is
Spark's own default; it is spelled out wherever rows are compared by hand.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named


@dataclass(frozen=True)
class SortKey:
    name: str
    descending: bool = False

    def column(self) -> Column:
        col = named(self.name)
        return col.desc_nulls_last() if self.descending else col.asc_nulls_first()


OrderBy = str | SortKey | Iterable["str | SortKey"]


def sort_keys(order_by: OrderBy | None) -> list[SortKey]:
    """``"a desc, b"``, ``["a desc", "b"]`` or SortKeys as a list of SortKeys."""
    if not order_by:
        return []
    if isinstance(order_by, SortKey):
        return [order_by]
    if isinstance(order_by, str):
        order_by = order_by.split(",")
    keys = []
    for item in order_by:
        if isinstance(item, SortKey):
            keys.append(item)
            continue
        words = item.split()
        direction = words[1].lower() if len(words) == 2 else "asc"
        if len(words) not in (1, 2) or direction not in ("asc", "desc"):
            raise ValueError(f"not a sort key: {item!r}")
        keys.append(SortKey(words[0], direction == "desc"))
    return keys


def sort_columns(keys: Sequence[SortKey]) -> list[Column]:
    return [key.column() for key in keys]


def _after(key: SortKey, value: Column, bound: Column) -> Column:
    if key.descending:
        return bound.isNotNull() & (value.isNull() | (value < bound))
    return value.isNotNull() & (bound.isNull() | (value > bound))


def sorts_after(keys: Sequence[SortKey], values: Sequence[Column], bounds: Sequence[Column]) -> Column:
    """True where the row ``values`` comes strictly after the row ``bounds``."""
    triples = list(zip(keys, values, bounds))
    key, value, bound = triples[-1]
    result = _after(key, value, bound)
    for key, value, bound in reversed(triples[:-1]):
        result = _after(key, value, bound) | (value.eqNullSafe(bound) & result)
    return result


def after_row(keys: Sequence[SortKey], last: Sequence[Column], lead_is_null: bool = False) -> Column:
    """Filter for the rows behind ``last``, one literal per sort key.

    The leading key is tested on its own as well: that conjunct is a plain
    comparison, which the scan can use to skip row groups.
    """
    values = [named(key.name) for key in keys]
    strict = sorts_after(keys, values, last)
    if lead_is_null:
        return strict
    if keys[0].descending:
        coarse = (values[0] <= last[0]) | values[0].isNull()
    else:
        coarse = values[0] >= last[0]
    return coarse & strict


# A sort column in a form that survives the way through a JSON literal: the
# column to compare, the element type, and the text of one collected value.
Splittable = tuple[Column, str, Callable[[Any], Any]]


def _ntz_text(value: str) -> str:
    whole, _, fraction = value.partition(".")
    return f"{whole}.{fraction:0<6}"


def splittable(name: str, dtype: T.DataType) -> Splittable:
    """An order-preserving stand-in for a sort column; see ``Splittable``."""
    col = named(name)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col.cast("bigint"), "bigint", lambda v: v
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.cast("double"), "double", lambda v: v
    if isinstance(dtype, T.DecimalType):
        return col, dtype.simpleString(), str
    if isinstance(dtype, T.BooleanType):
        return col.cast("bigint"), "bigint", lambda v: v
    if isinstance(dtype, T.StringType):
        return col, "string", lambda v: v
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("bigint"), "bigint", lambda v: v
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col), "bigint", lambda v: v
    if isinstance(dtype, T.TimestampNTZType):
        return col, "timestamp_ntz", _ntz_text
    if isinstance(dtype, T.BinaryType):
        return F.hex(col), "string", lambda v: v
    raise TypeError(f"cannot number rows by column {name!r} of type {dtype.simpleString()}")


def literal_array(values: Sequence[Any], element: str, text: Callable[[Any], Any]) -> Column:
    """Collected values as one array literal (a constant after planning)."""
    body = json.dumps([None if value is None else text(value) for value in values])
    options = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    return F.from_json(F.lit(body), f"array<{element}>", options)


def all_equal(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])
