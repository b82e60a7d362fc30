"""Shape of rows: flattening, keep-lists, annotation columns, maps, unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named, quote
from entitylake.schemas import ENTITY


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found = []
    for item in schema.fields:
        here = (*path, item.name)
        found += _leaves(item.dataType, here) if isinstance(item.dataType, T.StructType) else [here]
    return found


def flatten(df: DataFrame) -> DataFrame:
    """Structs at any depth to columns with dotted names; arrays stay arrays."""
    return df.select(
        *[F.col(".".join(quote(part) for part in path)).alias(".".join(path)) for path in _leaves(df.schema)]
    )


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an error."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise KeyError(f"no such columns: {', '.join(missing)}")
    return df.select(*[named(name) for name in names])


def annotated(df: DataFrame, formatted: Mapping[str, Column], term: str = "FormattedValue") -> DataFrame:
    """Add ``<column>@<term>`` columns, such as the printed form of a code."""
    return df.select("*", *[text.alias(f"{name}@{term}") for name, text in formatted.items()])


def annotations(df: DataFrame, include: bool) -> DataFrame:
    """Keep (``include``) or drop the annotation columns, those with ``@`` in the name."""
    return df if include else df.select(*[named(name) for name in df.columns if "@" not in name])


def map_rows(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """One row per entry of a map column; the other columns are repeated."""
    others = [named(name) for name in df.columns if name != column]
    return df.select(*others, F.explode(named(column)).alias(key, value))


def union_entities(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Entities with different columns in one frame, named in ``entity``.

    A column that an entity lacks is null in its rows.
    """
    tagged = [df.select(F.lit(name).alias(ENTITY), "*") for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def only_entities(df: DataFrame, names: Sequence[str], column: str = ENTITY) -> DataFrame:
    """Rows of the named entities; prunes directories where ``column`` partitions the files."""
    return df.filter(named(column).isin(list(names)))
