"""The first rows in an order, however many: found by their keys, without storing or sorting the others.

The key at the wanted rank is found in passes over the keys alone: a sample gives bounds, a count
between them names the gap that holds the rank, and the gap is cut again until one task can number
what is left of it. With that key as a literal, what is kept is a filter, which the scan can use. Only of the rows that
share the last key, and so may be kept or not, a number is counted off.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entitylake.functions.columns import named
from entitylake.functions.ordering import SortKey, all_equal, literal_array, sort_columns, sorts_after
from entitylake.operators.numbering import collectable, key_columns, key_literals, renamed, with_position
from entitylake.operators.ranking import ranked

BOUNDS = 1024
# Keys that one task numbers.
GAP_ROWS = 200_000


def key_at(df: DataFrame, keys: Sequence[SortKey], rank: int, gap_rows: int = GAP_ROWS) -> tuple[tuple[Any, ...], int, int] | None:
    """The key of the row at ``rank`` (from 1), how many rows sort before it, and how many have it.

    None if there are fewer rows. Keys may repeat; a key that very many rows have is told from a count.
    """
    names = [f"k{i}" for i in range(len(keys))]
    columns = key_columns(df, keys)
    plain = df.select(*[col.alias(name) for (col, _, _), name in zip(columns, names)])
    order = renamed(keys, names)
    columns = [(F.col(name), element, text) for name, (_, element, text) in zip(names, columns)]
    values, before, total = [F.col(name) for name in names], 0, plain.count()
    if total < rank:
        return None
    while total > gap_rows:
        bounds = _bounds(plain, order, names, min(1.0, BOUNDS / total))
        if not bounds:
            break
        arrays = with_position(plain, order, columns, bounds, "gap")
        # rows of a gap are behind its lower bound and up to its upper one; those at the upper one are counted apart
        last = [F.get(bound, F.col("gap")) for bound in _arrays(columns, bounds)]
        counted = arrays.groupBy("gap").agg(
            F.count("*").alias("n"), F.count_if((F.col("gap") < len(bounds)) & all_equal(values, last)).alias("at_end")
        )
        sizes = {row["gap"]: (row["n"], row["at_end"]) for row in counted.collect()}
        for gap in sorted(sizes):
            n, at_end = sizes[gap]
            if before + n >= rank:
                break
            before += n
        if before + n - at_end < rank:
            return bounds[gap], before + n - at_end, at_end
        if gap > 0:
            plain = plain.filter(sorts_after(order, values, key_literals(columns, bounds[gap - 1])))
        if gap < len(bounds):
            end = key_literals(columns, bounds[gap])
            plain = plain.filter(~sorts_after(order, values, end) & ~all_equal(values, end))
        if n - at_end == total:
            break
        total = n - at_end
    upto = F.sum("n").over(W.orderBy(*sort_columns(order)))
    found = plain.groupBy(*names).agg(F.count("*").alias("n")).withColumn("upto", upto)
    row = found.filter(F.col("upto") >= rank - before).orderBy("upto").limit(1).select(*collectable(found, names), "n", "upto").first()
    return tuple(row[name] for name in names), before + row["upto"] - row["n"], row["n"]


def _bounds(plain: DataFrame, order: Sequence[SortKey], names: Sequence[str], fraction: float) -> list[tuple]:
    """Different keys of a sample, in order; ``BOUNDS`` of them, more or less."""
    sample = plain.sample(fraction=fraction, seed=23).distinct().orderBy(*sort_columns(order))
    return [tuple(row) for row in sample.select(*collectable(plain, names)).collect()]


def _arrays(columns: Sequence[tuple], bounds: Sequence[tuple]) -> list[Column]:
    return [literal_array([bound[i] for bound in bounds], element, text) for i, (_, element, text) in enumerate(columns)]


def first_rows(df: DataFrame, keys: Sequence[SortKey], count: int, gap_rows: int = GAP_ROWS) -> DataFrame:
    """The first ``count`` rows in the order ``keys``, in no order; of rows that it does not tell apart, any."""
    found = key_at(df, keys, count, gap_rows)
    if found is None:
        return df
    key, before, same = found
    columns = key_columns(df, keys)
    values, end = [col for col, _, _ in columns], key_literals(columns, key)
    behind, equal = sorts_after(keys, values, end), all_equal(values, end)
    if before + same == count:
        return df.filter(~behind)
    some = ranked(df.filter(equal), [], "__rank").filter(F.col("__rank") <= count - before)
    return df.filter(~behind & ~equal).union(some.select(*map(named, df.columns)))
