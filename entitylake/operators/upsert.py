"""Keyed tables: last row wins, upsert, skip what is done, freshness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entitylake.functions.columns import named, time_literal
from entitylake.functions.ordering import OrderBy, SortKey, sort_keys


def last_wins(df: DataFrame, keys: Sequence[str], arrival: OrderBy) -> DataFrame:
    """One row per key: the last in the order ``arrival`` (which must be total).

    Spark cuts the groups to one row before the shuffle as well as after it
    (``WindowGroupLimit``), so a key with very many rows is no hot spot.
    """
    latest_first = [SortKey(key.name, not key.descending) for key in sort_keys(arrival)]
    newest = W.partitionBy(*[named(key) for key in keys]).orderBy(*[key.column() for key in latest_first])
    return df.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")


def upsert(
    base: DataFrame, rows: DataFrame, keys: Sequence[str], arrival: OrderBy | None = None, unique: Sequence[str] | None = None
) -> DataFrame:
    """``rows`` replace rows of ``base`` with the same key; all other keys are kept.

    Of several rows with equal ``unique`` columns (default: the key) the last wins, in the order ``arrival`` or, without
    one, in the order in which the rows come. Null is a key like any other.
    """
    if arrival is None:
        numbered = rows.withColumn("__arrival", F.monotonically_increasing_id())
        newest = last_wins(numbered, unique or keys, "__arrival").drop("__arrival")
    else:
        newest = last_wins(rows, unique or keys, arrival)
    return skip_done(base, newest, keys).unionByName(newest)


def skip_done(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``work`` whose key is not in ``done``; null counts as a key."""
    done_keys = done.select(*[named(key).alias(f"__k{i}") for i, key in enumerate(keys)]).distinct()
    same = [named(key).eqNullSafe(F.col(f"__k{i}")) for i, key in enumerate(keys)]
    return work.join(done_keys, reduce(lambda a, b: a & b, same), "left_anti")


def fresh_rows(df: DataFrame, column: str, as_of: datetime, ttl: timedelta) -> DataFrame:
    """Rows not older than ``ttl``; a row of exactly that age is still fresh."""
    return df.filter(named(column) >= time_literal(df, column, as_of - ttl))


def stale_rows(df: DataFrame, column: str, as_of: datetime, ttl: timedelta) -> DataFrame:
    """The complement of ``fresh_rows``; a row without a time is stale."""
    limit = time_literal(df, column, as_of - ttl)
    return df.filter(named(column).isNull() | (named(column) < limit))
