"""Ranks in an order that need not be unique, over all rows or within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entitylake.functions.columns import named
from entitylake.functions.ordering import OrderBy, SortKey, sort_columns, sort_keys
from entitylake.session import materialized

PLACE, PART, TIE = "__place", "__part", "__tie"
# monotonically_increasing_id() has the partition above these bits and the row below.
ROW_BITS = 33


def ranked(df: DataFrame, order_by: OrderBy | None, out: str, group: str | None = None) -> DataFrame:
    """Add each row's rank from 1, within ``group`` if one is named; a group of null has none.

    The rows are dealt out to tasks by ranges of (group, order) and stored. A rank is the
    number of rows that the group has in earlier ranges, plus the row's place in its own
    range. Rows that the order does not tell apart are numbered first, so that even equal
    rows are spread over many ranges: no task gets a whole group, however large it is.
    """
    spark = df.sparkSession
    keys = [*([SortKey(group)] if group else []), *sort_keys(order_by), SortKey(TIE)]
    rows = df if group is None else df.filter(named(group).isNotNull())
    order = sort_columns(keys)
    ranges = (
        rows.withColumn(TIE, F.monotonically_increasing_id())
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
        .withColumn(PLACE, F.monotonically_increasing_id())
        .drop(TIE)
    )
    stored = materialized(ranges, "ranges").withColumn(PART, F.shiftright(PLACE, ROW_BITS))
    by = [group] if group else []
    sizes = stored.groupBy(*map(named, by), PART).agg(F.count("*").alias("__n"), F.min(PLACE).alias("__first"))
    # a row per range and group that meet
    earlier = F.sum("__n").over(W.partitionBy(*map(named, by)).orderBy(PART)) - F.col("__n")
    starts = sizes.select(*map(named, by), PART, (earlier + 1 - F.col("__first")).alias("__start"))
    joined = stored.join(starts, [*by, PART])
    return joined.select(*map(named, df.columns), (F.col(PLACE) + F.col("__start")).alias(out))
