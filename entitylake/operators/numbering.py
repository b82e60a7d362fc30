"""Numbering rows in a global order without a global sort in one task.

``row_number()`` over an unpartitioned window sends every row to one task.
Here the order is first cut into blocks of a known, equal number of rows:

1. a Bernoulli sample of the sort keys gives fine bounds (at most ``MAX_BOUNDS``
   keys, more or less, reach the driver, whatever the table size). If the order is one
   column of whole numbers, dates, times or truth values, the pass that counts the rows gives
   the bounds as well, as quantiles of mergeable KLL sketches, and nothing is sampled;
2. one key-only pass counts the rows between the bounds, so the global rank of
   every bound is known;
3. one key-only pass, over the few gaps that hold a block end, finds the exact
   key at rank ``block``, ``2 * block``, ...

With those keys as literals, a row's block is a binary search, done in
generated code, and its number is ``block index * block + row_number()`` in the
block. The data itself is shuffled once. Blocks are equal however the keys are
distributed; they can be aligned to whole pages, so that pages never straddle
two tasks. All bounds are literals, hence a recomputed task gives the same rows
the same numbers.

Many small blocks are not cut one by one: consecutive ones make a group, of no more rows than
suit a task, only the ends of groups are searched for, and a task numbers all blocks of its group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named
from entitylake.functions.jsontext import json_text
from entitylake.functions.ordering import (
    OrderBy,
    SortKey,
    all_equal,
    literal_array,
    sort_columns,
    sort_keys,
    sorts_after,
    splittable,
)

BLOCK_BYTES = 128 << 20
# Less is not worth the passes that find where to cut.
LEAST_BYTES = 32 << 20
LEAST_ROWS = 100_000
MEASURED_ROWS = 1000
# Block ends are literals in the plan, so their number is bounded; beyond it blocks
# grow, and a task sorts more than BLOCK_BYTES, with spilling.
MAX_BLOCKS = 65_536
# More blocks than these are cut in groups, unless they are too large for it.
SINGLE_BLOCKS = 512
GROUPS = 256
MAX_BOUNDS = 4 * MAX_BLOCKS
# A KLL sketch of this size misses a rank by less than a thousandth of the rows, so its quantiles
# serve as bounds for blocks that are a few times as large.
SKETCH = 4096
QUANTILES = 1024
SKETCHED_BLOCKS = QUANTILES // 4
SKETCH_GROUPS = 64
GAP_BITS = 32
MOST_ROWS = (1 << 31) - 1  # what row_number() can count
BLOCK = "__block"
GROUP = "__block_group"


@dataclass(frozen=True)
class Blocks:
    """The cut of one DataFrame's order into blocks of ``size`` rows, ``grouped`` of them to a task.

    ``ends`` holds the last key of all groups but the last; with one block to a group, of all blocks.
    """

    keys: list[SortKey]
    total: int
    size: int
    ends: list[tuple[Any, ...]]
    grouped: int = 1

    @property
    def count(self) -> int:
        return max(1, ceil(self.total / self.size))

    @property
    def groups(self) -> int:
        return ceil(self.count / self.grouped)

    def parts(self, blocks_per_part: int) -> list[tuple[int, int]]:
        """Runs of blocks, first and stop, of about ``blocks_per_part`` in whole groups."""
        step = max(1, blocks_per_part // self.grouped) * self.grouped
        return [(first, min(first + step, self.count)) for first in range(0, self.count, step)]

    def part(self, first: int, stop: int) -> Blocks:
        """The blocks from ``first`` up to ``stop``, whole groups, as a cut of their own rows."""
        self._whole_groups(first, stop)
        rows = min(self.total, stop * self.size) - first * self.size
        ends = self.ends[first // self.grouped : ceil(stop / self.grouped) - 1]
        return Blocks(self.keys, rows, self.size, ends, self.grouped)

    def end_before(self, block: int) -> tuple[Any, ...]:
        """The last key before ``block``, the first one of a group."""
        self._whole_groups(block, self.count)
        return self.ends[block // self.grouped - 1]

    def _whole_groups(self, first: int, stop: int) -> None:
        if first % self.grouped or (stop % self.grouped and stop != self.count):
            raise ValueError(f"blocks {first} to {stop} are not whole groups of {self.grouped}")


def key_columns(df: DataFrame, keys: Sequence[SortKey]) -> list[tuple]:
    return [splittable(key.name, df.schema[key.name].dataType) for key in keys]


def renamed(keys: Sequence[SortKey], names: Sequence[str]) -> list[SortKey]:
    return [SortKey(name, key.descending) for key, name in zip(keys, names)]


def with_position(
    df: DataFrame,
    keys: Sequence[SortKey],
    columns: Sequence[tuple],
    bounds: Sequence[tuple],
    out: str,
    by_leading: bool = False,
) -> DataFrame:
    """Add the number of bounds that sort strictly before each row (binary search).

    A halving step meets one of the bounds at odd multiples of its width, and only these are in
    its literals, so that the plan holds every bound once, or twice. The bound is a projection of its own, and
    so is the step: Spark keeps them apart, as each is used more than once, and compiles them together.
    Do not filter or join on the result: Spark would unfold all steps into the
    condition.

    ``by_leading`` searches by as many leading columns as tell the bounds apart; of all bounds, only the next
    one can then have the values of the row in them, and it is compared with by all columns at the end. It is for
    rows that have more than keys: their steps become a single method, which is slow if it is large. Rows
    of keys alone have a method for every step, as long as the step compares all columns.
    """
    at = [f"{out}_at{i}" for i in range(len(columns))]
    collations = _collations(df, keys)

    def moved(df: DataFrame, width: int, picked: Sequence[tuple], spot: Column, step: int) -> DataFrame:
        found = {
            name: F.get(literal_array([bound[i] for bound in picked], element, text), spot)
            for i, (name, (_, element, text)) in enumerate(zip(at[:width], columns))
        }
        found |= {name: F.collate(found[name], how) for name, how in zip(at[:width], collations) if how}
        values = [col for col, _, _ in columns[:width]]
        behind = (F.col(out) + step <= len(bounds)) & sorts_after(keys[:width], values, list(map(F.col, at[:width])))
        return df.withColumns(found).withColumn(out, F.when(behind, F.col(out) + step).otherwise(F.col(out)))

    # where a collation decides what is equal, all columns are needed
    leading = _telling_apart(bounds, len(keys)) if by_leading and not any(collations) else len(keys)
    df = df.withColumn(out, F.lit(0))
    for step in (1 << i for i in reversed(range(len(bounds).bit_length()))):
        df = moved(df, leading, bounds[step - 1 :: 2 * step], F.shiftright(F.col(out), step.bit_length()), step)
    if bounds and leading < len(columns):
        # not the bare column, for which Spark would put the literals into every comparison
        df = moved(df, len(columns), bounds, F.least(F.col(out), F.lit(len(bounds) - 1)), 1)
    return df.drop(*at)


def _collations(df: DataFrame, keys: Sequence[SortKey]) -> list[str | None]:
    """The collation of each sort column, if it is text in another one than the usual."""
    types = [df.schema[key.name].dataType for key in keys]
    own = [dtype.collation if isinstance(dtype, T.StringType) else None for dtype in types]
    return [None if how == T.StringType().collation else how for how in own]


def _telling_apart(bounds: Sequence[tuple], most: int) -> int:
    """How many leading columns are enough to tell the bounds, given in order, from each other."""
    shared = 0
    for one, other in zip(bounds, bounds[1:]):
        # a NaN equals a NaN in Spark
        alike = [x == y or (x != x and y != y) for x, y in zip(one, other)]
        shared = max(shared, alike.index(False) if False in alike else len(alike))
    return min(shared + 1, most)


def cut_blocks(
    df: DataFrame,
    order_by: OrderBy,
    align: int = 1,
    rows_per_block: int | None = None,
    total: int | None = None,
) -> Blocks:
    """Cut the order of ``df`` into equal blocks of a multiple of ``align`` rows.

    Without ``rows_per_block``, blocks are sized by the width of the rows and by
    the cores. More than ``SINGLE_BLOCKS`` smaller ones make ``GROUPS`` groups, or more if groups would be larger
    than such blocks. ``order_by`` must be unique. ``total`` saves a pass if the row count is known.
    The keys are read up to four times, three if sketches give the bounds, so an expensive ``df`` should be stored
    first (``session.materialized``).
    """
    keys = sort_keys(order_by)
    if not keys:
        raise ValueError("numbering needs an explicit, unique order_by")
    quantiles = None
    if total is None:
        columns = key_columns(df, keys)
        if len(columns) == 1 and columns[0][1] == "bigint":
            total, quantiles = _count_with_quantiles(df.select(columns[0][0].alias("k0")), keys[0].descending)
        else:
            total = df.count()
    target = max(rows_per_block or _rows_per_block(df, total), ceil(total / MAX_BLOCKS))
    size = max(1, ceil(target / align)) * align
    if min(size, total) > MOST_ROWS:
        raise ValueError(f"a block of {size} rows is more than can be numbered")
    blocks, grouped = max(1, ceil(total / size)), 1
    if rows_per_block and blocks > SINGLE_BLOCKS:
        grouped = max(1, min(ceil(blocks / GROUPS), _rows_per_block(df, total) // size, MOST_ROWS // size))
    groups = ceil(blocks / grouped)
    if groups == 1:
        return Blocks(keys, total, size, [], grouped)

    columns = key_columns(df, keys)
    names = [f"k{i}" for i in range(len(keys))]
    plain = df.select(*[col.alias(name) for (col, _, _), name in zip(columns, names)])
    plain_keys = renamed(keys, names)
    plain_columns = [(F.col(name), element, text) for name, (_, element, text) in zip(names, columns)]

    sketched = quantiles and groups <= SKETCHED_BLOCKS
    bounds = quantiles if sketched else _sample_bounds(plain, plain_keys, groups, total)
    found = with_position(plain, plain_keys, plain_columns, bounds, "gap")
    counts = {row["gap"]: row["n"] for row in found.groupBy("gap").agg(F.count("*").alias("n")).collect()}
    if sum(counts.values()) != total:
        raise ValueError("the rows changed, or total is not their number")

    wanted = _ranks_in_gaps(counts, [size * grouped * i for i in range(1, groups)])
    if any(counts[gap] > MOST_ROWS for gap in wanted):
        raise ValueError("the sample left a gap with more rows than can be numbered")
    return Blocks(keys, total, size, _keys_at(found, plain_keys, names, wanted), grouped)


def _count_with_quantiles(keys: DataFrame, descending: bool) -> tuple[int, list[tuple]]:
    """The number of rows and evenly spread values of ``k0``, in order, in one pass.

    Sketches of the tasks are merged in groups first, so that no task merges all of them.
    Nulls are in no sketch. There are no quantiles if there is no value, or if among many values
    one is so frequent that it comes twice; the sample then shows whether the order is unique.
    """
    ranks = F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES)])
    parts = (
        keys.withColumn("part", F.spark_partition_id() % SKETCH_GROUPS)
        .groupBy("part")
        .agg(
            F.count("*").alias("n"), F.count("k0").alias("n_values"),
            F.kll_sketch_agg_bigint("k0", F.lit(SKETCH)).alias("sketch"),
        )
        .withColumn("sketch", F.when(F.col("n_values") > 0, F.col("sketch")))
    )
    whole = parts.agg(
        F.sum("n").alias("n"), F.sum("n_values").alias("n_values"),
        F.kll_merge_agg_bigint("sketch", F.lit(SKETCH)).alias("sketch"),
    )
    found = F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_bigint("sketch", ranks))
    row = whole.select("n", "n_values", found.alias("quantiles")).first()
    values = sorted(set(row["quantiles"] or ()), reverse=descending)
    if (row["n_values"] or 0) >= 2 * QUANTILES and len(values) < QUANTILES - 1:
        values = []
    return row["n"] or 0, [(value,) for value in values]


def _rows_per_block(df: DataFrame, total: int) -> int:
    """Rows of about ``BLOCK_BYTES``, fewer if there would be less than a block for every core.

    No fewer than ``LEAST_BYTES`` hold. The width is that of the first rows as JSON text.
    """
    if total <= LEAST_ROWS:
        return LEAST_ROWS
    first = df.limit(MEASURED_ROWS).select(F.octet_length(json_text(F.struct(*map(named, df.columns)))).alias("n"))
    width = first.agg(F.avg("n")).first()[0] or 1
    fair = max(LEAST_ROWS, ceil(LEAST_BYTES / width), ceil(total / df.sparkSession.sparkContext.defaultParallelism))
    return max(1, min(fair, int(BLOCK_BYTES / width)))


def _sample_bounds(plain: DataFrame, keys: Sequence[SortKey], blocks: int, total: int) -> list[tuple]:
    per_block = min(16, max(4, MAX_BOUNDS // blocks))
    # of a random sample there may be a few more keys than asked for
    fraction = min(1.0, blocks * per_block / total)
    rows = (
        plain.sample(fraction=fraction, seed=17)
        .orderBy(*sort_columns(keys))
        .select(*collectable(plain, [key.name for key in keys]))
        .collect()
    )
    bounds = [tuple(row) for row in rows]
    for one, other in zip(bounds, bounds[1:]):
        if one == other:
            raise ValueError(f"order_by is not unique: {one} occurs more than once")
    return bounds


def _ranks_in_gaps(counts: dict[int, int], ranks: Sequence[int]) -> dict[int, list[int]]:
    """For each gap that holds one of the (ascending) global ranks: the ranks within the gap."""
    wanted: dict[int, list[int]] = {}
    before, pending = 0, list(ranks)
    for gap in sorted(counts):
        while pending and pending[0] <= before + counts[gap]:
            wanted.setdefault(gap, []).append(pending.pop(0) - before)
        before += counts[gap]
    return wanted


def _keys_at(
    gaps: DataFrame, keys: Sequence[SortKey], names: Sequence[str], wanted: dict[int, list[int]]
) -> list[tuple]:
    """The keys at the wanted ranks of the wanted gaps; at most ``MAX_BLOCKS`` of them.

    The gap passes through a generator, which keeps the filter from being
    pushed into the search.
    """
    gaps = gaps.select(*names, F.explode(F.array("gap")).alias("gap"))
    in_gap = W.partitionBy("gap").orderBy(*sort_columns(keys))
    spots = [(gap << GAP_BITS) + rank for gap, ranks in wanted.items() for rank in ranks]
    spot = F.shiftleft(F.col("gap").cast("bigint"), GAP_BITS) + F.col("rank")
    rows = (
        gaps.filter(F.col("gap").isin(list(wanted)))
        .withColumn("rank", F.row_number().over(in_gap))
        .filter(spot.isin(spots))
        .select("gap", "rank", *collectable(gaps, names))
        .collect()
    )
    if len(rows) != len(spots):
        raise ValueError("the rows changed while they were numbered")
    return [tuple(row[name] for name in names) for row in sorted(rows, key=lambda r: (r["gap"], r["rank"]))]


def collectable(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Key columns for collecting: times as text, so that no client time zone is involved."""
    types = {field.name: field.dataType.typeName() for field in df.schema.fields}
    return [
        F.col(name).cast("string").alias(name) if types[name] == "timestamp_ntz" else F.col(name)
        for name in names
    ]


def with_group(df: DataFrame, blocks: Blocks) -> DataFrame:
    """Add the index of each row's group of blocks, and make every group one partition.

    Groups go to partitions by their index; by a hash, some tasks would get
    several of them and others none.

    A single group is treated alike, though its index is computed as zero from a
    key and there is an empty second partition. With a constant, and so a single
    partition per entity, Spark would run a union of many entities in one task.
    """
    if blocks.ends:
        wide = len(df.columns) > len(blocks.keys)
        marked = with_position(df, blocks.keys, key_columns(df, blocks.keys), blocks.ends, GROUP, by_leading=wide)
    else:
        zero = F.xxhash64(named(blocks.keys[0].name)).bitwiseAND(F.lit(0)).cast("int")
        marked = df.withColumn(GROUP, zero)
    return marked.repartitionById(max(2, blocks.groups), F.col(GROUP))


def rows_of_blocks(df: DataFrame, blocks: Blocks, first: int, stop: int) -> DataFrame:
    """The rows of the blocks from ``first`` up to ``stop``, whole groups.

    The leading key is bounded on its own as well, so that a scan of sorted files skips the rest.
    """
    columns = key_columns(df, blocks.keys)
    values, lead = [col for col, _, _ in columns], blocks.keys[0]

    def behind(end: tuple) -> Column:
        return sorts_after(blocks.keys, values, key_literals(columns, end))

    def lead_at(end: tuple, later: bool) -> Column:
        if end[0] is None:
            return F.lit(True)
        bound = key_literals(columns, end)[0]
        if later == lead.descending:  # null sorts lowest
            return (values[0] <= bound) | values[0].isNull()
        return values[0] >= bound

    if first > 0:
        end = blocks.end_before(first)
        df = df.filter(lead_at(end, True) & behind(end))
    if stop < blocks.count:
        end = blocks.end_before(stop)
        df = df.filter(lead_at(end, False) & ~behind(end))
    return df


def key_literals(columns: Sequence[tuple], key: Sequence[Any]) -> list[Column]:
    """One key as literals to compare with the stand-ins of its columns."""
    return [F.get(literal_array([value], element, text), F.lit(0)) for value, (_, element, text) in zip(key, columns)]


def stored_key(df: DataFrame, keys: Sequence[SortKey], key: Sequence[Any]) -> list[Any]:
    """A collected key as JSON can hold it; as the end of a block it compares as before."""
    return [None if value is None else text(value) for value, (_, _, text) in zip(key, key_columns(df, keys))]


def keys_by_block(spark: SparkSession, df: DataFrame, blocks: Blocks) -> DataFrame:
    """``(block, k0, k1, ...)``: the last key of every block but the last, as it is compared with.

    Within groups the cut does not know it: it is found by a pass over the keys.
    """
    if blocks.grouped > 1:
        numbered = number_in_blocks(df.select(*[named(key.name) for key in blocks.keys]), blocks, "__number")
        last = (F.col("__number") % blocks.size == 0) & (F.col(BLOCK) < blocks.count - 1)
        ends = [col.alias(f"k{i}") for i, (col, _, _) in enumerate(key_columns(df, blocks.keys))]
        return numbered.filter(last).select(F.col(BLOCK).alias("block"), *ends)
    numbers = spark.range(0, len(blocks.ends), 1, 1).select(F.col("id").cast("int").alias("block"))
    arrays = [
        F.get(literal_array([end[i] for end in blocks.ends], element, text), F.col("block")).alias(f"k{i}")
        for i, (_, element, text) in enumerate(key_columns(df, blocks.keys))
    ]
    return numbers.select("block", *arrays)


def compared_key(spark: SparkSession, schema: T.StructType, keys: Sequence[SortKey], key: Sequence[Column]) -> list[Column]:
    """One key, given by literals, as literals to compare with those of ``keys_by_block``."""
    one = spark.range(1).select(*[value.cast(schema[k.name].dataType).alias(k.name) for k, value in zip(keys, key)])
    columns = key_columns(one, keys)
    names = [f"k{i}" for i in range(len(keys))]
    plain = one.select(*[col.alias(name) for (col, _, _), name in zip(columns, names)])
    row = plain.select(*collectable(plain, names)).first()
    return key_literals(columns, tuple(row))


def number_in_blocks(df: DataFrame, blocks: Blocks, out: str) -> DataFrame:
    """Number the rows of ``df`` from 1; adds the index of the block, and that of the group, by which they are partitioned.

    Equal sort keys would leave their order, and with it the numbers, to chance
    when a task is repeated. They are adjacent here, so they are found for free
    and fail the job.
    """
    in_group = W.partitionBy(GROUP).orderBy(*sort_columns(blocks.keys))
    values = [named(key.name) for key in blocks.keys]
    rank = F.row_number().over(in_group)
    repeated = (rank > 1) & all_equal([F.lag(value).over(in_group) for value in values], values)
    number = F.col(GROUP) * F.lit(blocks.grouped * blocks.size).cast("bigint") + rank
    names = ", ".join(key.name for key in blocks.keys)
    numbered = with_group(df, blocks).withColumn(
        out, F.when(repeated, F.raise_error(F.lit(f"order_by is not unique: {names}"))).otherwise(number)
    )
    if blocks.grouped == 1:
        return numbered.withColumn(BLOCK, F.col(GROUP))
    return numbered.withColumn(BLOCK, F.floor((F.col(out) - 1) / F.lit(blocks.size)).cast("int"))


def number_rows(
    df: DataFrame,
    order_by: OrderBy,
    out: str = "row_number",
    rows_per_block: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """Add the position of each row in ``order_by``, from 1."""
    blocks = cut_blocks(df, order_by, rows_per_block=rows_per_block, total=total)
    return number_in_blocks(df, blocks, out).drop(GROUP, BLOCK)
