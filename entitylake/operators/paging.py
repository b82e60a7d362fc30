"""Pages: cutting, envelopes, access to one page, unpaging, estimates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named, quote, time_literal
from entitylake.functions.ordering import OrderBy, SortKey, after_row, sort_columns, sort_keys
from entitylake.operators.documents import STATUS, data_only
from entitylake.operators.numbering import (
    BLOCK,
    GROUP,
    Blocks,
    cut_blocks,
    number_in_blocks,
    rows_of_blocks,
)
from entitylake.schemas import ENTITY, NEXT_LINK, PAGE_NUMBER, VALUE

# --- fixed values: page sizes ---------------------------------------------
PAGE_SIZE = 1000
UNSET_PAGE_SIZE = 5000
# --------------------------------------------------------------------------

POSITION = "position"


@dataclass(frozen=True)
class Paged:
    """One entity's rows with their page numbers, and how many pages there are."""

    rows: DataFrame
    blocks: Blocks
    size: int


def _page_of(position: Column, size: int) -> Column:
    return F.floor((position - 1) / F.lit(size)).cast("bigint") + 1


def _cut(df: DataFrame, order_by: OrderBy, size: int, rows_per_block: int | None, total: int | None) -> Paged:
    blocks = cut_blocks(df, order_by, align=size, rows_per_block=rows_per_block, total=total)
    rows = number_in_blocks(df, blocks, POSITION)
    return Paged(rows.withColumn(PAGE_NUMBER, _page_of(F.col(POSITION), size)), blocks, size)


def paginate(
    df: DataFrame,
    order_by: OrderBy,
    size: int = PAGE_SIZE,
    rows_per_block: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """Add ``page_number`` (from 1, ``size`` rows per page) and the row's ``position``."""
    return _cut(df, order_by, size, rows_per_block, total).rows.drop(GROUP, BLOCK)


def page_link(entity: Column, number: Column, pages: int) -> Column:
    """Link to the page after ``number``; null on the last page."""
    following = F.concat(entity, F.lit("?page="), (number + 1).cast("string"))
    return F.when(number < pages, following)


def all_pages(
    df: DataFrame,
    entity: str,
    order_by: OrderBy,
    size: int = PAGE_SIZE,
    rows_per_block: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """Every page as one envelope row: entity, page number, records, link.

    Blocks hold whole pages, so grouping by (group, block, page) stays in the tasks
    that numbered the rows: the records are shuffled once. An empty entity has
    one page without records.
    """
    blocks = cut_blocks(df, order_by, align=size, rows_per_block=rows_per_block, total=total)
    return pages_of_blocks(df, entity, blocks, size, 0, blocks.count).drop(BLOCK)


def pages_of_blocks(df: DataFrame, entity: str, blocks: Blocks, size: int, first: int, stop: int) -> DataFrame:
    """The envelopes of some consecutive blocks of a cut, in whole groups, with the block of each."""
    pages = -(-blocks.total // size)
    name, number = F.lit(entity), F.col(PAGE_NUMBER)
    fields = [BLOCK, name.alias(ENTITY), number, F.col(VALUE), page_link(name, number, max(1, pages)).alias(NEXT_LINK)]
    if blocks.total == 0:
        empty = df.sparkSession.range(1).select(F.lit(0).alias(BLOCK), F.lit(1).cast("bigint").alias(PAGE_NUMBER))
        return empty.withColumn(VALUE, F.array().cast(T.ArrayType(df.schema))).select(*fields)
    part = blocks.part(first, stop)
    # the numbers in a part start at its own first row
    rows = number_in_blocks(rows_of_blocks(df, blocks, first, stop), part, POSITION)
    rows = rows.withColumn(POSITION, F.col(POSITION) + first * blocks.size).withColumn(BLOCK, F.col(BLOCK) + first)
    record = F.struct(*[named(name) for name in df.columns])
    numbered = rows.withColumn(PAGE_NUMBER, _page_of(F.col(POSITION), size))
    # a task collects many pages at a time: items from a projection of their own are packed rows, those that
    # the aggregate makes itself are an object for every value
    items = numbered.select(GROUP, BLOCK, PAGE_NUMBER, F.struct(F.col(POSITION), record.alias("record")).alias("item"))
    in_order = F.sort_array(F.collect_list("item"))
    value = F.transform(in_order, lambda item: item["record"]).alias(VALUE)
    return items.groupBy(GROUP, BLOCK, PAGE_NUMBER).agg(value).select(*fields)


def page_links(df: DataFrame, entity: str, size: int = PAGE_SIZE) -> DataFrame:
    """Number, record count and link of every page. Only the rows' number is needed for it."""
    total = df.count()
    pages = max(1, -(-total // size))
    number = F.col(PAGE_NUMBER)
    return df.sparkSession.range(1, pages + 1).select(F.col("id").alias(PAGE_NUMBER)).select(
        number,
        F.least(F.lit(size), F.lit(total) - (number - 1) * size).cast("bigint").alias("n_records"),
        page_link(F.lit(entity), number, pages).alias("next_link"),
    )


def first_page(df: DataFrame, order_by: OrderBy, size: int = PAGE_SIZE) -> DataFrame:
    """The rows of page 1: a top-k, no page is numbered for it."""
    return df.orderBy(*sort_columns(sort_keys(order_by))).limit(size)


def next_page(
    df: DataFrame, order_by: OrderBy, last: Mapping[str, Any] | None, size: int = PAGE_SIZE
) -> DataFrame:
    """The page behind the row ``last`` (its sort key values): a filter and a top-k.

    ``last=None`` gives the first page. The filter reaches the scan, so the rows
    of earlier pages are skipped where the files are sorted.
    """
    if last is None:
        return first_page(df, order_by, size)
    keys = sort_keys(order_by)
    behind = after_row(keys, key_literals(df, keys, last), lead_is_null=last[keys[0].name] is None)
    return first_page(df.filter(behind), order_by, size)


def key_literals(df: DataFrame, keys: Sequence[SortKey], last: Mapping[str, Any]) -> list[Column]:
    """The sort key values of one row as literals of the columns' types."""
    return [_literal(df, key.name, last[key.name]) for key in keys]


# Instants leave and enter Spark as text with their offset: no client time zone is involved.
INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _literal(df: DataFrame, name: str, value: Any) -> Column:
    if isinstance(value, (date, datetime)):
        return time_literal(df, name, value)
    return F.lit(value).cast(df.schema[name].dataType)


def last_key(page: DataFrame, order_by: OrderBy) -> dict[str, Any] | None:
    """Sort key values of the last row of a page (one row), for ``next_page``."""
    keys = sort_keys(order_by)
    names = [key.name for key in keys]
    flipped = [
        named(key.name).asc_nulls_first() if key.descending else named(key.name).desc_nulls_last()
        for key in keys
    ]
    values = [
        F.date_format(named(name), INSTANT).alias(name)
        if isinstance(page.schema[name].dataType, T.TimestampType)
        else named(name)
        for name in names
    ]
    row = page.orderBy(*flipped).limit(1).select(*values).first()
    return None if row is None else dict(zip(names, row))


def data_pages(pages: DataFrame, strict: bool = False) -> DataFrame:
    """The pages that are data; others fail the job if ``strict``.

    Pages that were read have a status, and one that is cut off or has a single malformed field
    counts as no data as a whole. ``documents.quarantine`` gives the rest. Pages that were just
    made have no status.
    """
    return data_only(pages, strict, ("error", "corrupt")) if STATUS in pages.columns else pages


def unpage(pages: DataFrame, strict: bool = False) -> DataFrame:
    """Envelope rows to record rows; an empty page gives none, nor does one that is no data.

    Adds the page's entity and number (where present) and the row's position.
    """
    pages = data_pages(pages, strict)
    lead = [name for name in (ENTITY, PAGE_NUMBER) if name in pages.columns]
    fields = pages.schema[VALUE].dataType.elementType.fieldNames()
    rows = pages.select(*lead, F.posexplode(VALUE).alias(POSITION, "record"))
    kept = [name for name in (*lead, POSITION) if name not in fields]
    return rows.select(*kept, *[F.col(f"record.{quote(name)}").alias(name) for name in fields])


def records_of(pages: DataFrame, strict: bool = False) -> DataFrame:
    """Only the record columns of all pages that are data."""
    fields = pages.schema[VALUE].dataType.elementType.fieldNames()
    return unpage(pages, strict).select(*[named(name) for name in fields])


def estimated_pages(records: Column, size: int = PAGE_SIZE, mode: str = "ceil") -> Column:
    """Pages to expect: ``ceil``, ``floor_plus_one``, or the unrounded ``ratio``.

    ``floor_plus_one`` is one too many for exact multiples of the page size.
    """
    if mode == "ceil":
        return F.ceil(records / F.lit(size)).cast("bigint")
    if mode == "floor_plus_one":
        return F.floor(records / F.lit(size)).cast("bigint") + 1
    if mode == "ratio":
        return records / F.lit(float(size))
    raise ValueError(f"unknown estimate: {mode}")


def page_stats(pages: DataFrame, counts: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """Per entity: pages and records saved, against the estimate from ``counts``.

    ``counts`` has (entity, record_count). Sizes are taken per page before the
    shuffle, so no records move. Pages that are no data do not count as saved.
    """
    saved = (
        data_pages(pages).select(ENTITY, PAGE_NUMBER, F.size(VALUE).cast("bigint").alias("n"))
        .groupBy(ENTITY, PAGE_NUMBER)
        .agg(F.max("n").alias("n"))
        .groupBy(ENTITY)
        .agg(F.count("*").alias("pages"), F.sum("n").alias("records"))
    )
    expected = counts.select(
        ENTITY,
        F.col("record_count").alias("expected_records"),
        estimated_pages(F.col("record_count"), size).alias("expected_pages"),
    )
    return expected.join(saved, ENTITY, "left").na.fill(0, ["pages", "records"])
