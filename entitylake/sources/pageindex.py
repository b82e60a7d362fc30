"""A page lake with an index: a directory per block of pages, and a table of what each block holds.

``entity=<name>/block=<n>`` has the pages of one block, about as much as one task sorts. The index
of an entity is a table below ``_index`` with a row per block: its directory, its first and last
page, and the last key in it, so that a page, or the page behind a key, is found by reading one
or two directories; the rest of the entity is not even listed. All of it comes from the cut that
numbered the rows, so the index costs no pass over the data, but where many small blocks were cut in
groups one over the keys. Readers that know nothing of the index
read the same lake.

The index is removed before its entity is written again and written last: an entity with an index
is whole.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.jsontext import json_text
from entitylake.functions.ordering import OrderBy, after_row, sort_keys, sorts_after
from entitylake.operators.numbering import BLOCK, Blocks, compared_key, cut_blocks, keys_by_block
from entitylake.operators.paging import PAGE_SIZE, first_page, key_literals, pages_of_blocks, records_of
from entitylake.schemas import ENTITY, NEXT_LINK, PAGE_NUMBER, VALUE
from entitylake.sources.files import Files, escaped
from entitylake.sources.pages import BLOCK_DIR, LINE, load_pages, no_pages

INDEX = "_index"
# What one job writes: a stop loses at most so much of an entity (512 GB by the usual block size).
BLOCKS_PER_JOB = 4096


def _folder(spark: SparkSession, entity: str) -> str:
    return f"{ENTITY}={escaped(spark, entity)}"


def clear_entity(spark: SparkSession, path: str, entity: str) -> None:
    """Remove an entity from the lake, its index first."""
    lake, folder = Files(spark, path), _folder(spark, entity)
    lake.remove(f"{INDEX}/{folder}")
    lake.remove(folder)


def write_blocks(df: DataFrame, entity: str, blocks: Blocks, path: str, size: int, first: int, stop: int) -> None:
    """Write the pages of the blocks from ``first`` up to ``stop``; they replace only themselves."""
    envelopes = pages_of_blocks(df, entity, blocks, size, first, stop)
    body = json_text(F.struct(PAGE_NUMBER, VALUE, F.col(f"`{NEXT_LINK}`")))
    lines = envelopes.select(F.col(BLOCK).alias(BLOCK_DIR), body.alias(LINE))
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BLOCK_DIR)
    writer.text(f"{path.rstrip('/')}/{_folder(df.sparkSession, entity)}")


def write_index(df: DataFrame, entity: str, blocks: Blocks, path: str, size: int) -> None:
    """Write the index of an entity whose blocks have all been written."""
    spark = df.sparkSession
    folder, per_block = _folder(spark, entity), blocks.size // size
    block = F.col("block").cast("bigint")
    pages = max(1, -(-blocks.total // size))
    rows = spark.range(0, blocks.count, 1, 1).select(F.col("id").cast("int").alias("block"))
    rows.join(keys_by_block(spark, df, blocks), "block", "left").coalesce(1).select(
        "*",
        F.concat(F.lit(f"{folder}/{BLOCK_DIR}="), F.col("block").cast("string")).alias("directory"),
        (block * per_block + 1).alias("first_page"),
        F.least((block + 1) * per_block, F.lit(pages)).alias("last_page"),
        F.lit(blocks.size).cast("bigint").alias("block_rows"),
        (F.col("block") == blocks.count - 1).alias("is_last"),
        F.lit(blocks.total).cast("bigint").alias("records"),
    ).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{INDEX}/{folder}")


def save_entity(
    df: DataFrame,
    entity: str,
    order_by: OrderBy,
    path: str,
    size: int = PAGE_SIZE,
    rows_per_block: int | None = None,
    blocks_per_job: int = BLOCKS_PER_JOB,
) -> Blocks:
    """Save all pages of an entity with their index; what the lake had of it before is removed."""
    blocks = cut_blocks(df, order_by, align=size, rows_per_block=rows_per_block)
    clear_entity(df.sparkSession, path, entity)
    for first, stop in blocks.parts(blocks_per_job):
        write_blocks(df, entity, blocks, path, size, first, stop)
    write_index(df, entity, blocks, path, size)
    return blocks


def read_index(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """A row per block of the entity; ``k0``, ``k1``, ... are its last key, null for the last block.

    Fails if the entity was not saved to its end.
    """
    return spark.read.parquet(f"{path.rstrip('/')}/{INDEX}/{_folder(spark, entity)}")


def _pages_in(
    spark: SparkSession, path: str, entity: str, blocks: DataFrame, record: T.DataType | None
) -> DataFrame:
    root = path.rstrip("/")
    directories = [f"{root}/{row.directory}" for row in blocks.select("directory").collect()]
    if not directories:
        return no_pages(spark, record)
    return load_pages(spark.read.option("basePath", root), directories, record, entity)


def saved_pages(
    spark: SparkSession, path: str, entity: str, first: int, last: int | None = None, record: T.DataType | None = None
) -> DataFrame:
    """The saved pages numbered from ``first`` to ``last`` (default: only that one).

    Only the blocks that hold them are read; numbers beyond the last page give no rows.
    """
    last = first if last is None else last
    holding = read_index(spark, path, entity).filter((F.col("last_page") >= first) & (F.col("first_page") <= last))
    return _pages_in(spark, path, entity, holding, record).filter(F.col(PAGE_NUMBER).between(first, last))


def followed(spark: SparkSession, path: str, link: str, record: T.DataType | None = None) -> DataFrame:
    """The saved page that a page's link names."""
    entity, found, number = link.rpartition("?page=")
    if not found or not number.isdigit():
        raise ValueError(f"not a page link: {link!r}")
    return saved_pages(spark, path, entity, int(number), record=record)


def saved_page_behind(
    spark: SparkSession,
    path: str,
    entity: str,
    record: T.StructType,
    order_by: OrderBy,
    last: Mapping[str, Any] | None,
    size: int = PAGE_SIZE,
) -> DataFrame:
    """The ``size`` records behind the row ``last`` (its sort key values) of a saved entity.

    ``order_by`` must be the order in which the entity was saved. The index names the block of the
    first such record; with the ones that follow it, as many as ``size`` needs, it is all that is read.
    ``last=None`` gives the first records.
    """
    keys, index = sort_keys(order_by), read_index(spark, path, entity)
    empty = spark.createDataFrame([], record)
    literals = [] if last is None else key_literals(empty, keys, last)
    if last is not None:
        bounds = compared_key(spark, record, keys, literals)
        ends = [F.col(f"k{i}") for i in range(len(keys))]
        index = index.filter(F.col("is_last") | sorts_after(keys, ends, bounds))
    # behind the first block, which may hold as little as one record, come whole ones
    wanted = 1 + F.ceil(F.lit(size) / F.col("block_rows"))
    start = index.agg(F.min("block").alias("start"), F.max(wanted).alias("wanted")).first()
    near = index.filter(F.col("block") < start.start + start.wanted)
    rows = records_of(_pages_in(spark, path, entity, near, record))
    if last is not None:
        rows = rows.filter(after_row(keys, literals, lead_is_null=last[keys[0].name] is None))
    return first_page(rows, order_by, size)
