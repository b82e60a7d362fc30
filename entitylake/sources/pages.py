"""The page lake: JSON envelopes and records, one directory per entity.

A line of a file is one page (or one record). Pages are rows, not files: a
directory or file per page would mean hundreds of millions of them for a large
entity. ``entity=<name>`` directories prune reads to the entities asked for;
``pageindex`` adds directories per block of pages below them, and an index.
Readers also take the one-file-per-page layout, ``<entity>_page_<n>.json`` or
``<entity>_extract_page_<n>.json``, indented or not.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from entitylake.functions.columns import named
from entitylake.functions.jsontext import READ_OPTIONS, json_text
from entitylake.operators.documents import STATUS, data_only, quarantine
from entitylake.operators.paging import data_pages
from entitylake.schemas import CORRUPT, ENTITY, ERROR, NEXT_LINK, PAGE_NUMBER, VALUE, envelope

# --- fixed values: names of page files ------------------------------------
PAGE_FILE = r"([^/]+?)(?:_extract)?_page_(\d+)\.json$"
# --------------------------------------------------------------------------

LINE = "line"
BLOCK_DIR = "block"  # of a lake with a page index


def write_lines(lines: Iterable[DataFrame], path: str) -> None:
    """Write (entity, line) frames in one job; entities not among them are left alone.

    Each directory is replaced as a whole, so a shrunk entity leaves nothing
    behind. An entity without lines gets no directory.
    """
    frames = list(lines)
    if not frames:
        return
    writer = reduce(DataFrame.unionByName, frames).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(ENTITY).text(path)


def page_lines(envelopes: DataFrame) -> DataFrame:
    """Envelope rows as (entity, line)."""
    return envelopes.select(ENTITY, json_text(F.struct(PAGE_NUMBER, VALUE, named(NEXT_LINK))).alias(LINE))


def write_pages(envelopes: DataFrame | Iterable[DataFrame], path: str) -> None:
    """Save the pages of one or many entities, in one job.

    Entities of different shape can be saved together, since each brings its
    lines ready made. Pages stay in the tasks that built them.
    """
    frames = [envelopes] if isinstance(envelopes, DataFrame) else envelopes
    write_lines([page_lines(frame) for frame in frames], path)


def _page_schema(record: T.DataType | None, *more: T.StructField) -> T.StructType:
    fields = [*envelope(record).fields, T.StructField(CORRUPT, T.StringType()), *more]
    return T.StructType(fields)


def _malformed(names: Iterable[str]) -> Column:
    """Whether a line has been found malformed, judged by the fields ``names``, all of them.

    A reader parses only the fields that a query needs, and sees no fault in others. The second
    condition never holds; it makes every query need them, so that all queries judge alike.
    """
    read = F.greatest(F.lit(0), F.lit(0), *[F.when(named(name).isNotNull(), 1).otherwise(0) for name in names])
    return F.col(CORRUPT).isNotNull() | (read < 0)


def _with_status(pages: DataFrame, entity: str | None) -> DataFrame:
    fields = [name for name in pages.columns if name not in (CORRUPT, ENTITY)]
    status = (
        F.when(_malformed(fields), "corrupt")
        .when(F.col(ERROR).isNotNull(), "error")
        .otherwise("ok")
    )
    rows = pages.withColumn(STATUS, status)
    return rows if entity is None else rows.filter(F.col(ENTITY) == entity)


def load_pages(
    reader: DataFrameReader | DataStreamReader,
    path: str | list[str],
    record: T.DataType | None = None,
    entity: str | None = None,
) -> DataFrame:
    """Pages of a lake written by ``write_pages`` or ``pageindex``, as a table or as a stream."""
    schema = _page_schema(record, T.StructField(ENTITY, T.StringType()))
    pages = reader.schema(schema).options(**READ_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT)
    return _with_status(pages.json(path).drop(BLOCK_DIR), entity)


def no_pages(spark: SparkSession, record: T.DataType | None = None) -> DataFrame:
    """An empty table of pages, as readers give it."""
    schema = _page_schema(record, T.StructField(ENTITY, T.StringType()))
    return _with_status(spark.createDataFrame([], schema), None)


def load_page_files(
    reader: DataFrameReader | DataStreamReader, path: str, record: T.DataType | None = None, entity: str | None = None
) -> DataFrame:
    """Pages in the one-file-per-page layout, entity and number from the file names."""
    schema = T.StructType([item for item in _page_schema(record).fields if item.name != PAGE_NUMBER])
    options = {"columnNameOfCorruptRecord": CORRUPT, "multiLine": True, "recursiveFileLookup": True}
    pages = reader.schema(schema).options(**READ_OPTIONS, **options).json(path)
    file = F.url_decode("_metadata.file_path")
    located = pages.select(
        "*",
        F.regexp_extract(file, PAGE_FILE, 1).alias(ENTITY),
        F.regexp_extract(file, PAGE_FILE, 2).cast("bigint").alias(PAGE_NUMBER),
    )
    return _with_status(located, entity)


def read_pages(
    spark: SparkSession, path: str, record: T.DataType | None = None, entity: str | None = None
) -> DataFrame:
    """Pages of a lake written by ``write_pages``; ``entity`` prunes to its directory.

    ``record`` is the schema of the records; without it they stay JSON text.
    ``status`` tells data, error envelopes and malformed text apart.
    """
    return load_pages(spark.read, path, record, entity)


def read_page_files(
    spark: SparkSession, path: str, record: T.DataType | None = None, entity: str | None = None
) -> DataFrame:
    """As ``read_pages`` for the one-file-per-page layout."""
    return load_page_files(spark.read, path, record, entity)


def set_aside(pages: DataFrame) -> DataFrame:
    """The pages that are no data: (entity, page_number, status, code, message, text).

    ``text`` is the page as it stands in the file, for malformed ones.
    """
    return quarantine(pages).select(
        ENTITY, PAGE_NUMBER, STATUS, f"{ERROR}.code", f"{ERROR}.message", F.col(CORRUPT).alias("text")
    )


def json_records(pages: DataFrame, strict: bool = False) -> DataFrame:
    """(entity, record) with records as JSON text, from pages read without a record schema."""
    return data_pages(pages, strict).select(ENTITY, F.explode(VALUE).alias("record"))


def record_lines(df: DataFrame, entity: str) -> DataFrame:
    record = F.struct(*[named(name) for name in df.columns])
    return df.select(F.lit(entity).alias(ENTITY), json_text(record).alias(LINE))


def write_records(frames: dict[str, DataFrame], path: str) -> None:
    """Save the records of entities as JSON, unpaged; an empty entity leaves no output."""
    write_lines([record_lines(df, entity) for entity, df in frames.items()], path)


def load_records(spark: SparkSession, path: str, record: T.StructType, entity: str) -> DataFrame:
    """All lines of one entity of a folder written by ``write_records``, with their status."""
    more = [T.StructField(CORRUPT, T.StringType()), T.StructField(ENTITY, T.StringType())]
    reader = spark.read.schema(T.StructType([*record.fields, *more])).options(**READ_OPTIONS)
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path).filter(F.col(ENTITY) == entity)
    return rows.withColumn(STATUS, F.when(_malformed(record.names), "corrupt").otherwise("ok"))


def read_records(
    spark: SparkSession, path: str, record: T.StructType, entity: str, strict: bool = False
) -> DataFrame:
    """The records of one entity; a malformed line is left out, or fails the job if ``strict``."""
    good = data_only(load_records(spark, path, record, entity), strict, ("corrupt",))
    return good.select(*[named(name) for name in record.names])
