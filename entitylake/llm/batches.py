"""Helpers that the operators share: Arrow batches, words, Python workers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run of characters other than these; bytes.split() cuts at the same ones.
WHITE = "\\x20\\x09-\\x0D"
WORD = f"[^{WHITE}]+"

SLICE_BYTES = 4 << 20


def share_code(spark: SparkSession) -> None:
    """Lets the Python workers of this session import the package from where the driver has it.

    A cluster ships the package with its job; there this only adds a path that may not exist.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever characters the name has."""
    return df["`" + name.replace("`", "``") + "`"]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = total = 0
    for row, size in enumerate(sizes):
        if row > start and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return [value or b"" for value in batch.column(text).cast(pa.binary()).to_pylist()]


def blocks_of_words(data: bytes, size: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size; the text is only cut between words."""
    start = 0
    while len(data) - start > size:
        end = start + size
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end].split()
        start = end
    yield data[start:].split()


def word_count(text: Column) -> Column:
    """Number of words, by built-in functions; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
