"""Entity tables in parquet: one collection, or many in one frame."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.functions.columns import named
from entitylake.operators.reshape import union_entities
from entitylake.schemas import ENTITY
from entitylake.sources.files import Files

SUFFIX = ".parquet"


def read_collection(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """All records of an entity."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{entity}{SUFFIX}")


def read_collections(spark: SparkSession, folder: str, entities: Iterable[str]) -> dict[str, DataFrame]:
    """The entities that exist, by name; missing ones are left out."""
    found = {}
    for entity in entities:
        try:
            found[entity] = read_collection(spark, folder, entity)
        except AnalysisException:
            continue
    return found


def entities_in(spark: SparkSession, folder: str) -> list[str]:
    """The entities that a folder has, from its listing."""
    files = Files(spark, folder)
    return sorted(name.removesuffix(SUFFIX) for name in [*files.names(), *files.folders()] if name.endswith(SUFFIX))


def _entity_of_file(folder: str) -> Column:
    # the path is a URL, in which a plus sign stands for itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    # what comes before the folder's own name may be written in more than one way
    top = re.escape(folder.rsplit("/", 1)[-1])
    return F.regexp_extract(path, rf"^(?:.*/)?{top}/([^/]+?){re.escape(SUFFIX)}(?:/|$)", 1)


def read_many(spark: SparkSession, folder: str, entities: Iterable[str] | None = None) -> DataFrame:
    """The records of many entities (default: all of the folder), each row marked with its entity, from one read.

    The schema is that of all files together, fields that an entity lacks are null, and the entity
    comes from a file's name. The plan has one scan however many entities there are, and a filter
    on the entity chooses files. A field must have one type in all entities; ``scan_many`` widens types.
    """
    names = entities_in(spark, folder) if entities is None else list(entities)
    if not names:
        raise ValueError(f"no entities in {folder}")
    top = folder.rstrip("/")
    rows = spark.read.option("mergeSchema", "true").parquet(*[f"{top}/{name}{SUFFIX}" for name in names])
    return rows.select(_entity_of_file(top).alias(ENTITY), *map(named, rows.columns))


def scan_many(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Many entities in one job, each row marked with its entity; a scan for each."""
    return union_entities(frames)
