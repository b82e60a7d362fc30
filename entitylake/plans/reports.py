"""The counts report: record counts with names and descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.functions.labels import report_labels
from entitylake.operators.catalog import strict_lookup
from entitylake.operators.reshape import map_rows
from entitylake.schemas import ENTITY
from entitylake.sources.csvfiles import write_csv


def counts_of(environment: DataFrame) -> DataFrame:
    """(entity, record_count) from the map of an environment snapshot."""
    entries = map_rows(environment.select("record_counts"), "record_counts", ENTITY, "state")
    return entries.select(ENTITY, F.col("state.record_count").alias("record_count"))


def counts_report(counts: DataFrame, definitions: DataFrame, path: str | None = None) -> DataFrame:
    """Entity, LogicalName, Name, Description, Count; the largest first.

    ``counts`` has (entity, record_count); an entity that the catalogue does not
    know fails the job. Written as CSV if ``path`` is given.
    """
    name, description = report_labels(F.col(ENTITY))
    rows = strict_lookup(counts, definitions, ENTITY, "LogicalName").select(
        F.col(ENTITY).alias("Entity"),
        F.col("LogicalName"),
        name.alias("Name"),
        description.alias("Description"),
        F.col("record_count").alias("Count"),
    )
    report = rows.orderBy(F.col("Count").desc_nulls_last(), F.col("LogicalName").desc_nulls_last())
    if path is not None:
        write_csv(report, path)
    return report
