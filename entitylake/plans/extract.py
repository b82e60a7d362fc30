"""Extraction of entities into a page lake.

The catalogue decides which entities are taken. Each is paged and written by jobs of
its own, a few entities at a time. An extraction with a name (``run``) can be stopped and
started again: what it has finished is not done twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.functions.ordering import OrderBy
from entitylake.operators.catalog import (
    ENDPOINT_PRIORITY,
    KEY,
    record_counts_or_zero,
    resolve_endpoints,
)
from entitylake.operators.paging import PAGE_SIZE
from entitylake.schemas import COUNTS_REPORT, ENTITY
from entitylake.plans.runs import Run
from entitylake.sources.csvfiles import read_csv
from entitylake.sources.pageindex import save_entity

# --- fixed values: entities that are taken at the same time ----------------
AT_ONCE = 10
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Collection:
    """An entity table and the unique order in which it is paged."""

    df: DataFrame
    order_by: OrderBy


def worklist(endpoints: DataFrame, counts: DataFrame) -> DataFrame:
    """Entities with an endpoint, the smallest first; both inputs are keyed by MetadataId."""
    resolved = endpoints.filter(F.col("endpoint").isNotNull())
    return resolved.join(counts, KEY).orderBy("record_count", ENTITY)


def smallest_first(entries: DataFrame, count: str = "Count", name: str = "LogicalName") -> DataFrame:
    return entries.orderBy(F.col(count).asc_nulls_first(), F.col(name).asc_nulls_first())


def wanted(entries: DataFrame, count: str = "Count", name: str = "LogicalName") -> DataFrame:
    """Entries with a name and at least one record; a missing name or count does not pass."""
    return entries.filter((F.col(name) != "") & (F.col(count) != 0))


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(name,) for name in names], "name string")


def _save(
    targets: list[tuple[str, Collection]], path: str, size: int, at_once: int, run: Run | None
) -> dict[str, str]:
    """Save each entity in jobs of its own, a few entities at a time; ``saved`` or the error for each.

    Their cuts and writes run side by side, and one that fails touches no other.
    """

    def save(target: tuple[str, Collection]) -> str:
        name, one = target
        try:
            if run:
                run.save(one.df, name, one.order_by, size)
            else:
                save_entity(one.df, name, one.order_by, path, size)
        except Exception as error:
            return f"{type(error).__name__}: {error}"
        return "saved"

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        found = pool.map(inheritable_thread_target(targets[0][1].df.sparkSession)(save), targets) if targets else []
        return {name: text for (name, _), text in zip(targets, found)}


def extract_all(
    definitions: DataFrame,
    snapshots: DataFrame,
    tables: Mapping[str, Collection],
    path: str,
    size: int = PAGE_SIZE,
    at_once: int = AT_ONCE,
    run: str | None = None,
) -> list[str]:
    """Save every entity of the catalogue whose endpoint is among ``tables``.

    All are tried, ``at_once`` at a time; if any fails, an error names them at the end. With
    ``run``, entities that an extraction of this name has finished are left as they are, and one that was
    stopped goes on behind its last finished part. Returns the names of the entities that were
    to do, in work list order. The work list reaches the driver, as the tables to scan must be known
    there; it has at most one row per catalogue entry, no records.
    """
    spark = definitions.sparkSession
    endpoints = resolve_endpoints(definitions, _names(spark, list(tables)))
    todo = worklist(endpoints, record_counts_or_zero(definitions, snapshots))
    named_run = Run(spark, path, run) if run else None
    if named_run:
        todo = named_run.remaining(todo).orderBy("record_count", ENTITY)
    targets = [(row[ENTITY], tables[row["endpoint"]]) for row in todo.collect()]
    status = _save(targets, path, size, at_once, named_run)
    failed = {name: text for name, text in status.items() if text != "saved"}
    if failed:
        raise RuntimeError(f"not saved: {failed}")
    return [name for name, _ in targets]


def extract_from_csv(
    spark: SparkSession,
    csv_path: str,
    definitions: DataFrame,
    tables: Mapping[str, Collection | Callable[[], Collection]],
    path: str,
    size: int = PAGE_SIZE,
    at_once: int = AT_ONCE,
    run: str | None = None,
) -> dict[str, str]:
    """Save the entities of a work list CSV; a failing entity does not stop the others.

    The endpoint is the first of the definition's names, in fixed priority, that
    exists; without one the entity's own name is tried. With ``run``, entities that
    an extraction of this name has finished are skipped. Returns a status per
    entity: ``saved``, ``saved before`` or the error.
    """
    entries = wanted(smallest_first(read_csv(spark, csv_path, COUNTS_REPORT)))
    resolved = resolve_endpoints(
        definitions, _names(spark, list(tables)), rule="priority", fields=ENDPOINT_PRIORITY
    )
    known = definitions.select(KEY, "LogicalName").join(resolved, KEY).select("LogicalName", "endpoint")
    todo = entries.select("LogicalName", "Count").join(known, "LogicalName", "left")
    todo = smallest_first(todo).select(
        "LogicalName", F.coalesce("endpoint", "LogicalName").alias("endpoint")
    )

    named_run = Run(spark, path, run) if run else None
    done = {row[ENTITY] for row in named_run.finished().collect()} if named_run else set()
    status: dict[str, str] = {}
    targets = []
    for row in todo.collect():
        name = row["LogicalName"]
        if name in done:
            status[name] = "saved before"
            continue
        try:
            table = tables[row["endpoint"]]
            targets.append((name, table if isinstance(table, Collection) else table()))
        except Exception as error:  # a table that cannot be opened
            status[name] = f"{type(error).__name__}: {error}"
    return status | _save(targets, path, size, at_once, named_run)
