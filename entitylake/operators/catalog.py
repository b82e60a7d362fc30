"""The catalogue of entities: names, endpoints, record counts, fields, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.functions.columns import lowered, named, text_or, without_spaces
from entitylake.functions.labels import display_labels
from entitylake.operators.paging import PAGE_SIZE, estimated_pages
from entitylake.operators.upsert import last_wins, skip_done
from entitylake.schemas import ENTITY

# --- fixed values: kinds of names and the definition fields they come from --
NAME_KINDS = {
    "name": "Name",
    "logical_name": "LogicalName",
    "schema_name": "SchemaName",
    "collection_name": "CollectionName",
    "logical_collection_name": "LogicalCollectionName",
    "physical_name": "PhysicalName",
    "base_table_name": "BaseTableName",
    "entity_set_name": "EntitySetName",
}
SHORT_NAME_KINDS = [
    "LogicalName",
    "SchemaName",
    "CollectionSchemaName",
    "LogicalCollectionName",
    "EntitySetName",
]
LABEL_KINDS = ["display_name", "display_collection_name"]
SHORT_LABEL_KINDS = ["DisplayName", "DisplayCollectionName"]
NOT_ENDPOINTS = ["display_name", "name"]
ENDPOINT_PRIORITY = ["LogicalCollectionName", "LogicalName", "SchemaName"]
PROFILE_LABEL = "%s<Endpoint=%s, Count=%d>"
# --------------------------------------------------------------------------

KEY = "MetadataId"


def harvest_names(definitions: DataFrame, short: bool = False) -> DataFrame:
    """One row per (entity, kind of name): MetadataId, LogicalName, kind, name.

    The full harvest has eight names and two labels, the ``short`` one five and two.
    Missing names are null.
    """
    if short:
        columns = {kind: F.col(kind) for kind in SHORT_NAME_KINDS}
        labels = dict(zip(SHORT_LABEL_KINDS, display_labels()))
    else:
        columns = {kind: F.col(source) for kind, source in NAME_KINDS.items()}
        labels = dict(zip(LABEL_KINDS, display_labels()))
    pairs = [F.struct(F.lit(kind).alias("kind"), name.alias("name")) for kind, name in (columns | labels).items()]
    return definitions.select(KEY, "LogicalName", F.inline(F.array(*pairs)))


def catalog_index(definitions: DataFrame, arrival: str, key: str = "LogicalName") -> DataFrame:
    """One definition per name; of several the last in order of arrival."""
    return last_wins(definitions, [key], arrival)


# --- endpoints ------------------------------------------------------------


def longest_candidates(definitions: DataFrame, short: bool = False) -> DataFrame:
    """Endpoint candidates (MetadataId, preference, name): the longest name is tried first.

    All names are lower-cased. The full harvest leaves out ``name`` and
    ``display_name``; the short one keeps all and adds forms without spaces.
    """
    names = harvest_names(definitions, short)
    lower = lowered(F.col("name"))
    if short:
        forms = F.explode(F.array_distinct(F.array(lower, without_spaces(lower))))
    else:
        names = names.filter(~F.col("kind").isin(NOT_ENDPOINTS))
        forms = lower
    found = names.filter(F.col("name") != "").select(KEY, forms.alias("name"))
    return found.select(KEY, (-F.length("name")).alias("preference"), "name")


def priority_candidates(definitions: DataFrame, fields: Sequence[str] = tuple(ENDPOINT_PRIORITY)) -> DataFrame:
    """Endpoint candidates in a fixed order of definition fields, as they are written."""
    ranked = [
        F.struct(F.lit(i).alias("preference"), named(name).alias("name")) for i, name in enumerate(fields)
    ]
    return definitions.select(KEY, F.inline(F.array(*ranked))).filter(F.col("name").isNotNull())


def pick_endpoints(definitions: DataFrame, candidates: DataFrame, available: DataFrame) -> DataFrame:
    """(MetadataId, endpoint) for every definition; null where no candidate is available.

    The first candidate that exists wins: lowest preference, then alphabetical.
    An empty candidate per definition keeps those without a hit, so that the
    definitions need not be joined a second time.
    """
    existing = candidates.join(available.select("name").distinct(), "name", "left_semi")
    none = definitions.select(KEY, F.lit(0).alias("preference"), F.lit(None).cast("string").alias("name"))
    choice = F.min(F.when(F.col("name").isNotNull(), F.struct("preference", "name")))
    tried = existing.select(KEY, "preference", "name").unionByName(none)
    return tried.groupBy(KEY).agg(choice.alias("choice")).select(KEY, F.col("choice.name").alias("endpoint"))


def resolve_endpoints(
    definitions: DataFrame,
    available: DataFrame,
    rule: str = "longest",
    short: bool = False,
    fields: Sequence[str] = tuple(ENDPOINT_PRIORITY),
) -> DataFrame:
    """Resolve endpoints by the ``longest`` name or by ``priority`` of ``fields``."""
    if rule == "longest":
        candidates = longest_candidates(definitions, short)
    elif rule == "priority":
        candidates = priority_candidates(definitions, fields)
    else:
        raise ValueError(f"unknown rule: {rule}")
    return pick_endpoints(definitions, candidates, available)


def resolve_remaining(definitions: DataFrame, known: DataFrame, available: DataFrame, **options: Any) -> DataFrame:
    """``known`` endpoints (MetadataId, endpoint) as they are, the other definitions resolved."""
    todo = skip_done(definitions, known, [KEY])
    return known.select(KEY, "endpoint").unionByName(resolve_endpoints(todo, available, **options))


# --- record counts --------------------------------------------------------


def entity_counts(frames: Mapping[str, DataFrame], updated: Mapping[str, str] | None = None) -> DataFrame:
    """Count the records of every entity; with ``updated``, also the latest time in that column."""
    updated = updated or {}
    parts = []
    for name, df in frames.items():
        latest = F.max(named(updated[name])) if name in updated else F.lit(None)
        parts.append(
            df.agg(F.count("*").alias("record_count"), latest.cast("timestamp_ntz").alias("last_updated"))
            .select(F.lit(name).alias(ENTITY), "record_count", "last_updated")
        )
    return reduce(DataFrame.unionByName, parts)


def latest_snapshots(snapshots: DataFrame, arrival: str = "lastupdated") -> DataFrame:
    """One count per object type code (the last that arrived), the code renamed for joins."""
    newest = last_wins(snapshots, ["objecttypecode"], arrival)
    return newest.select(
        F.col("objecttypecode").alias("ObjectTypeCode"),
        F.col("count").alias("record_count"),
        F.col("lastupdated").alias("last_updated"),
    )


def entity_name() -> Column:
    """The logical name, or the schema name where that is missing or empty."""
    return text_or(F.col("LogicalName"), F.col("SchemaName"))


def record_counts(definitions: DataFrame, snapshots: DataFrame, arrival: str = "lastupdated") -> DataFrame:
    """(entity, record_count, last_updated) of the entities that have a snapshot."""
    counts = latest_snapshots(snapshots, arrival)
    return definitions.join(counts, "ObjectTypeCode").select(
        entity_name().alias(ENTITY), "record_count", "last_updated"
    )


def record_counts_or_zero(definitions: DataFrame, snapshots: DataFrame, arrival: str = "lastupdated") -> DataFrame:
    """As ``record_counts`` for all entities: without a snapshot the count is 0, the time null."""
    counts = latest_snapshots(snapshots, arrival)
    return definitions.join(counts, "ObjectTypeCode", "left").select(
        KEY,
        entity_name().alias(ENTITY),
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
        "last_updated",
    )


def strict_lookup(rows: DataFrame, catalog: DataFrame, key: str, catalog_key: str) -> DataFrame:
    """Join every row with its catalogue entry; a key without partner fails the job.

    The check is a filter on the joined rows, so no second pass is needed and no
    projection can drop it.
    """
    entries = catalog.withColumn("__found", F.lit(True))
    joined = rows.join(entries, named(key) == named(catalog_key), "left")
    message = F.concat(F.lit(f"no entry for {key} "), F.coalesce(named(key).cast("string"), F.lit("null")))
    found = F.when(F.col("__found"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return joined.filter(found).drop("__found")


# --- fields ---------------------------------------------------------------


def field_listing(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(entity, field, n_records): the fields of typed entities and how many records carry each."""
    parts = []
    for name, df in frames.items():
        totals = df.agg(*[F.count(named(field)).alias(f"c{i}") for i, field in enumerate(df.columns)])
        pairs = [
            F.struct(F.lit(field).alias("field"), F.col(f"c{i}").alias("n_records"))
            for i, field in enumerate(df.columns)
        ]
        parts.append(totals.select(F.lit(name).alias(ENTITY), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


def json_field_listing(records: DataFrame, column: str = "record") -> DataFrame:
    """The same from records as JSON text (entity, record), fields not known beforehand.

    A task sends one row per field that it has met, however many sets of fields
    the records have.
    """
    fields = records.select(ENTITY, F.explode(F.array_distinct(F.json_object_keys(named(column)))).alias("field"))
    return fields.groupBy(ENTITY, "field").agg(F.count("*").alias("n_records"))


def time_fields(listing: DataFrame) -> DataFrame:
    """Mark date and time fields. Their names decide, case-sensitively; a field can be both."""
    return listing.withColumn("is_date", F.contains("field", F.lit("date"))).withColumn(
        "is_time", F.contains("field", F.lit("time"))
    )


# --- profile --------------------------------------------------------------


def entity_profile(
    definitions: DataFrame,
    endpoints: DataFrame,
    counts: DataFrame,
    fields: DataFrame | None = None,
    size: int = PAGE_SIZE,
    names: DataFrame | None = None,
) -> DataFrame:
    """One row per entity: endpoint, count, estimated pages, date and time fields, names, label.

    ``endpoints`` and ``counts`` are keyed by MetadataId. ``fields`` is the output
    of ``time_fields`` for the records behind the endpoints, its entity being the
    endpoint. ``names`` is the output of ``harvest_names``; the profile has the different
    ones in order. ``catalog_size`` is the number of entities.
    """
    display, _ = display_labels()
    rows = (
        definitions.select(KEY, entity_name().alias(ENTITY), display.alias("display_name"))
        .join(endpoints.select(KEY, "endpoint"), KEY, "left")
        .join(counts.select(KEY, "record_count", "last_updated"), KEY, "left")
    )
    extra = []
    if fields is not None:
        lists = fields.groupBy(ENTITY).agg(
            *[
                F.sort_array(F.collect_list(F.when(F.col(flag), F.col("field")))).alias(name)
                for flag, name in (("is_date", "date_fields"), ("is_time", "time_fields"))
            ]
        )
        rows = rows.join(lists.withColumnRenamed(ENTITY, "endpoint"), "endpoint", "left")
        extra = ["date_fields", "time_fields"]
    if names is not None:
        every = names.groupBy(KEY).agg(F.sort_array(F.collect_set("name")).alias("names"))
        rows = rows.join(every, KEY, "left")
        extra = [*extra, "names"]
    count = F.coalesce("record_count", F.lit(0))
    return rows.select(
        KEY,
        ENTITY,
        "display_name",
        "endpoint",
        count.alias("record_count"),
        "last_updated",
        estimated_pages(count, size).alias("estimated_pages"),
        *extra,
        F.format_string(
            PROFILE_LABEL,
            F.coalesce("display_name", F.lit("None")),
            F.coalesce("endpoint", F.lit("None")),
            count,
        ).alias("label"),
        definitions.agg(F.count("*")).scalar().alias("catalog_size"),
    )
