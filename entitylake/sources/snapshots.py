"""Environment snapshots: catalogue state per base URL.

At scale a snapshot is a table, one row per (base_url, entity). The JSON shape
(one object keyed by base URL, with maps keyed by entity) is read and written at
the edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import parsed_time, printed_time
from entitylake.functions.jsontext import JSON_OPTIONS, json_value
from entitylake.functions.ordering import OrderBy
from entitylake.operators.ranking import ranked
from entitylake.operators.upsert import skip_done, upsert
from entitylake.schemas import ENVIRONMENT

BASE_URL = "base_url"
TIME = "last_updated"
MAX_ENTRIES = 1000


def read_environments(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """JSON documents ``{base_url: {last_updated, endpoints, record_counts, entities}}`` as rows.

    There is one document per file, or per line. A malformed or empty one
    counts as empty.
    """
    files = spark.read.text(path, wholetext=whole_files)
    keyed = json_value(F.col("value"), T.MapType(T.StringType(), ENVIRONMENT))
    rows = files.select(F.explode(keyed).alias(BASE_URL, "state"))
    return rows.select(BASE_URL, *[f"state.{name}" for name in ENVIRONMENT.fieldNames()])


def environment(rows: DataFrame, base_url: str) -> DataFrame:
    """The state of one environment, its time parsed; no row for an unknown key."""
    return rows.filter(F.col(BASE_URL) == base_url).withColumn(TIME, parsed_time(F.col(TIME)))


def count_documents(counts: DataFrame, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """(base_url, entity, record_count, last_updated) rows as (base_url, record_counts) documents.

    A map must fit one row, so an environment gets as many documents as it needs,
    each with at most ``max_entries`` entities; together they are its state.
    """
    part = F.floor((F.col("__rank") - 1) / F.lit(max_entries))
    entries = F.map_from_entries(F.collect_list(F.struct("entity", F.struct("record_count", TIME))))
    numbered = ranked(counts, "entity", "__rank", group=BASE_URL)
    return numbered.groupBy(BASE_URL, part.alias("__part")).agg(entries.alias("record_counts")).drop("__part")


def upsert_environments(rows: DataFrame, path: str, current: str) -> None:
    """Write the documents at ``current`` to ``path``, those of the environments in ``rows`` replaced.

    All documents of an environment are replaced together; other environments stay as they are.
    """
    if current.rstrip("/") == path.rstrip("/"):
        raise ValueError("write the new version to a new path")
    base = read_environments(rows.sparkSession, current, whole_files=False)
    kept = skip_done(base, rows, [BASE_URL])
    write_environments(kept.unionByName(rows, allowMissingColumns=True), path)


def write_environments(rows: DataFrame, path: str) -> None:
    """Rows as read by ``read_environments``, one JSON document per line."""
    state = F.struct(*[F.col(name) for name in rows.columns if name != BASE_URL])
    document = F.to_json(F.create_map(F.col(BASE_URL), state), JSON_OPTIONS)
    rows.select(document.alias("value")).write.mode("overwrite").text(path)


def snapshot_rows(df: DataFrame, base_url: Column, entity: Column, count: Column, updated: Column) -> DataFrame:
    """Rows of the snapshot table, with the time printed as snapshots do."""
    return df.select(
        base_url.alias(BASE_URL),
        entity.alias("entity"),
        count.alias("record_count"),
        printed_time(updated).alias(TIME),
    )


def write_snapshot(
    rows: DataFrame,
    path: str,
    current: str | None = None,
    keys: tuple[str, ...] = (BASE_URL,),
    arrival: OrderBy | None = None,
) -> None:
    """Write a new version at ``path``: ``rows`` replace their keys in ``current``, the rest is kept.

    An environment is replaced as a whole; of several rows for one of its entities (or for
    one of other ``keys``) the last wins, see ``upsert``. The table is parquet, with a directory per base URL where there are any. ``path`` must not be ``current``: Spark would delete what it is reading, and
    a job that dies half-way would leave neither version.
    """
    if current is not None:
        if current.rstrip("/") == path.rstrip("/"):
            raise ValueError("write the new version to a new path")
        base = rows.sparkSession.read.schema(rows.schema).parquet(current)
        unique = [BASE_URL, "entity"] if keys == (BASE_URL,) else None
        rows = upsert(base, rows, list(keys), arrival, unique)
    by = [BASE_URL] if BASE_URL in rows.columns else []
    rows.write.mode("overwrite").partitionBy(*by).parquet(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, base_url: str | None = None) -> DataFrame:
    """The snapshot table, or one environment of it (only its directory is read), with parsed times."""
    rows = spark.read.schema(schema).parquet(path)
    if base_url is not None:
        rows = rows.filter(F.col(BASE_URL) == base_url)
    return rows.withColumn(TIME, parsed_time(F.col(TIME)))
