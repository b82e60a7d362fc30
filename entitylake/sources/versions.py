"""A snapshot table in versions: an environment that a commit does not touch keeps its files.

``data/version=<n>/base_url=<url>`` has the rows that version ``n`` brought for an environment;
``_versions/<n>`` says in which directory each environment of that version is. A commit writes
the environments it touches, and then the list: the old one with these replaced. The list appears
whole or not at all and a number is given once, so readers see a version or the one before,
a writer that died leaves nothing that is read, and of two writers one fails and may try again.
Older versions stay readable until they are dropped. A list has a line per environment of the
catalogue, no entities and no records.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named, parsed_time
from entitylake.functions.ordering import OrderBy
from entitylake.operators.upsert import last_wins
from entitylake.sources.files import Files
from entitylake.sources.snapshots import BASE_URL, TIME

VERSIONS, DATA = "_versions", "data"
UNNAMED = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the directory of null


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all versions, in order."""
    return sorted(int(name) for name in Files(spark, root).names(VERSIONS))


def _listing(spark: SparkSession, root: str, version: int | None) -> tuple[int, dict[str | None, str]]:
    """A version's number and the directory of each of its environments; 0 and none before the first."""
    known = versions(spark, root)
    number = (known[-1] if known else 0) if version is None else version
    if not known and version is None:
        return 0, {}
    if number not in known:
        raise LookupError(f"no version {number} of {root}")
    lines = (Files(spark, root).get(f"{VERSIONS}/{number}") or "").splitlines()
    return number, {entry["base_url"]: entry["directory"] for entry in map(json.loads, lines)}


def commit(
    rows: DataFrame, root: str, arrival: OrderBy | None = None, unique: tuple[str, ...] = (BASE_URL, "entity"), tries: int = 3
) -> int:
    """Add a version in which the environments of ``rows`` are replaced as a whole; returns its number.

    Of several rows with equal ``unique`` columns the last wins, in the order ``arrival`` or as they
    come. Null is an environment like any other. No rows, no new version. A commit that meets
    another one is tried again on top of it: its data is written once, only the list is made anew.
    """
    spark = rows.sparkSession
    if arrival is None:
        rows = last_wins(rows.withColumn("__arrival", F.monotonically_increasing_id()), unique, "__arrival").drop("__arrival")
    else:
        rows = last_wins(rows, unique, arrival)
    place = f"{DATA}/version={uuid.uuid4().hex}"
    rows.write.partitionBy(BASE_URL).parquet(f"{root.rstrip('/')}/{place}")
    touched = _touched(spark, root, place)
    if not touched:
        return _listing(spark, root, None)[0]
    for turn in range(tries):
        number, listing = _listing(spark, root, None)
        listing |= touched
        lines = [json.dumps({"base_url": url, "directory": at}) for url, at in sorted(listing.items(), key=lambda x: (x[0] or "", x[1]))]
        try:
            Files(spark, root).put(f"{VERSIONS}/{number + 1}", "\n".join(lines), replace=False)
            return number + 1
        except FileExistsError:
            if turn == tries - 1:
                raise
    raise AssertionError


def _touched(spark: SparkSession, root: str, place: str) -> dict[str | None, str]:
    """The environments that were written at a place, by their directories."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = {}
    for folder in Files(spark, root).folders(place):
        text = folder.partition("=")[2]
        if folder.startswith(f"{BASE_URL}="):
            found[None if text == UNNAMED else unescape(text)] = f"{place}/{folder}"
    return found


def read_version(
    spark: SparkSession, root: str, schema: T.StructType, base_url: str | None = None, version: int | None = None
) -> DataFrame:
    """A version of the table (default: the newest), or one environment of it, with parsed times.

    Only the directories of that version and environment are listed and read. An unknown
    environment has no rows; an unknown version is an error.
    """
    _, listing = _listing(spark, root, version)
    if base_url is not None:
        listing = {url: at for url, at in listing.items() if url == base_url}
    top = root.rstrip("/")
    if listing:
        # the environment as a column comes from the directories, the versions' names are left out
        reader = spark.read.schema(schema).option("basePath", f"{top}/{DATA}")
        rows = reader.parquet(*[f"{top}/{at}" for at in listing.values()])
    else:
        rows = spark.createDataFrame([], schema)
    rows = rows.select(*map(named, schema.names))
    if TIME in schema.names:
        rows = rows.withColumn(TIME, parsed_time(F.col(TIME)))
    return rows


def drop_older(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Drop all versions but the newest ``keep``, and the files that only they had; returns their numbers.

    Not to be run beside a commit, whose files no version names yet.
    """
    files, known = Files(spark, root), versions(spark, root)
    gone, kept = known[:-keep], known[-keep:]
    used = {at for number in kept for at in _listing(spark, root, number)[1].values()}
    for number in gone:
        files.remove(f"{VERSIONS}/{number}")
    for place in files.folders(DATA):
        for folder in files.folders(f"{DATA}/{place}"):
            if f"{DATA}/{place}/{folder}" not in used:
                files.remove(f"{DATA}/{place}/{folder}")
        if not files.folders(f"{DATA}/{place}"):
            files.remove(f"{DATA}/{place}")
    return gone
