"""Pages as they arrive: records appended once per page, and running progress.

A page is known by its entity and number. One that lands again, in another file or saved anew, is
dropped for as long as it is remembered: ``REMEMBERED`` after it was last taken up by the stream. The
clock is the stream's own, each batch has one time and a repeated batch the same again. So no page
is ever too late, the state holds the pages of that time only, and a stream that is restarted from its
checkpoint remembers them too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from entitylake.operators.documents import STATUS
from entitylake.operators.paging import data_pages, unpage
from entitylake.schemas import ENTITY, PAGE_NUMBER, VALUE
from entitylake.sources.pages import load_page_files, load_pages, set_aside

BATCH = "batch_id"
REMEMBERED = "7 days"
SEEN = "__seen"


def page_stream(
    spark: SparkSession,
    path: str,
    record: T.DataType | None = None,
    files_per_trigger: int | None = None,
    file_per_page: bool = False,
) -> DataFrame:
    """A stream of the pages landing under ``path``, in either layout of the page lake."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return (load_page_files if file_per_page else load_pages)(reader, path, record)


def once_per_page(pages: DataFrame, strict: bool = False, remembered: str | None = REMEMBERED) -> DataFrame:
    """The pages that are data, each once: the first that arrives.

    A page that is cut off or an error does not count, so that it can be saved again. With
    ``remembered=None`` pages are only told apart by their files, which takes no state and no shuffle.
    """
    good = data_pages(pages, strict)
    if remembered is None:
        return good
    timed = good.withColumn(SEEN, F.current_timestamp()).withWatermark(SEEN, remembered)
    return timed.dropDuplicatesWithinWatermark([ENTITY, PAGE_NUMBER]).drop(SEEN)


def append_records(
    pages: DataFrame, path: str, checkpoint: str, strict: bool = False, remembered: str | None = REMEMBERED
) -> StreamingQuery:
    """Append the records of all pages that have landed, then stop; see ``once_per_page``.

    The checkpoint knows the files and the pages taken, so a restart continues with new ones. Pages
    that are no data fail the stream if ``strict``; otherwise ``append_set_aside`` keeps them.
    """
    return _append(unpage(once_per_page(pages, strict, remembered)), path, checkpoint)


def append_set_aside(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the pages that are no data, with their status and text, then stop."""
    return _append(set_aside(pages), path, checkpoint)


def _append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def progress(pages: DataFrame, remembered: str | None = REMEMBERED) -> DataFrame:
    """Running pages and records per entity; the state has a row per entity, and one per page remembered.

    Only data counts, and a page that lands again does not. Only keys and sizes are shuffled.
    """
    status = [STATUS] if STATUS in pages.columns else []
    slim = pages.select(ENTITY, PAGE_NUMBER, F.size(VALUE).cast("bigint").alias("n"), *status)
    sizes = once_per_page(slim, remembered=remembered)
    return sizes.groupBy(ENTITY).agg(F.count(PAGE_NUMBER).alias("pages"), F.sum("n").alias("records"))


def write_progress(
    pages: DataFrame, path: str, checkpoint: str, remembered: str | None = REMEMBERED
) -> StreamingQuery:
    """Write the entities that moved in each batch, in a directory per batch.

    A repeated batch replaces its own directory.
    """

    def save(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        progress(pages, remembered)
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_progress(spark: SparkSession, path: str) -> DataFrame:
    """The newest progress per entity: counts only grow, so it is the maximum."""
    rows = spark.read.parquet(path)
    return rows.groupBy(ENTITY).agg(F.max("pages").alias("pages"), F.max("records").alias("records"))


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for an available-now query, however long; with ``seconds``, stop it and fail after them."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream did not finish within {seconds} s")
