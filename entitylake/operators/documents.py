"""JSON documents that may be malformed or carry an error instead of data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named
from entitylake.functions.jsontext import READ_OPTIONS
from entitylake.schemas import CORRUPT, ERROR, ERROR_BODY

STATUS = "status"


def parse_documents(df: DataFrame, column: str, schema: T.StructType, out: str = "document") -> DataFrame:
    """Parse JSON text; malformed text never fails the job.

    Adds ``out`` (null unless the document is data), ``error`` and ``status``:
    ``ok``, ``error`` (an error envelope) or ``corrupt``.
    """
    fields = [item for item in schema.fields if item.name not in (ERROR, CORRUPT)]
    whole = T.StructType(
        [*fields, T.StructField(ERROR, ERROR_BODY), T.StructField(CORRUPT, T.StringType())]
    )
    options = {**READ_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # As the output of a generator the parsed document stays one expression; as a
    # plain column it would be copied, and parsed again, into every later filter.
    parsed = df.select("*", F.explode(F.array(F.from_json(named(column), whole, options))).alias("__parsed"))
    body = F.col("__parsed")
    corrupt = body.isNull() | body[CORRUPT].isNotNull()
    status = F.when(corrupt, "corrupt").when(body[ERROR].isNotNull(), "error").otherwise("ok")
    document = F.struct(*[body[item.name].alias(item.name) for item in fields])
    return (
        parsed.withColumn(STATUS, status)
        .withColumn(out, F.when(F.col(STATUS) == "ok", document))
        .withColumn(ERROR, body[ERROR])
        .drop("__parsed")
    )


def data_only(df: DataFrame, strict: bool = False, failing: Sequence[str] = ("error",)) -> DataFrame:
    """The documents that are data. ``strict`` fails the job at the first that is ``failing``."""
    good = F.col(STATUS) == "ok"
    if strict:
        known = [F.col(f"{ERROR}.{name}") for name in ERROR_BODY.names] if ERROR in df.columns else []
        message = F.concat_ws(": ", F.concat(F.col(STATUS), F.lit(" page")), *known)
        good = F.when(F.col(STATUS).isin(*failing), F.raise_error(message).cast("boolean")).otherwise(good)
    return df.filter(good)


def quarantine(df: DataFrame) -> DataFrame:
    """The documents that are not data, with their status."""
    return df.filter(F.col(STATUS) != "ok")
