"""The attribute dictionary: what each column of the chosen entities holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.operators.profile import KEPT_ATTRIBUTES, attribute_documents, attribute_profiles
from entitylake.operators.reshape import flatten, keep_columns
from entitylake.sources.csvfiles import write_csv
from entitylake.sources.documents import read_attributes, write_attributes


def dictionary_table(documents: DataFrame) -> DataFrame:
    """Attribute documents as a flat table of the kept columns."""
    return keep_columns(flatten(documents), KEPT_ATTRIBUTES)


def attribute_dictionary(
    tables: Mapping[str, DataFrame],
    entities: Sequence[str],
    path: str,
    csv_path: str | None = None,
    targets: Mapping[str, Mapping[str, list[str]]] | None = None,
) -> DataFrame:
    """Profile the allowed ``entities``, save their attribute documents, return the table.

    ``targets`` gives, per entity, the entities its lookup columns refer to.
    """
    documents = attribute_documents(attribute_profiles({name: tables[name] for name in entities}), targets)
    write_attributes(documents, path)
    saved = read_attributes(documents.sparkSession, path).filter(F.col("EntityLogicalName").isin(list(entities)))
    table = dictionary_table(saved)
    if csv_path is not None:
        write_csv(table.withColumn("Targets", F.concat_ws(";", "Targets")), csv_path)
    return table
