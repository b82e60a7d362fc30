"""Folders of JSON documents: tolerant reading, attribute documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.jsontext import JSON_OPTIONS, READ_OPTIONS
from entitylake.operators.documents import parse_documents
from entitylake.schemas import ATTRIBUTE, ENTITY


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, whole_files: bool = False
) -> DataFrame:
    """One document per line (or per file); malformed ones are kept with their text and status."""
    texts = spark.read.text(path, wholetext=whole_files)
    return parse_documents(texts.withColumnRenamed("value", "raw"), "raw", schema)


def write_attributes(documents: DataFrame, path: str) -> None:
    """Save nested attribute documents, one directory per entity."""
    rows = documents.withColumn(ENTITY, F.col("EntityLogicalName"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**JSON_OPTIONS).partitionBy(ENTITY).json(path)


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*ATTRIBUTE.fields, T.StructField(ENTITY, T.StringType())])
    return spark.read.schema(schema).options(**READ_OPTIONS).json(path)
