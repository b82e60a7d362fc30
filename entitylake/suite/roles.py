"""The benchmark tables in the roles of the catalogue: definitions, snapshots, collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.operators.catalog import entity_counts
from entitylake.plans.extract import Collection
from entitylake.schemas import DEFINITION, ENTITY
from entitylake.sources.tables import read_collection


class Tables:
    """Lazy access to the tables of one scale: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_collection(self.spark, self.folder, name)


def _label(text: Column) -> Column:
    return F.struct(F.struct(text.alias("Label")).alias("UserLocalizedLabel"))


def _definitions(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    null = F.lit(None)
    return df.select(
        *[columns.get(item.name, null).cast(item.dataType).alias(item.name) for item in DEFINITION.fields]
    )


def customer_definitions(t: Tables) -> DataFrame:
    """Customers as entities; some label paths are broken, some leaves are null, some have no snapshot."""
    return _definitions(
        t.customer,
        {
            "MetadataId": F.col("c_custkey"),
            "LogicalName": F.col("c_name"),
            "SchemaName": F.col("c_name"),
            "LogicalCollectionName": F.lower("c_mktsegment"),
            "ObjectTypeCode": F.when(F.col("c_custkey") % 7 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey")),
            "DisplayName": F.when(F.col("c_acctbal") >= 0, _label(F.col("c_mktsegment"))),
            "DisplayCollectionName": _label(F.col("c_mktsegment")),
            "Description": F.when(
                F.col("c_nationkey") <= 20,
                _label(F.when(F.col("c_nationkey") >= 5, F.col("c_mktsegment"))),
            ),
        },
    )


def part_definitions(t: Tables) -> DataFrame:
    """Parts as entities: four kinds of names, many of them shared."""
    return _definitions(
        t.part,
        {
            "MetadataId": F.col("p_partkey"),
            "Name": F.col("p_name"),
            "LogicalName": F.col("p_name"),
            "SchemaName": F.col("p_brand"),
            "CollectionSchemaName": F.col("p_brand"),
            "LogicalCollectionName": F.col("p_type"),
            "EntitySetName": F.col("p_type"),
            "ObjectTypeCode": F.col("p_partkey"),
            "DisplayName": _label(F.col("p_name")),
            "DisplayCollectionName": F.when(F.col("p_size") <= 25, _label(F.col("p_type"))),
        },
    )


def part_endpoints(t: Tables) -> DataFrame:
    """Available endpoints: the brands of expensive parts, and some types."""
    brands = t.part.filter("p_retailprice > 1000 and p_size < 3").select(F.lower("p_brand").alias("name"))
    types = t.part.filter("p_type in ('SMALL', 'STANDARD')").select(F.lower("p_type").alias("name"))
    return brands.union(types)


def order_snapshots(t: Tables) -> DataFrame:
    """Orders as count snapshots of their customers; several per customer."""
    return t.orders.select(
        F.col("o_custkey").alias("objecttypecode"),
        F.floor("o_totalprice").alias("count"),
        F.col("o_orderdate").alias("lastupdated"),
        F.col("o_orderkey").alias("arrived"),
    )


SNAPSHOT_ARRIVAL = "lastupdated, arrived"


def collections(t: Tables) -> dict[str, Collection]:
    """Tables that are paged, each with a unique order."""
    return {
        "customer": Collection(t.customer, "c_custkey"),
        "supplier": Collection(t.supplier, "s_suppkey"),
        "part": Collection(t.part, "p_partkey"),
        "orders": Collection(t.orders, "o_orderkey"),
        "documents": Collection(t.documents, "doc_id"),
    }


def collection_definitions(t: Tables) -> DataFrame:
    """Definitions of the paged tables, and of one that has no endpoint."""
    names = [*collections(t), "ghost"]
    rows = t.spark.createDataFrame([(i, name) for i, name in enumerate(names)], "code bigint, name string")
    return _definitions(
        rows,
        {
            "MetadataId": F.col("code"),
            "LogicalName": F.col("name"),
            "SchemaName": F.initcap("name"),
            "LogicalCollectionName": F.concat("name", F.lit("set")),
            "EntitySetName": F.concat("name", F.lit("set")),
            "ObjectTypeCode": F.col("code"),
        },
    )


def collection_snapshots(t: Tables) -> DataFrame:
    """Counts of the paged tables, as snapshots."""
    counts = entity_counts({name: one.df for name, one in collections(t).items()})
    codes = collection_definitions(t).select("ObjectTypeCode", F.col("LogicalName").alias(ENTITY))
    return counts.join(codes, ENTITY).select(
        F.col("ObjectTypeCode").alias("objecttypecode"),
        F.col("record_count").alias("count"),
        F.col("last_updated").alias("lastupdated"),
    )
