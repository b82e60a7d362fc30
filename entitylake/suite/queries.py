"""One query per operator, over whole tables: ``name -> callable(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions import columns as c
from entitylake.functions import labels
from entitylake.functions.jsontext import json_text
from entitylake.operators import catalog, documents, numbering, paging, profile, query, ranking, reshape, upsert, variants
from entitylake.plans import dictionary, extract, reports
from entitylake.schemas import COUNT, COUNTS_REPORT, ENTITY, NEXT_LINK, PAGE_NUMBER, VALUE
from entitylake.session import scratch_dir
from entitylake.sources import csvfiles, pageindex, pages, snapshots, tables, versions
from entitylake.sources import documents as document_files
from entitylake.streaming import arrivals
from entitylake.suite import roles
from entitylake.suite.roles import SNAPSHOT_ARRIVAL, Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = datetime(2024, 1, 30)
TTL = timedelta(days=1)
PAGE = 500


def registered(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Tables(spark, folder))

    QUERIES[build.__name__] = run
    return build


# --- query options --------------------------------------------------------


@registered
def q_select(t: Tables) -> DataFrame:
    return query.query(t.orders, select="o_orderkey, o_orderstatus")


@registered
def q_filter(t: Tables) -> DataFrame:
    wanted = "o_totalprice > 100000 AND o_orderpriority = '1-URGENT'"
    return query.query(t.orders, select="o_orderkey", filter=wanted)


@registered
def q_filter_eq(t: Tables) -> DataFrame:
    return query.query(t.orders, select="o_orderkey,o_totalprice", filter=query.equals("o_orderstatus", "F"))


@registered
def q_orderby(t: Tables) -> DataFrame:
    chosen = "o_orderkey,o_orderdate,o_totalprice"
    return query.query(t.orders, select=chosen, orderby="o_orderdate, o_totalprice desc, o_orderkey")


@registered
def q_position(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    numbered = numbering.number_rows(rows, "o_orderdate, o_totalprice desc, o_orderkey")
    return numbered.select("o_orderkey", "row_number")


@registered
def q_top(t: Tables) -> DataFrame:
    return query.query(t.orders, select="o_orderkey", orderby="o_orderkey", top=7)


@registered
def q_topk(t: Tables) -> DataFrame:
    chosen = "o_orderkey,o_totalprice"
    return query.query(t.orders, select=chosen, orderby="o_totalprice desc, o_orderkey", top=25)


@registered
def q_count(t: Tables) -> DataFrame:
    counted = query.counted(t.orders, "o_orderpriority = '1-URGENT'")
    return counted.withColumnRenamed(COUNT, "odata_count")


@registered
def q_count_inline(t: Tables) -> DataFrame:
    rows = query.query(
        t.orders, select="o_orderkey", filter="o_orderpriority = '1-URGENT'", orderby="o_orderkey", top=10, count=True
    )
    return rows.withColumnRenamed(COUNT, "odata_count")


def _customer(t: Tables) -> query.Navigation:
    return query.Navigation("customer", t.customer, "o_custkey", "c_custkey", select="c_name")


def _orders(t: Tables, **options: object) -> query.Navigation:
    return query.Navigation(
        "orders", t.orders, "c_custkey", "o_custkey", many=True, select="o_orderkey",
        order_by=["o_orderkey"], key=["o_orderkey"], **options,
    )


@registered
def q_combined(t: Tables) -> DataFrame:
    rows = query.query(
        t.orders,
        select="o_orderkey,o_totalprice",
        filter="o_orderpriority = '1-URGENT'",
        orderby="o_totalprice desc, o_orderkey",
        top=20,
        expand=_customer(t),
        count=True,
    )
    return rows.select("o_orderkey", "o_totalprice", "customer.c_name", c.named(COUNT).alias("odata_count"))


@registered
def expand_one(t: Tables) -> DataFrame:
    region = query.Navigation("region", t.region, "n_regionkey", "r_regionkey")
    nation = query.Navigation("nation", query.query(t.nation, expand=region), "c_nationkey", "n_nationkey")
    rows = query.query(t.customer, expand=nation)
    return rows.select("c_custkey", "nation.n_name", "nation.region.r_name")


@registered
def expand_many(t: Tables) -> DataFrame:
    rows = query.query(t.customer, select="c_custkey", expand=_orders(t))
    return rows.select("c_custkey", _listed("orders.o_orderkey").alias("children"))


def _listed(keys: str) -> Column:
    return F.array_join(F.transform(F.col(keys), lambda key: key.cast("string")), " ")


@registered
def expand_pages(t: Tables) -> DataFrame:
    nav = query.Navigation(
        "orders", t.orders, "c_custkey", "o_custkey", many=True, select="o_orderkey",
        order_by=["o_totalprice", "o_orderkey"], max_items=4,
    )
    rows = query.query(t.customer, select="c_custkey", expand=nav)
    return rows.select("c_custkey", c.named("orders@page").alias("page"), _listed("orders.o_orderkey").alias("children"))


@registered
def top_large(t: Tables) -> DataFrame:
    order = "l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"
    half = t.lineitem.count() // 2
    chosen = "l_orderkey,l_linenumber,l_extendedprice"
    return query.query(t.lineitem, select=chosen, orderby=order, top=half, one_task=1000)


@registered
def expand_count(t: Tables) -> DataFrame:
    rows = query.query(t.customer, select="c_custkey", expand=_orders(t, count_only=True))
    return rows.withColumnRenamed(f"orders{COUNT}", "n_children")


@registered
def get_by_key(t: Tables) -> DataFrame:
    return query.get_by_key(t.conversations, {"conv_id": 0, "turn": 0}, select="conv_id,turn,role")


# --- collections, reshaping -----------------------------------------------


@registered
def scan_collection(t: Tables) -> DataFrame:
    return tables.read_collection(t.spark, t.folder, "orders")


def _scanned(t: Tables) -> DataFrame:
    return tables.scan_many({"customer": t.customer, "supplier": t.supplier, "part": t.part, "orders": t.orders})


@registered
def scan_many(t: Tables) -> DataFrame:
    return tables.read_many(t.spark, t.folder, ["customer", "supplier", "part", "orders"])


@registered
def scan_union(t: Tables) -> DataFrame:
    return _scanned(t)


@registered
def allow_list(t: Tables) -> DataFrame:
    every = tables.read_many(t.spark, t.folder, ["customer", "supplier", "part", "orders"])
    return reshape.only_entities(every, ["customer", "supplier", "part"])


def _without_prefix(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(name).alias(name.split("_", 1)[1]) for name in df.columns])


@registered
def union_entities(t: Tables) -> DataFrame:
    return reshape.union_entities(
        {"customer": _without_prefix(t.customer), "supplier": _without_prefix(t.supplier)}
    )


@registered
def flatten_json(t: Tables) -> DataFrame:
    nested = t.events.select("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    return reshape.flatten(nested).withColumnRenamed("props.k", "props_k")


@registered
def keep_columns(t: Tables) -> DataFrame:
    return reshape.keep_columns(t.part, ["p_brand", "p_partkey", "p_size"])


def _annotated(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    printed = F.when(status == "F", "Finished").when(status == "O", "Open").otherwise("Partial")
    return reshape.annotated(t.orders.select("o_orderkey", "o_orderstatus"), {"o_orderstatus": printed})


@registered
def annotations_on(t: Tables) -> DataFrame:
    return reshape.annotations(_annotated(t), include=True)


@registered
def annotations_off(t: Tables) -> DataFrame:
    return reshape.annotations(_annotated(t), include=False)


@registered
def scalar_suite(t: Tables) -> DataFrame:
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        c.lowered(F.col("p_brand")).alias("s1"),
        c.without_spaces(F.col("p_name")).alias("s2"),
        F.length("p_name").cast("bigint").alias("s3"),
        F.contains("p_name", F.lit("ring")).alias("s4"),
        c.part_of(F.col("p_name"), " ", 2).alias("s5"),
        paging.estimated_pages(size, 7).alias("s6a"),
        paging.estimated_pages(size, 4, "ratio").alias("s6b"),
        (paging.estimated_pages(size, 7, "floor_plus_one") - 1).alias("s6c"),
        size.cast("string").cast("bigint").alias("s7"),
        c.text_or(F.nullif("p_type", F.lit("PROMO")), "").alias("s8"),
        c.page_file(F.col("p_brand"), size).alias("s14"),
    )


# --- paging ---------------------------------------------------------------


@registered
def paginate(t: Tables) -> DataFrame:
    return paging.paginate(t.events, "event_id").select("event_id", PAGE_NUMBER)


@registered
def paginate_composite(t: Tables) -> DataFrame:
    rows = paging.paginate(t.orders, "o_orderpriority, o_orderdate desc, o_orderkey", size=PAGE)
    return rows.select("o_orderkey", PAGE_NUMBER, paging.POSITION)


@registered
def paginate_lines(t: Tables) -> DataFrame:
    order = "l_orderkey, l_linenumber, l_shipdate desc, l_partkey, l_suppkey, l_extendedprice"
    rows = paging.paginate(t.lineitem, order)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", PAGE_NUMBER, paging.POSITION)


@registered
def paginate_blocks(t: Tables) -> DataFrame:
    order = "o_orderpriority, o_orderdate desc, o_orderkey"
    rows = paging.paginate(t.orders, order, size=PAGE, rows_per_block=2 * PAGE)
    return rows.select("o_orderkey", PAGE_NUMBER, paging.POSITION)


@registered
def all_pages(t: Tables) -> DataFrame:
    return _outline(paging.all_pages(t.events, "events", "event_id"))


@registered
def all_pages_blocks(t: Tables) -> DataFrame:
    return _outline(paging.all_pages(t.events, "events", "event_id", 100, rows_per_block=500))


def _outline(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(
        PAGE_NUMBER,
        F.size(VALUE).cast("bigint").alias("n_records"),
        F.try_element_at(VALUE, F.lit(1))["event_id"].alias("first_id"),
        F.try_element_at(VALUE, F.lit(-1))["event_id"].alias("last_id"),
        c.named(NEXT_LINK).alias("next_link"),
    )


@registered
def page_links(t: Tables) -> DataFrame:
    return paging.page_links(t.events, "events", size=100)


@registered
def first_page(t: Tables) -> DataFrame:
    return paging.first_page(t.events, "ts desc, event_id", size=100).select("event_id")


@registered
def next_page(t: Tables) -> DataFrame:
    order = "ts desc, event_id"
    first = paging.first_page(t.events, order, size=100)
    return paging.next_page(t.events, order, paging.last_key(first, order), size=100).select("event_id")


@registered
def page_estimate(t: Tables) -> DataFrame:
    n = F.col("record_count")
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("record_count"))
    return counts.select(
        "o_custkey",
        "record_count",
        paging.estimated_pages(n, 5).alias("est_pages_ceil"),
        paging.estimated_pages(n, 5, "floor_plus_one").alias("est_pages_floor1"),
        paging.estimated_pages(n, paging.UNSET_PAGE_SIZE, "ratio").alias("est_pages_default"),
    )


# --- page lake ------------------------------------------------------------


def _saved_pages(t: Tables, *names: str) -> str:
    path = scratch_dir(t.spark, "pages")
    chosen = {name: one for name, one in roles.collections(t).items() if name in names}
    pages.write_pages(
        [paging.all_pages(one.df, name, one.order_by, PAGE) for name, one in chosen.items()], path
    )
    return path


@registered
def read_pages(t: Tables) -> DataFrame:
    saved = pages.read_pages(t.spark, _saved_pages(t, "customer", "part"), t.part.schema, "part")
    return saved.select(
        ENTITY, PAGE_NUMBER, F.size(VALUE).cast("bigint").alias("n_records"), c.named(NEXT_LINK).alias("next_link")
    )


def _indexed_lake(t: Tables) -> str:
    """Lines in pages of 500, ten pages to a block."""
    path = scratch_dir(t.spark, "pages")
    pageindex.save_entity(t.lineitem, "lineitem", LINES, path, PAGE, rows_per_block=10 * PAGE)
    return path


LINES = "l_orderkey, l_linenumber, l_shipdate desc, l_partkey, l_suppkey, l_extendedprice"
LINE_FIELDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]


@registered
def saved_page(t: Tables) -> DataFrame:
    """The middle page of a saved entity, and the one that its link names."""
    path, schema = _indexed_lake(t), t.lineitem.schema
    middle = pageindex.read_index(t.spark, path, "lineitem").agg(F.max("last_page")).first()[0] // 2
    found = pageindex.saved_pages(t.spark, path, "lineitem", middle, record=schema)
    behind = pageindex.followed(t.spark, path, found.select(c.named(NEXT_LINK)).first()[0], schema)
    return paging.unpage(found.union(behind)).select(PAGE_NUMBER, paging.POSITION, *LINE_FIELDS)


@registered
def saved_page_behind(t: Tables) -> DataFrame:
    """The records behind a key in the last quarter of a saved entity; they cross a block's end."""
    path, schema = _indexed_lake(t), t.lineitem.schema
    number = pageindex.read_index(t.spark, path, "lineitem").agg(F.max("last_page")).first()[0] * 3 // 4
    page = paging.unpage(pageindex.saved_pages(t.spark, path, "lineitem", number, record=schema))
    last = paging.last_key(page, LINES)
    found = pageindex.saved_page_behind(t.spark, path, "lineitem", schema, LINES, last, 12 * PAGE)
    return found.select(*LINE_FIELDS)


@registered
def unpage(t: Tables) -> DataFrame:
    saved = pages.read_pages(t.spark, _saved_pages(t, "documents"), t.documents.schema, "documents")
    return paging.unpage(saved).select(PAGE_NUMBER, paging.POSITION, *t.documents.columns)


def _damaged_lake(t: Tables) -> str:
    """Pages of events as they may land: some are error envelopes, cut off, or have a bad field."""
    path = scratch_dir(t.spark, "arrivals")
    pages_made = paging.all_pages(t.events, "events", "event_id", 100)
    number = F.col(PAGE_NUMBER)
    body = F.struct(F.lit("E1").alias("code"), F.concat(F.lit("page "), number).alias("message"))
    failure = json_text(F.struct(number, body.alias("error")))
    whole = json_text(F.struct(PAGE_NUMBER, VALUE))
    line = (
        F.when(number % 5 == 0, failure)
        .when(number % 7 == 0, F.substring(whole, F.lit(1), F.length(whole) - 2))
        .when(number % 11 == 0, F.regexp_replace(whole, '"user_id":[0-9]+', '"user_id":"x"'))
        .otherwise(whole)
    )
    pages.write_lines([pages_made.select(ENTITY, line.alias(pages.LINE)).repartition(4)], path)
    return path


def _good_and_aside(good: DataFrame, aside: DataFrame) -> DataFrame:
    number = F.regexp_extract(F.coalesce("text", "message"), r'(?:"page_number":|page )(\d+)', 1).cast("bigint")
    event = F.lit(None).cast("bigint").alias("event_id")
    return good.select(PAGE_NUMBER, "event_id", F.lit("ok").alias(documents.STATUS)).union(
        aside.select(number.alias(PAGE_NUMBER), event, documents.STATUS)
    )


@registered
def unpage_quarantine(t: Tables) -> DataFrame:
    saved = pages.read_pages(t.spark, _damaged_lake(t), t.events.schema, "events")
    return _good_and_aside(paging.unpage(saved), pages.set_aside(saved))


@registered
def page_roundtrip(t: Tables) -> DataFrame:
    saved = pages.read_pages(t.spark, _saved_pages(t, "orders"), t.orders.schema, "orders")
    return paging.records_of(saved)


@registered
def record_sink_roundtrip(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "records")
    pages.write_records({"events": t.events, "nation": t.nation}, path)
    return pages.read_records(t.spark, path, t.events.schema, "events")


@registered
def page_stats(t: Tables) -> DataFrame:
    names = ["customer", "supplier", "part"]
    saved = pages.read_pages(t.spark, _saved_pages(t, *names))
    counts = catalog.entity_counts({name: roles.collections(t)[name].df for name in names})
    return paging.page_stats(saved, counts, PAGE)


@registered
def attribute_listing_json(t: Tables) -> DataFrame:
    saved = pages.read_pages(t.spark, _saved_pages(t, "orders", "customer"))
    return catalog.json_field_listing(pages.json_records(saved))


@registered
def attribute_types_json(t: Tables) -> DataFrame:
    saved = pages.read_pages(t.spark, _saved_pages(t, "orders", "customer"))
    found = variants.field_types(pages.json_records(saved))
    return found.select(ENTITY, "field", "n_records", "n_nulls", variants.kind(F.col("type")).alias("kind"))


@registered
def found_schema(t: Tables) -> DataFrame:
    records = pages.json_records(pages.read_pages(t.spark, _saved_pages(t, "orders", "customer")))
    rows = variants.typed(records, variants.found_schemas(records)["orders"], "orders")
    return rows.select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_totalprice").cast("double").alias("o_totalprice"))


# --- catalogue ------------------------------------------------------------


@registered
def name_harvest(t: Tables) -> DataFrame:
    return catalog.harvest_names(roles.part_definitions(t)).select("MetadataId", "kind", "name")


@registered
def name_harvest_short(t: Tables) -> DataFrame:
    return catalog.harvest_names(roles.part_definitions(t), short=True).select("MetadataId", "kind", "name")


@registered
def label_fallback(t: Tables) -> DataFrame:
    name, description = labels.report_labels(F.col("LogicalName"))
    return roles.customer_definitions(t).select(
        F.col("LogicalName").alias("entity"), name.alias("display_name"), description.alias("description")
    )


@registered
def description_label(t: Tables) -> DataFrame:
    return roles.customer_definitions(t).select(
        F.col("LogicalName").alias("entity"), labels.description_label().alias("description")
    )


@registered
def endpoint_longest(t: Tables) -> DataFrame:
    return catalog.resolve_endpoints(roles.part_definitions(t), roles.part_endpoints(t))


@registered
def endpoint_longest_short(t: Tables) -> DataFrame:
    available = roles.part_endpoints(t).union(
        t.part.filter("p_size > 48").select(c.without_spaces(F.lower("p_name")).alias("name"))
    )
    return catalog.resolve_endpoints(roles.part_definitions(t), available, short=True)


@registered
def endpoint_priority(t: Tables) -> DataFrame:
    definitions = roles.part_definitions(t)
    available = t.part.filter("p_type in ('SMALL', 'STANDARD')").select(F.col("p_type").alias("name")).union(
        t.part.filter("p_retailprice > 1000 and p_size < 3").select("p_brand")
    )
    return catalog.resolve_endpoints(definitions, available, rule="priority")


@registered
def endpoint_remaining(t: Tables) -> DataFrame:
    known = t.part.filter("p_size > 40").select(
        F.col("p_partkey").cast("string").alias("MetadataId"), F.lit("known").alias("endpoint")
    )
    return catalog.resolve_remaining(roles.part_definitions(t), known, roles.part_endpoints(t))


@registered
def record_counts(t: Tables) -> DataFrame:
    return catalog.record_counts(roles.customer_definitions(t), roles.order_snapshots(t), SNAPSHOT_ARRIVAL)


@registered
def record_count_default(t: Tables) -> DataFrame:
    counts = catalog.record_counts_or_zero(
        roles.customer_definitions(t), roles.order_snapshots(t), SNAPSHOT_ARRIVAL
    )
    return counts.select(ENTITY, "record_count", "last_updated")


@registered
def strict_lookup(t: Tables) -> DataFrame:
    found = catalog.strict_lookup(t.orders, t.customer, "o_custkey", "c_custkey")
    return found.select("o_orderkey", "c_name")


@registered
def entity_counts(t: Tables) -> DataFrame:
    frames = {"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem, "events": t.events}
    return catalog.entity_counts(frames, {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"})


def _listing(t: Tables) -> DataFrame:
    return catalog.field_listing({"orders": t.orders, "lineitem": t.lineitem, "events": t.events})


@registered
def attribute_listing(t: Tables) -> DataFrame:
    return _listing(t)


@registered
def date_fields(t: Tables) -> DataFrame:
    return catalog.time_fields(_listing(t))


@registered
def entity_profile(t: Tables) -> DataFrame:
    definitions = roles.customer_definitions(t)
    available = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(F.lower("c_mktsegment").alias("name"))
    endpoints = catalog.resolve_endpoints(definitions, available, rule="priority")
    counts = catalog.record_counts_or_zero(definitions, roles.order_snapshots(t), SNAPSHOT_ARRIVAL)
    behind = {"building": t.orders, "household": t.lineitem, "automobile": t.events.withColumnRenamed("ts", "updatetime")}
    fields = catalog.time_fields(catalog.field_listing(behind))
    rows = catalog.entity_profile(
        definitions, endpoints, counts, fields, names=catalog.harvest_names(definitions)
    )
    lists = [F.array_join(name, ";").alias(name) for name in ("date_fields", "time_fields", "names")]
    return rows.select(ENTITY, "endpoint", "record_count", "estimated_pages", *lists, "label", "catalog_size")


@registered
def attribute_profile(t: Tables) -> DataFrame:
    return profile.attribute_profiles({"customer": t.customer, "orders": t.orders, "pages": t.pages})


# --- keyed tables and snapshots -------------------------------------------


@registered
def last_wins(t: Tables) -> DataFrame:
    arrival = "l_shipdate, l_partkey, l_suppkey, l_extendedprice"
    rows = upsert.last_wins(t.lineitem, ["l_orderkey", "l_linenumber"], arrival)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


@registered
def skip_done(t: Tables) -> DataFrame:
    return upsert.skip_done(t.documents, t.labels, ["doc_id"]).select("doc_id", "source")


@registered
def fresh_rows(t: Tables) -> DataFrame:
    return upsert.fresh_rows(t.events, "ts", AS_OF, TTL).select("event_id", "ts")


@registered
def stale_rows(t: Tables) -> DataFrame:
    return upsert.stale_rows(t.events, "ts", AS_OF, TTL).select("event_id", "ts")


@registered
def snapshot_upsert(t: Tables) -> DataFrame:
    first, second = scratch_dir(t.spark, "snapshot"), scratch_dir(t.spark, "snapshot")
    base = t.customer.select(
        F.col("c_custkey").alias("code"), F.col("c_acctbal").alias("balance"), F.lit(0).alias("arrived")
    )
    newer = t.supplier.select(
        F.col("s_suppkey").alias("code"), F.col("s_acctbal").alias("balance"), F.lit(1).alias("arrived")
    )
    again = newer.select("code", (F.col("balance") + 1).alias("balance"), F.lit(2).alias("arrived"))
    snapshots.write_snapshot(base, first, keys=("code",))
    snapshots.write_snapshot(again.union(newer), second, current=first, keys=("code",), arrival="arrived")
    return t.spark.read.schema(base.schema).parquet(second).select("code", "balance")


def _order_snapshot(t: Tables, orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("o_orderstatus", "o_custkey").agg(
        F.count("*").alias("n"), F.max("o_orderdate").alias("latest")
    )
    return snapshots.snapshot_rows(counts, F.col("o_orderstatus"), F.col("o_custkey"), F.col("n"), F.col("latest"))


@registered
def snapshot_load(t: Tables) -> DataFrame:
    path, rows = scratch_dir(t.spark, "snapshot"), _order_snapshot(t, t.orders)
    versions.commit(rows, path)
    loaded = versions.read_version(t.spark, path, rows.schema, "F")
    return loaded.select("entity", "record_count", "last_updated")


@registered
def snapshot_versions(t: Tables) -> DataFrame:
    """Two versions of a snapshot; the second replaces one environment and adds one."""
    path, rows = scratch_dir(t.spark, "snapshot"), _order_snapshot(t, t.orders)
    versions.commit(rows, path)
    urgent = t.orders.filter("o_orderpriority = '1-URGENT' and o_orderstatus <> 'F'")
    renamed = F.when(F.col("o_orderstatus") == "P", "N").otherwise(F.col("o_orderstatus"))
    versions.commit(_order_snapshot(t, urgent.withColumn("o_orderstatus", renamed)), path)
    both = [versions.read_version(t.spark, path, rows.schema, version=i).withColumn("version", F.lit(i)) for i in (1, 2)]
    return both[0].union(both[1]).select("version", "base_url", "entity", "record_count", "last_updated")


@registered
def map_to_rows(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "environments")
    snapshots.write_environments(snapshots.count_documents(_customer_counts(t), max_entries=100), path)
    saved = snapshots.read_environments(t.spark, path, whole_files=False)
    return reports.counts_of(snapshots.environment(saved, "HOUSEHOLD"))


def _customer_counts(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_mktsegment").alias("base_url"), F.col("c_name").alias(ENTITY),
        F.col("c_custkey").alias("record_count"), F.lit(None).cast("string").alias("last_updated"),
    )


@registered
def environment_upsert(t: Tables) -> DataFrame:
    first, second = scratch_dir(t.spark, "environments"), scratch_dir(t.spark, "environments")
    snapshots.write_environments(snapshots.count_documents(_customer_counts(t), max_entries=100), first)
    url = F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("SUPPLIERS")
    newer = t.supplier.select(
        url.alias("base_url"), F.col("s_name").alias(ENTITY), F.col("s_suppkey").alias("record_count"),
        F.lit("2024-01-01 00:00:00").alias("last_updated"),
    )
    snapshots.upsert_environments(snapshots.count_documents(newer, max_entries=100), second, first)
    saved = snapshots.read_environments(t.spark, second, whole_files=False)
    entries = reshape.map_rows(saved.select("base_url", "record_counts"), "record_counts", ENTITY, "state")
    return entries.select("base_url", ENTITY, "state.record_count", "state.last_updated")


# --- JSON documents, CSV --------------------------------------------------


def _landed(t: Tables) -> DataFrame:
    """Events as JSON documents: some cut off, some error envelopes."""
    whole = json_text(F.struct("event_id", "user_id", "value", "ts"))
    message = F.concat(F.lit('"event_id":'), F.col("event_id"))
    failure = json_text(F.struct(F.struct(F.lit("E1").alias("code"), message.alias("message")).alias("error")))
    kind = F.col("event_type")
    body = F.when(kind == "error", failure).when(kind == "signup", F.substring(whole, F.lit(1), F.length(whole) - 1))
    return t.events.select("event_id", body.otherwise(whole).alias("body"))


DOCUMENT = "event_id bigint, user_id bigint, value double, ts timestamp_ntz"


@registered
def error_split(t: Tables) -> DataFrame:
    parsed = documents.parse_documents(_landed(t), "body", T.StructType.fromDDL(DOCUMENT))
    good, bad = documents.data_only(parsed), documents.quarantine(parsed)
    chosen = ["event_id", documents.STATUS, "document.value", "error.code"]
    return good.select(*chosen).unionByName(bad.select(*chosen))


@registered
def tolerant_read(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "landed")
    _landed(t).select(F.col("body").alias("value")).write.text(path)
    parsed = document_files.read_documents(t.spark, path, T.StructType.fromDDL(DOCUMENT))
    found = F.regexp_extract(F.col("raw"), r'event_id\\?":(\d+)', 1).cast("bigint")
    return parsed.select(found.alias("event_id"), documents.STATUS, "document.user_id", "document.ts")


def _worklist(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    joined = t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        F.col("c_custkey").cast("string").alias("Entity"),
        F.col("c_name").alias("LogicalName"),
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("Name"),
        F.col("c_mktsegment").alias("Description"),
        F.coalesce("n", F.lit(0)).alias("Count"),
    )


@registered
def csv_worklist(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "worklist")
    csvfiles.write_csv(_worklist(t), path)
    return csvfiles.read_csv(t.spark, path, COUNTS_REPORT)


@registered
def csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "csv")
    csvfiles.write_csv(t.documents, path, escaped=True)
    return csvfiles.read_csv(t.spark, path, t.documents.schema, escaped=True)


@registered
def worklist_filter(t: Tables) -> DataFrame:
    counts = catalog.record_counts_or_zero(
        roles.customer_definitions(t), roles.order_snapshots(t), SNAPSHOT_ARRIVAL
    )
    return extract.wanted(counts, "record_count", ENTITY).select(ENTITY, "record_count")


@registered
def worklist_order(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("cnt"))
    named = catalog.strict_lookup(counts, t.customer, "o_custkey", "c_custkey").select("c_name", "cnt")
    ordered = extract.smallest_first(named, "cnt", "c_name").withColumn("place", F.monotonically_increasing_id())
    return ranking.ranked(ordered, "place", "turn").drop("place")


# --- streams --------------------------------------------------------------


def _event_lake(t: Tables) -> str:
    path = scratch_dir(t.spark, "arrivals")
    pages.write_pages(paging.all_pages(t.events, "events", "event_id", 100), path)
    return path


@registered
def stream_unpage(t: Tables) -> DataFrame:
    out, checkpoint = scratch_dir(t.spark, "records"), scratch_dir(t.spark, "stream")
    stream = arrivals.page_stream(t.spark, _event_lake(t), t.events.schema)
    arrivals.finish(arrivals.append_records(stream, out, checkpoint))
    return t.spark.read.parquet(out).select(*t.events.columns)


@registered
def stream_progress(t: Tables) -> DataFrame:
    out, checkpoint = scratch_dir(t.spark, "progress"), scratch_dir(t.spark, "stream")
    stream = arrivals.page_stream(t.spark, _event_lake(t))
    arrivals.finish(arrivals.write_progress(stream, out, checkpoint))
    return arrivals.latest_progress(t.spark, out)


def _landing_twice(t: Tables) -> str:
    """The event lake, with every third page a second time under another name."""
    path = _event_lake(t)
    again = pages.read_pages(t.spark, path, t.events.schema).filter(F.col(PAGE_NUMBER) % 3 == 0)
    lines = pages.page_lines(again.select(ENTITY, PAGE_NUMBER, VALUE, c.named(NEXT_LINK)))
    lines.write.mode("append").partitionBy(ENTITY).text(path)
    return path


@registered
def stream_unpage_again(t: Tables) -> DataFrame:
    out, checkpoint = scratch_dir(t.spark, "records"), scratch_dir(t.spark, "stream")
    stream = arrivals.page_stream(t.spark, _landing_twice(t), t.events.schema, files_per_trigger=4)
    arrivals.finish(arrivals.append_records(stream, out, checkpoint))
    return t.spark.read.parquet(out).select(*t.events.columns)


@registered
def stream_progress_again(t: Tables) -> DataFrame:
    out, checkpoint = scratch_dir(t.spark, "progress"), scratch_dir(t.spark, "stream")
    stream = arrivals.page_stream(t.spark, _landing_twice(t), files_per_trigger=4)
    arrivals.finish(arrivals.write_progress(stream, out, checkpoint))
    return arrivals.latest_progress(t.spark, out)


@registered
def stream_quarantine(t: Tables) -> DataFrame:
    lake, good, aside = _damaged_lake(t), scratch_dir(t.spark, "records"), scratch_dir(t.spark, "aside")
    for start, out in ((arrivals.append_records, good), (arrivals.append_set_aside, aside)):
        stream = arrivals.page_stream(t.spark, lake, t.events.schema, files_per_trigger=1)
        arrivals.finish(start(stream, out, scratch_dir(t.spark, "stream")))
    return _good_and_aside(t.spark.read.parquet(good), t.spark.read.parquet(aside))


# --- composites -----------------------------------------------------------


def _page_sizes(t: Tables, path: str) -> DataFrame:
    saved = pages.read_pages(t.spark, path)
    return saved.select(
        ENTITY, PAGE_NUMBER, F.size(VALUE).cast("bigint").alias("n_records"), c.named(NEXT_LINK).alias("next_link")
    )


@registered
def extract_all(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "lake")
    extract.extract_all(
        roles.collection_definitions(t), roles.collection_snapshots(t), roles.collections(t), path, PAGE
    )
    return _page_sizes(t, path)


@registered
def extract_resumed(t: Tables) -> DataFrame:
    """An extraction that got as far as two entities, and is started again under its name."""
    path = scratch_dir(t.spark, "lake")
    catalogue = roles.collection_definitions(t), roles.collection_snapshots(t)
    whole = roles.collections(t)
    extract.extract_all(*catalogue, {name: whole[name] for name in ("customer", "supplier")}, path, PAGE, run="nightly")
    again = extract.extract_all(*catalogue, whole, path, PAGE, run="nightly")
    return _page_sizes(t, path).withColumn("second_time", F.col(ENTITY).isin(again))


@registered
def csv_driven_extract(t: Tables) -> DataFrame:
    path, csv_path = scratch_dir(t.spark, "lake"), scratch_dir(t.spark, "worklist")
    counts = catalog.entity_counts({name: one.df for name, one in roles.collections(t).items()})
    skipped = F.when(F.col(ENTITY) == "supplier", F.lit(0)).otherwise(F.col("record_count"))
    null = F.lit(None).cast("string")
    csvfiles.write_csv(
        counts.select(
            F.col(ENTITY).alias("Entity"), F.col(ENTITY).alias("LogicalName"), F.col(ENTITY).alias("Name"),
            null.alias("Description"), skipped.alias("Count"),
        ),
        csv_path,
    )
    extract.extract_from_csv(
        t.spark, csv_path, roles.collection_definitions(t), roles.collections(t), path, PAGE
    )
    return _page_sizes(t, path)


@registered
def counts_report(t: Tables) -> DataFrame:
    definitions = roles.customer_definitions(t)
    counts = catalog.record_counts(definitions, roles.order_snapshots(t), SNAPSHOT_ARRIVAL)
    return reports.counts_report(counts.select(ENTITY, "record_count"), definitions)


@registered
def attribute_dictionary(t: Tables) -> DataFrame:
    frames = {"customer": t.customer, "orders": t.orders, "part": t.part, "pages": t.pages}
    table = dictionary.attribute_dictionary(
        frames,
        ["customer", "orders", "pages"],
        scratch_dir(t.spark, "attributes"),
        targets={"orders": {"o_custkey": ["customer"]}, "customer": {"c_nationkey": ["nation"]}},
    )
    return table.select(
        F.col("EntityLogicalName").alias("entity"),
        F.col("SchemaName").alias("field"),
        c.named("DisplayName.UserLocalizedLabel.Label").alias("display_name"),
        F.col("AttributeType").alias("attribute_type"),
        F.col("MaxLength").alias("max_length"),
        F.col("DatabaseLength").alias("database_length"),
        F.col("MinValue").alias("min_value"),
        F.col("MaxValue").alias("max_value"),
        F.col("MinSupportedValue").alias("min_time"),
        F.col("MaxSupportedValue").alias("max_time"),
        F.col("IsPrimaryId").alias("is_unique"),
        F.array_join("Targets", ";").alias("targets"),
    )


__all__ = ["QUERIES"]
