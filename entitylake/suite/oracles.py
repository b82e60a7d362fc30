"""Equivalent SQL for the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

PAGE = 500

# Columns of the tables whose fields are listed or profiled.
COLUMNS = {
    "customer": {
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderdate": "timestamp", "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp",
    },
    "events": {
        "event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "string", "value": "double",
        "props": "string",
    },
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
}
TYPE_NAMES = {
    "bigint": "BigInt", "int": "Integer", "double": "Double", "string": "String", "timestamp": "DateTime",
}


def _page(order: str, size: int) -> str:
    return f"CAST(floor((row_number() OVER (ORDER BY {order}) - 1) / {size}) + 1 AS BIGINT)"


def _pages(entity: str, key: str) -> str:
    """Pages of an entity: number, size and link."""
    return f"""SELECT '{entity}' AS entity, page_number, count(*) AS n_records,
    CASE WHEN page_number < max(page_number) OVER ()
         THEN concat('{entity}?page=', CAST(page_number + 1 AS VARCHAR)) END AS next_link
    FROM (SELECT {_page(key, PAGE)} AS page_number FROM {entity}) GROUP BY page_number"""


LINES_IN_ORDER = f"""SELECT *, (rn + {PAGE - 1}) // {PAGE} AS page_number, (count(*) OVER () + {PAGE - 1}) // {PAGE} AS pages
    FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_shipdate DESC, l_partkey, l_suppkey,
          l_extendedprice) AS rn FROM lineitem)"""


def _fields(*entities: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{name}' AS field, count({name}) AS n_records FROM {entity}"
        for entity in entities
        for name in COLUMNS[entity]
    )


def _json_types(*entities: str) -> str:
    """Fields of records as JSON text: numbers with a decimal point are decimals, times are texts."""
    return " UNION ALL ".join(
        f"""SELECT '{entity}' AS entity, '{name}' AS field, count(*) AS n_records, count(*) - count({name}) AS n_nulls,
            CASE WHEN count({name}) = 0 THEN 'VOID' WHEN any_value(typeof({name})) IN ('BIGINT', 'INTEGER') THEN 'BIGINT'
                 WHEN any_value(typeof({name})) = 'DOUBLE' THEN 'DECIMAL' ELSE 'STRING' END AS kind FROM {entity}"""
        for entity in entities
        for name in COLUMNS[entity]
    )


def _measures(name: str, type_: str) -> dict[str, str]:
    text, time, number = type_ == "string", type_ == "timestamp", type_ in ("bigint", "int", "double")
    found = {
        "max_length": (text, f"max(length({name}))", "BIGINT"),
        "database_length": (text, f"max(strlen({name}))", "BIGINT"),
        "min_value": (number, f"min({name})", "DOUBLE"),
        "max_value": (number, f"max({name})", "DOUBLE"),
        "min_exact": (type_ in ("bigint", "int"), f"min({name})", "VARCHAR"),
        "max_exact": (type_ in ("bigint", "int"), f"max({name})", "VARCHAR"),
        "min_time": (time, f"min({name})", "VARCHAR"),
        "max_time": (time, f"max({name})", "VARCHAR"),
    }
    return {out: f"CAST({sql if there else 'NULL'} AS {type_})" for out, (there, sql, type_) in found.items()}


def _unique(name: str) -> str:
    return f"count(DISTINCT {name}) = count(*)"


def _profile(entity: str, name: str, type_: str) -> str:
    measures = ", ".join(f"{sql} AS {out}" for out, sql in _measures(name, type_).items())
    return f"""SELECT '{entity}' AS entity, '{name}' AS field, '{TYPE_NAMES[type_]}' AS attribute_type,
    count({name}) AS n_records, count(*) - count({name}) AS n_nulls, {measures},
    CAST(NULL AS INTEGER) AS "precision", {_unique(name)} AS is_unique FROM {entity}"""


TARGETS = {("orders", "o_custkey"): "customer", ("customer", "c_nationkey"): "nation"}


def _documented(entity: str, name: str, type_: str) -> str:
    kept = {out: sql for out, sql in _measures(name, type_).items() if not out.endswith("exact")}
    measures = ", ".join(f"{sql} AS {out}" for out, sql in kept.items())
    target = TARGETS.get((entity, name))
    kind = "Lookup" if target else TYPE_NAMES[type_]
    label = " ".join(word.capitalize() for word in name.split("_"))
    return f"""SELECT '{entity}' AS entity, '{name}' AS field, '{label}' AS display_name,
    '{kind}' AS attribute_type, {measures}, {_unique(name)} AS is_unique,
    CAST({f"'{target}'" if target else "NULL"} AS VARCHAR) AS targets FROM {entity}"""


def _each(build, *entities: str) -> str:
    return " UNION ALL ".join(
        build(entity, name, type_) for entity in entities for name, type_ in COLUMNS[entity].items()
    )


# The newest order of each customer, as a count snapshot; some customers have another code.
CODE = "CASE WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END"
SNAPSHOTS = """(SELECT o_custkey AS code, CAST(floor(o_totalprice) AS BIGINT) AS cnt, o_orderdate AS updated
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""

BRANDS = "SELECT p_brand AS name FROM part WHERE p_retailprice > 1000 AND p_size < 3"
TYPES = "SELECT p_type AS name FROM part WHERE p_type IN ('SMALL', 'STANDARD')"
ENDPOINTS = f"(SELECT lower(name) AS name FROM ({BRANDS} UNION {TYPES}))"
NAMES = f"(SELECT DISTINCT replace(lower(p_name), ' ', '') AS name FROM part WHERE p_size > 48 UNION {ENDPOINTS})"


def _longest(candidates: dict[str, str], available: str) -> str:
    tried = " UNION ALL ".join(
        f"SELECT p_partkey, {sql} AS name FROM part WHERE {condition}" for sql, condition in candidates.items()
    )
    return f"""SELECT CAST(p.p_partkey AS VARCHAR) AS "MetadataId", e.name AS endpoint FROM part p LEFT JOIN (
    SELECT p_partkey, name FROM ({tried}) WHERE name IN (SELECT name FROM {available})
    QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(name) DESC, name) = 1
    ) e ON p.p_partkey = e.p_partkey"""


def _harvest(kinds: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST(p_partkey AS VARCHAR) AS "MetadataId", '{kind}' AS kind, CAST({sql} AS VARCHAR) AS name
        FROM part"""
        for kind, sql in kinds.items()
    )


LABELS = {
    "name": "CASE WHEN p_size <= 25 THEN p_name END",
    "collection": "CASE WHEN p_size <= 25 THEN p_type END",
}
LINES = "l_orderkey, l_linenumber, l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice"
STATUS = "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'corrupt' ELSE 'ok' END"
URGENT = "(SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT')"
DEFINED_LABEL = "CASE WHEN c.c_acctbal >= 0 THEN c.c_mktsegment ELSE 'None' END"
AVAILABLE = "CASE WHEN c.c_mktsegment <> 'MACHINERY' THEN lower(c.c_mktsegment) END"

# Pages of events with an error, cut off, or with a bad field are set aside, the others have their records.
DAMAGED = f"""WITH paged AS (SELECT event_id, {_page('event_id', 100)} AS page_number FROM events),
    marked AS (SELECT *, CASE WHEN page_number % 5 = 0 THEN 'error'
        WHEN page_number % 7 = 0 OR page_number % 11 = 0 THEN 'corrupt' ELSE 'ok' END AS status FROM paged)
    SELECT page_number, event_id, status FROM marked WHERE status = 'ok'
    UNION ALL SELECT DISTINCT page_number, CAST(NULL AS BIGINT), status FROM marked WHERE status <> 'ok'"""

ORACLES: dict[str, str] = {
    # query options
    "q_select": "SELECT o_orderkey, o_orderstatus FROM orders",
    "q_filter": "SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderpriority = '1-URGENT'",
    "q_filter_eq": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IS NOT DISTINCT FROM 'F'",
    "q_orderby": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY 2, 3 DESC, 1",
    "q_position": """SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_totalprice DESC, o_orderkey)
        AS BIGINT) AS row_number FROM orders""",
    "q_top": "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 7",
    "q_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "q_count": "SELECT count(*) AS odata_count FROM orders WHERE o_orderpriority = '1-URGENT'",
    "q_count_inline": f"""SELECT o_orderkey, {URGENT} AS odata_count FROM orders
        WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderkey LIMIT 10""",
    "q_combined": f"""SELECT o_orderkey, o_totalprice, c_name, {URGENT} AS odata_count
        FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)
        LEFT JOIN customer ON o_custkey = c_custkey""",
    "expand_one": """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "expand_many": """SELECT c_custkey, coalesce(string_agg(o_orderkey, ' ' ORDER BY o_orderkey), '') AS children
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "expand_pages": """SELECT c_custkey, page, coalesce(string_agg(o_orderkey, ' ' ORDER BY n), '') AS children
        FROM (SELECT *, CAST(floor((n - 1) / 4) + 1 AS INTEGER) AS page FROM (
            SELECT c_custkey, o_orderkey,
                row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice, o_orderkey) AS n
            FROM customer LEFT JOIN orders ON c_custkey = o_custkey)) GROUP BY c_custkey, page""",
    "top_large": """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
        LIMIT (SELECT count(*) // 2 FROM lineitem)""",
    "expand_count": """SELECT c_custkey, count(o_orderkey) AS n_children FROM customer
        LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "get_by_key": "SELECT conv_id, turn, role FROM conversations WHERE conv_id = 0 AND turn = 0",
    # collections, reshaping
    "scan_collection": "SELECT * FROM orders",
    "scan_many": " UNION ALL BY NAME ".join(
        f"SELECT '{entity}' AS entity, * FROM {entity}" for entity in ("customer", "supplier", "part", "orders")
    ),
    "scan_union": " UNION ALL BY NAME ".join(
        f"SELECT '{entity}' AS entity, * FROM {entity}" for entity in ("customer", "supplier", "part", "orders")
    ),
    "allow_list": f"""SELECT * FROM ({" UNION ALL BY NAME ".join(
        f"SELECT '{entity}' AS entity, * FROM {entity}" for entity in ("customer", "supplier", "part", "orders")
    )}) WHERE entity <> 'orders'""",
    "union_entities": """SELECT 'customer' AS entity, c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey,
        c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer
        UNION ALL BY NAME SELECT 'supplier' AS entity, s_suppkey AS suppkey, s_name AS name,
        s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier""",
    "flatten_json": """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k
        FROM events""",
    "keep_columns": "SELECT p_brand, p_partkey, p_size FROM part",
    "annotations_on": """SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'Finished'
        WHEN 'O' THEN 'Open' ELSE 'Partial' END AS "o_orderstatus@FormattedValue" FROM orders""",
    "annotations_off": "SELECT o_orderkey, o_orderstatus FROM orders",
    "scalar_suite": """SELECT p_partkey, lower(p_brand) AS s1, replace(p_name, ' ', '') AS s2,
        CAST(length(p_name) AS BIGINT) AS s3, p_name LIKE '%ring%' AS s4, split_part(p_name, ' ', 2) AS s5,
        CAST(ceil(p_size / 7.0) AS BIGINT) AS s6a, p_size / CAST(4 AS DOUBLE) AS s6b,
        CAST(floor(p_size / 7.0) AS BIGINT) AS s6c, CAST(CAST(p_size AS VARCHAR) AS BIGINT) AS s7,
        COALESCE(nullif(p_type, 'PROMO'), '') AS s8,
        concat(p_brand, '_page_', CAST(p_size AS VARCHAR), '.json') AS s14 FROM part""",
    # paging
    "paginate": f"SELECT event_id, {_page('event_id', 1000)} AS page_number FROM events",
    "paginate_composite": f"""SELECT o_orderkey,
        {_page('o_orderpriority, o_orderdate DESC, o_orderkey', PAGE)} AS page_number,
        CAST(row_number() OVER (ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey) AS BIGINT) AS position
        FROM orders""",
    "paginate_lines": f"""SELECT l_orderkey, l_linenumber, l_partkey, {_page(LINES, 1000)} AS page_number,
        CAST(row_number() OVER (ORDER BY {LINES}) AS BIGINT) AS position FROM lineitem""",
    "paginate_blocks": f"""SELECT o_orderkey,
        {_page('o_orderpriority, o_orderdate DESC, o_orderkey', PAGE)} AS page_number,
        CAST(row_number() OVER (ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey) AS BIGINT) AS position
        FROM orders""",
    "all_pages_blocks": f"""SELECT page_number, count(*) AS n_records, min(event_id) AS first_id,
        max(event_id) AS last_id, CASE WHEN page_number < max(page_number) OVER ()
             THEN concat('events?page=', CAST(page_number + 1 AS VARCHAR)) END AS next_link
        FROM (SELECT event_id, {_page('event_id', 100)} AS page_number FROM events) GROUP BY page_number""",
    "all_pages": f"""SELECT page_number, count(*) AS n_records, min(event_id) AS first_id, max(event_id) AS last_id,
        CASE WHEN page_number < max(page_number) OVER ()
             THEN concat('events?page=', CAST(page_number + 1 AS VARCHAR)) END AS next_link
        FROM (SELECT event_id, {_page('event_id', 1000)} AS page_number FROM events) GROUP BY page_number""",
    "page_links": f"""SELECT page_number, count(*) AS n_records, CASE WHEN page_number < max(page_number) OVER ()
             THEN concat('events?page=', CAST(page_number + 1 AS VARCHAR)) END AS next_link
        FROM (SELECT event_id, {_page('event_id', 100)} AS page_number FROM events) GROUP BY page_number""",
    "first_page": "SELECT event_id FROM events ORDER BY ts DESC, event_id LIMIT 100",
    "next_page": "SELECT event_id FROM events ORDER BY ts DESC, event_id LIMIT 100 OFFSET 100",
    "page_estimate": """SELECT o_custkey, count(*) AS record_count,
        CAST(ceil(count(*) / 5.0) AS BIGINT) AS est_pages_ceil,
        CAST(floor(count(*) / 5.0) + 1 AS BIGINT) AS est_pages_floor1,
        count(*) / CAST(5000 AS DOUBLE) AS est_pages_default FROM orders GROUP BY o_custkey""",
    # page lake
    "read_pages": _pages("part", "p_partkey"),
    "unpage": f"""SELECT page_number, CAST(rn - (page_number - 1) * {PAGE} - 1 AS INTEGER) AS position,
        doc_id, text, lang, source, n_chars
        FROM (SELECT *, {_page('doc_id', PAGE)} AS page_number, row_number() OVER (ORDER BY doc_id) AS rn
              FROM documents)""",
    "saved_page": f"""SELECT page_number, CAST(rn - (page_number - 1) * {PAGE} - 1 AS INTEGER) AS position,
        l_orderkey, l_linenumber, l_partkey, l_shipdate FROM ({LINES_IN_ORDER})
        WHERE page_number IN (pages // 2, pages // 2 + 1)""",
    "saved_page_behind": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM ({LINES_IN_ORDER})
        WHERE rn > pages * 3 // 4 * {PAGE} AND rn <= (pages * 3 // 4 + 12) * {PAGE}""",
    "unpage_quarantine": DAMAGED,
    "stream_quarantine": DAMAGED,
    "page_roundtrip": "SELECT * FROM orders",
    "record_sink_roundtrip": "SELECT * FROM events",
    "page_stats": " UNION ALL ".join(
        f"""SELECT '{entity}' AS entity, count(*) AS expected_records,
        CAST(ceil(count(*) / {PAGE}.0) AS BIGINT) AS expected_pages,
        count(DISTINCT page_number) AS pages, count(*) AS records
        FROM (SELECT {_page(key, PAGE)} AS page_number FROM {entity})"""
        for entity, key in {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}.items()
    ),
    "attribute_listing_json": _fields("orders", "customer"),
    "attribute_types_json": _json_types("orders", "customer"),
    "found_schema": "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders",
    # catalogue
    "name_harvest": _harvest(
        {
            "name": "p_name", "logical_name": "p_name", "schema_name": "p_brand", "collection_name": "NULL",
            "logical_collection_name": "p_type", "physical_name": "NULL", "base_table_name": "NULL",
            "entity_set_name": "p_type", "display_name": LABELS["name"],
            "display_collection_name": LABELS["collection"],
        }
    ),
    "name_harvest_short": _harvest(
        {
            "LogicalName": "p_name", "SchemaName": "p_brand", "CollectionSchemaName": "p_brand",
            "LogicalCollectionName": "p_type", "EntitySetName": "p_type", "DisplayName": LABELS["name"],
            "DisplayCollectionName": LABELS["collection"],
        }
    ),
    "label_fallback": """SELECT c_name AS entity,
        CASE WHEN c_acctbal >= 0 AND c_nationkey <= 20 THEN c_mktsegment ELSE c_name END AS display_name,
        CASE WHEN c_acctbal >= 0 AND c_nationkey BETWEEN 5 AND 20 THEN c_mktsegment ELSE '' END AS description
        FROM customer""",
    "description_label": """SELECT c_name AS entity,
        CASE WHEN c_nationkey BETWEEN 5 AND 20 THEN c_mktsegment END AS description FROM customer""",
    "endpoint_longest": _longest(
        {"lower(p_name)": "true", "lower(p_brand)": "true", "lower(p_type)": "true"}, ENDPOINTS
    ),
    "endpoint_longest_short": _longest(
        {
            "lower(p_name)": "true", "replace(lower(p_name), ' ', '')": "true", "lower(p_brand)": "true",
            "lower(p_type)": "true",
        },
        NAMES,
    ),
    "endpoint_priority": f"""SELECT CAST(p_partkey AS VARCHAR) AS "MetadataId",
        CASE WHEN p_type IN (SELECT name FROM ({TYPES})) THEN p_type
             WHEN p_brand IN (SELECT name FROM ({BRANDS})) THEN p_brand END AS endpoint FROM part""",
    "endpoint_remaining": f"""SELECT CAST(p.p_partkey AS VARCHAR) AS "MetadataId",
        CASE WHEN p.p_size > 40 THEN 'known' ELSE e.endpoint END AS endpoint FROM part p
        JOIN ({_longest({"lower(p_name)": "true", "lower(p_brand)": "true", "lower(p_type)": "true"}, ENDPOINTS)}) e
        ON e."MetadataId" = CAST(p.p_partkey AS VARCHAR)""",
    "record_counts": f"""SELECT c_name AS entity, cnt AS record_count, updated AS last_updated
        FROM customer JOIN {SNAPSHOTS} ON {CODE} = code""",
    "record_count_default": f"""SELECT c_name AS entity, COALESCE(cnt, 0) AS record_count, updated AS last_updated
        FROM customer LEFT JOIN {SNAPSHOTS} ON {CODE} = code""",
    "strict_lookup": "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
    "entity_counts": """SELECT 'customer' AS entity, count(*) AS record_count,
        CAST(NULL AS TIMESTAMP) AS last_updated FROM customer
        UNION ALL SELECT 'orders', count(*), max(o_orderdate) FROM orders
        UNION ALL SELECT 'lineitem', count(*), max(l_shipdate) FROM lineitem
        UNION ALL SELECT 'events', count(*), max(ts) FROM events""",
    "attribute_listing": _fields("orders", "lineitem", "events"),
    "date_fields": f"""SELECT *, contains(field, 'date') AS is_date, contains(field, 'time') AS is_time
        FROM ({_fields("orders", "lineitem", "events")})""",
    "entity_profile": f"""SELECT c.c_name AS entity, {AVAILABLE} AS endpoint, COALESCE(s.cnt, 0) AS record_count,
        CAST(ceil(COALESCE(s.cnt, 0) / 1000.0) AS BIGINT) AS estimated_pages,
        CASE {AVAILABLE} WHEN 'building' THEN 'o_orderdate' WHEN 'household' THEN 'l_shipdate'
            WHEN 'automobile' THEN 'updatetime' END AS date_fields,
        CASE {AVAILABLE} WHEN 'building' THEN '' WHEN 'household' THEN ''
            WHEN 'automobile' THEN 'updatetime' END AS time_fields,
        array_to_string(list_sort([c.c_name, lower(c.c_mktsegment)] ||
            CASE WHEN c.c_acctbal >= 0 THEN [c.c_mktsegment] ELSE [] END), ';') AS names,
        concat({DEFINED_LABEL}, '<Endpoint=', COALESCE({AVAILABLE}, 'None'), ', Count=',
               CAST(COALESCE(s.cnt, 0) AS VARCHAR), '>') AS label,
        (SELECT count(*) FROM customer) AS catalog_size
        FROM customer c LEFT JOIN {SNAPSHOTS} s ON {CODE} = s.code""",
    "attribute_profile": _each(_profile, "customer", "orders", "pages"),
    # keyed tables and snapshots
    "last_wins": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "skip_done": """SELECT doc_id, source FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "fresh_rows": """SELECT event_id, ts FROM events
        WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 DAY""",
    "stale_rows": """SELECT event_id, ts FROM events
        WHERE ts IS NULL OR ts < TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 DAY""",
    "snapshot_upsert": """SELECT c_custkey AS code, c_acctbal AS balance FROM customer
        WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
        UNION ALL SELECT s_suppkey, s_acctbal + 1 FROM supplier""",
    "environment_upsert": """SELECT c_mktsegment AS base_url, c_name AS entity, c_custkey AS record_count,
        CAST(NULL AS VARCHAR) AS last_updated FROM customer
        WHERE c_mktsegment NOT IN (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'SUPPLIERS' END FROM supplier)
        UNION ALL SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'SUPPLIERS' END, s_name, s_suppkey,
        '2024-01-01 00:00:00' FROM supplier""",
    "snapshot_load": """SELECT o_custkey AS entity, count(*) AS record_count, max(o_orderdate) AS last_updated
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""",
    "snapshot_versions": """WITH first AS (
            SELECT o_orderstatus AS base_url, o_custkey AS entity, count(*) AS record_count, max(o_orderdate) AS last_updated
            FROM orders GROUP BY ALL
        ), second AS (
            SELECT CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE o_orderstatus END AS base_url, o_custkey AS entity,
                   count(*) AS record_count, max(o_orderdate) AS last_updated
            FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' GROUP BY ALL
        )
        SELECT 1 AS version, * FROM first
        UNION ALL SELECT 2, * FROM second
        UNION ALL SELECT 2, * FROM first WHERE base_url NOT IN (SELECT base_url FROM second)""",
    "map_to_rows": """SELECT c_name AS entity, c_custkey AS record_count FROM customer
        WHERE c_mktsegment = 'HOUSEHOLD'""",
    # JSON documents, CSV
    "error_split": f"""SELECT event_id, {STATUS} AS status,
        CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS value,
        CASE WHEN event_type = 'error' THEN 'E1' END AS code FROM events""",
    "tolerant_read": f"""SELECT event_id, {STATUS} AS status,
        CASE WHEN event_type NOT IN ('error', 'signup') THEN user_id END AS user_id,
        CASE WHEN event_type NOT IN ('error', 'signup') THEN ts END AS ts FROM events""",
    "csv_worklist": """SELECT CAST(c_custkey AS VARCHAR) AS "Entity", c_name AS "LogicalName",
        concat(c_name, ', "', c_mktsegment, '"') AS "Name", c_mktsegment AS "Description",
        count(o_orderkey) AS "Count" FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL""",
    "csv_roundtrip": "SELECT * FROM documents",
    "worklist_filter": f"""SELECT c_name AS entity, cnt AS record_count
        FROM customer JOIN {SNAPSHOTS} ON {CODE} = code WHERE c_name <> '' AND cnt <> 0""",
    "worklist_order": """SELECT *, CAST(row_number() OVER (ORDER BY cnt, c_name) AS BIGINT) AS turn
        FROM (SELECT c_name, count(*) AS cnt FROM customer JOIN orders ON c_custkey = o_custkey
              GROUP BY c_custkey, c_name)""",
    # streams
    "stream_unpage": "SELECT * FROM events",
    "stream_progress": """SELECT 'events' AS entity, CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages,
        count(*) AS records FROM events""",
    "stream_unpage_again": "SELECT * FROM events",
    "stream_progress_again": """SELECT 'events' AS entity, CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages,
        count(*) AS records FROM events""",
    # composites
    "extract_all": " UNION ALL ".join(
        _pages(entity, key)
        for entity, key in {
            "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
            "documents": "doc_id",
        }.items()
    ),
    "extract_resumed": "SELECT *, entity NOT IN ('customer', 'supplier') AS second_time FROM (" + " UNION ALL ".join(
        _pages(entity, key)
        for entity, key in {
            "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
            "documents": "doc_id",
        }.items()
    ) + ")",
    "csv_driven_extract": " UNION ALL ".join(
        _pages(entity, key)
        for entity, key in {
            "customer": "c_custkey", "part": "p_partkey", "orders": "o_orderkey", "documents": "doc_id",
        }.items()
    ),
    "counts_report": f"""SELECT c_name AS "Entity", c_name AS "LogicalName",
        CASE WHEN c_acctbal >= 0 AND c_nationkey <= 20 THEN c_mktsegment ELSE c_name END AS "Name",
        CASE WHEN c_acctbal >= 0 AND c_nationkey BETWEEN 5 AND 20 THEN c_mktsegment ELSE '' END AS "Description",
        cnt AS "Count" FROM customer JOIN {SNAPSHOTS} ON {CODE} = code""",
    "attribute_dictionary": _each(_documented, "customer", "orders", "pages"),
}
