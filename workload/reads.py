"""Scans, lookups, predicates, catalogue and counts."""

import uuid

from pyspark.sql import functions as F

from knotwork.functions.props import json_field, nested_field, prop, with_nested
from knotwork.model import PropertyGraph, shape_vertices
from knotwork.operators import lookup, scans
from knotwork.plans.sql import register_views, run_sql
from knotwork.session import shared_dir
from knotwork.sources.documents import json_vertices, read_text, write_text
from workload.registry import E, P, V, Tables, query, with_


@query("S2 F11", "SELECT 'CUSTOMER/' || c_name AS vid, 'CUSTOMER' AS label, c_name AS name, c_mktsegment AS segment FROM customer")
def typed_scan(t: Tables):
    return scans.typed_scan(t.graph, "CUSTOMER").select("vid", "label", "name", prop("c_mktsegment").alias("segment"))


@query("S3 J9", with_(V) + "SELECT vid, label, name FROM v WHERE label IN ('CUSTOMER', 'SUPPLIER')")
def polymorphic_scan(t: Tables):
    g = t.graph
    typed = PropertyGraph(g.vertices, g.edges, {"PARTY": "Entity", "CUSTOMER": "PARTY", "SUPPLIER": "PARTY"})
    return scans.polymorphic_scan(typed, "PARTY").select("vid", "label", "name")


@query("S4 F11", with_(E) + "SELECT sha256(length(label) || ':' || label || length(src) || ':' || src || length(dst) || ':' || dst) AS eid, label, src, dst FROM e WHERE label = 'PLACED'")
def edge_scan(t: Tables):
    return scans.edge_scan(t.graph, "PLACED")


@query("S5", with_(V, E) + "SELECT vid, label, name FROM v WHERE vid IN (SELECT dst FROM e)")
def record_fetch(t: Tables):
    g = t.graph
    return scans.fetch(g, g.edges.select(F.col("dst").alias("vid"))).select("vid", "label", "name")


@query("S6 A6", with_(V, E) + """, names AS (
  SELECT 'vertex' AS kind, label FROM v UNION SELECT 'edge', label FROM e
  UNION SELECT 'vertex', unnest(['Entity', 'TextChunk']) UNION SELECT 'edge', 'MENTIONS')
SELECT kind, label, CASE WHEN kind = 'vertex' AND label NOT IN ('Entity', 'TextChunk') THEN 'Entity' END AS parent FROM names""")
def type_catalogue(t: Tables):
    return scans.catalogue(t.graph)


@query("A9", with_(V, E) + """SELECT kind, CAST(count(*) AS BIGINT) AS types FROM (
  SELECT 'vertex' AS kind, label FROM v UNION SELECT 'edge', label FROM e
  UNION SELECT 'vertex', unnest(['Entity', 'TextChunk']) UNION SELECT 'edge', 'MENTIONS') GROUP BY kind""")
def catalogue_count(t: Tables):
    return scans.type_names(t.graph).groupBy("kind").agg(F.count("label").alias("types"))


@query("S7 N13", with_(V, P) + """SELECT DISTINCT 'vertex' AS kind, label, property FROM p
UNION SELECT 'vertex', label, unnest(['id', 'text', 'ref_doc_id']) FROM v WHERE label = 'TextChunk'
UNION SELECT 'vertex', label, 'name' FROM v WHERE label <> 'TextChunk'
UNION SELECT 'vertex', label, unnest(['triplet_source_id', 'embedding']) FROM v WHERE label LIKE 'TOPIC%'""")
def schema_properties(t: Tables):
    return scans.type_properties(t.graph)


@query("S8 L1 F3", with_(V) + """SELECT vid, label, key FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY key) AS r FROM v) WHERE r <= 50""")
def get_all_limited(t: Tables):
    return scans.all_nodes(t.graph).select("vid", "label", "key")


@query("F1", "SELECT 'CUSTOMER/' || c_name AS vid, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7")
def get_by_properties(t: Tables):
    return lookup.nodes_by_properties(t.graph, {"c_mktsegment": "BUILDING", "c_nationkey": 7}).select("vid", "name")


IDS = ["Customer#000000005", "17", "NATION_3", "vec_21", "Order#77", "Supplier#000000004", "nobody"]


@query("F2 F5 L3", with_(V) + "SELECT vid, label FROM v WHERE id IN ('17') OR name IN ('Customer#000000005', 'NATION_3', 'vec_21', 'Order#77', 'Supplier#000000004')")
def get_by_ids(t: Tables):
    return lookup.nodes_by_ids(t.graph, IDS).select("vid", "label")


@query("F2 J9", with_(V) + """, refs AS (
  SELECT CAST(doc_id AS VARCHAR) AS ref FROM labels UNION SELECT 'vec_' || doc_id FROM labels
  UNION SELECT 'Order#' || event_id FROM events)
SELECT vid, label FROM v WHERE (label = 'TextChunk' AND id IN (SELECT ref FROM refs))
  OR (label <> 'TextChunk' AND name IN (SELECT ref FROM refs))""")
def get_by_id_table(t: Tables):
    labelled = t("labels")
    refs = (
        labelled.select(F.col("doc_id").cast("string").alias("ref"))
        .union(labelled.select(F.concat(F.lit("vec_"), "doc_id")))
        .union(t("events").select(F.concat(F.lit("Order#"), "event_id")))
    )
    return lookup.nodes_by_ids(t.graph, refs).select("vid", "label")


@query("F4 J9", with_(V) + "SELECT vid FROM v WHERE name IN ('NATION_1', 'NATION_2', 'ASIA')")
def name_list(t: Tables):
    return lookup.nodes_in_list(t.graph, "name", ["NATION_1", "NATION_2", "ASIA"]).select("vid")


@query("J9", with_(V) + "SELECT vid FROM v WHERE name IN (SELECT 'Order#' || l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def key_membership(t: Tables):
    returned = t("lineitem").where(F.col("l_returnflag") == "R")
    return lookup.nodes_in_list(
        t.graph, "name", returned.select(F.concat(F.lit("Order#"), "l_orderkey").alias("ref"))
    ).select("vid")


@query("F7 L2", """SELECT 'ORDERS/Order#' || o_orderkey AS vid, o_totalprice AS price FROM orders
WHERE o_totalprice > 400000 ORDER BY 'Order#' || o_orderkey LIMIT 200""")
def range_filter(t: Tables):
    price = prop("o_totalprice").try_cast("double")
    return scans.records(t.graph, "ORDERS", price > 400000, 200).select("vid", price.alias("price"))


@query("O2 L2", with_(V) + "SELECT vid, label FROM v WHERE label IN ('SUPPLIER', 'NATION') ORDER BY label, key LIMIT 60")
def multi_type_records(t: Tables):
    return scans.records(t.graph, ["SUPPLIER", "NATION"], limit=60).select("vid", "label")


@query("F8 Q5", "SELECT c_name AS name, c_acctbal AS balance FROM customer WHERE c_acctbal > 5000 AND c_mktsegment = 'MACHINERY'")
def named_parameters(t: Tables):
    register_views(t.graph, {"CUSTOMER": ["c_acctbal", "c_mktsegment"]}, {"CUSTOMER": "vertex"})
    return run_sql(
        t.spark,
        "SELECT name, CAST(c_acctbal AS DOUBLE) AS balance FROM CUSTOMER "
        "WHERE CAST(c_acctbal AS DOUBLE) > :low AND c_mktsegment = :segment",
        {"low": 5000, "segment": "MACHINERY"},
    )


@query("F9 Q5", "SELECT s_name AS name FROM supplier WHERE s_nationkey = 3 OR s_name = 'Supplier#000000007'")
def positional_parameters(t: Tables):
    register_views(t.graph, {"SUPPLIER": ["s_nationkey"]}, {"SUPPLIER": "vertex"})
    return run_sql(
        t.spark, "SELECT name FROM SUPPLIER WHERE s_nationkey = ? OR name = ?",
        {"nation": 3, "name": "Supplier#000000007"}, positional=True,
    )


@query("F10", """SELECT 'EVENT/' || event_id AS vid, CAST(json_extract_string(props, '$.k') AS INT) AS k
FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) >= 50""")
def json_field_filter(t: Tables):
    events = t("events")
    key = F.col("event_id").cast("string")
    vertices = shape_vertices(events, "EVENT", key, id=key, props=F.create_map(F.lit("metadata"), F.col("props")))
    k = json_field("metadata", "$.k").try_cast("int")
    return vertices.where(k >= 50).select("vid", k.alias("k"))


@query("F10 N7", """SELECT 'EVENT/' || event_id AS vid, CAST(json_extract(body, '$.value') AS DOUBLE) AS amount,
  json_extract_string(body, '$.meta.kind') AS kind, CAST(json_extract(body, '$.ids[1]') AS BIGINT) AS second,
  CAST(json_array_length(body, '$.ids') AS INT) AS n_ids, CAST(json_extract(body, '$.meta.inner.k') AS INT) AS k,
  CAST(json_extract(body, '$.nowhere[3].x') AS BIGINT) AS missing, TRY_CAST(json_extract_string(body, '$.meta.kind') AS INT) AS other_kind
FROM (SELECT event_id, to_json({'value': value, 'ids': [event_id, user_id], 'meta': {'kind': event_type, 'inner': CAST(props AS JSON)}}) AS body
  FROM events) WHERE CAST(json_extract(body, '$.ids[1]') AS BIGINT) % 3 = 0""")
def json_typed_fields(t: Tables):
    events, key = t("events"), F.col("event_id").cast("string")
    inner = F.from_json("props", "k int")
    body = F.to_json(F.struct(
        "value", F.array("event_id", "user_id").alias("ids"), F.struct(F.col("event_type").alias("kind"), inner.alias("inner")).alias("meta")))
    vertices = with_nested(shape_vertices(events, "EVENT", key, id=key, props=F.create_map(F.lit("body"), body)), parsed="body")
    return vertices.where(nested_field("parsed", "$.ids[1]", "bigint") % 3 == 0).select(
        "vid", nested_field("parsed", "$.value", "double").alias("amount"), nested_field("parsed", "$.meta.kind", "string").alias("kind"),
        nested_field("parsed", "$.ids[1]", "bigint").alias("second"),
        F.size(nested_field("parsed", "$.ids", "array<bigint>")).alias("n_ids"), nested_field("parsed", "$.meta.inner.k", "int").alias("k"),
        nested_field("parsed", "$.nowhere[3].x", "bigint").alias("missing"), nested_field("parsed", "$.meta.kind", "int").alias("other_kind"))


@query("S11", """SELECT 'MESSAGE/' || conv_id || ':' || turn AS vid, role AS name, CAST(turn AS VARCHAR) AS turn,
  CAST(to_json({'role': role, 'turn': turn}) AS VARCHAR) AS origin FROM conversations""")
def json_insert(t: Tables):
    rows = t("conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("key"),
        F.to_json(F.struct(
            F.col("role").alias("name"), "turn", F.struct("role", "turn").alias("origin")
        )).alias("body"),
    )
    return json_vertices(rows, "body", "MESSAGE", F.col("key")).select(
        "vid", "name", prop("turn").alias("turn"), prop("origin").alias("origin")
    )


@query("F12", with_(V, P) + """SELECT v.vid, v.label, CASE WHEN v.label = 'TextChunk' THEN id ELSE name END AS node_id,
  CASE WHEN v.label = 'TextChunk' THEN text END AS text, CAST(coalesce(n, 0) AS INT) AS properties
FROM v LEFT JOIN (SELECT vid, count(*) AS n FROM p GROUP BY vid) USING (vid)""")
def node_records(t: Tables):
    return scans.node_view(t.graph.vertices).select(
        "vid", "label", "node_id", "text", F.size("props").alias("properties")
    )


@query("F13", with_(E) + """SELECT sha256(length(label) || ':' || label || length(src) || ':' || src || length(dst) || ':' || dst) AS eid, label, src AS source_id,
  dst AS target_id FROM e""")
def relation_records(t: Tables):
    return scans.relation_view(t.graph.edges).drop("props")


CHUNK_FILES = """SELECT CAST(doc_id AS VARCHAR) AS id, text, source AS ref_doc_id,
  CASE WHEN lang = 'en' THEN source ELSE 'doc_' || doc_id || '.txt' END AS source,
  'doc_' || doc_id || '.txt' AS file_name, lang AS file_type, '' AS file_path FROM documents"""


@query("F14 S10", f"""SELECT vec_id AS pos, c.* FROM embeddings JOIN ({CHUNK_FILES}) c ON c.id = CAST(vec_id AS VARCHAR)""")
def chunk_sources(t: Tables):
    documents = t("documents")
    chunk_id = F.col("doc_id").cast("string")
    props = F.create_map(
        F.lit("source"), F.when(F.col("lang") == "en", F.col("source")).otherwise(""),
        F.lit("file_name"), F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")),
        F.lit("file_type"), F.col("lang"),
    )
    chunks = shape_vertices(
        documents, "TextChunk", chunk_id, id=chunk_id, text=F.col("text"), ref_doc_id=F.col("source"), props=props
    )
    asked = t("embeddings").select(F.col("vec_id").alias("pos"), F.col("vec_id").cast("string").alias("ref"))
    return lookup.chunk_sources(PropertyGraph(chunks, t.graph.edges), asked)


@query("A1 L4 O1", with_(V) + "SELECT label AS entity_type, CAST(count(*) AS BIGINT) AS count FROM v GROUP BY label")
def count_by_label(t: Tables):
    return scans.count_by_label(t.graph)


@query("A2 A3", with_(V) + "SELECT CAST(count(*) AS BIGINT) AS count FROM v WHERE label <> 'TextChunk'")
def entity_count(t: Tables):
    return scans.count_of(t.graph, "Entity")


@query("A4 F6 L2 O1", with_(V) + "SELECT DISTINCT name FROM v WHERE name IS NOT NULL AND trim(name) <> '' ORDER BY name LIMIT 100")
def entity_names(t: Tables):
    return scans.entity_names(t.graph)


@query("A4 F6 O1", "SELECT DISTINCT p_name AS name FROM part WHERE trim(p_name) <> ''")
def distinct_names(t: Tables):
    named = shape_vertices(t("part"), "PART", F.col("p_partkey").cast("string"), name=F.col("p_name"))
    return scans.entity_names(PropertyGraph(named, t.graph.edges), None)


@query("A5 L1", with_(V) + """SELECT type, name FROM (
  SELECT label AS type, name, row_number() OVER (PARTITION BY label ORDER BY name) AS r FROM v WHERE name <> '')
WHERE r <= 5""")
def schema_samples(t: Tables):
    return scans.sample_names(t.graph)


@query("O3", with_(V) + "SELECT DISTINCT vid, label FROM v WHERE label IN ('CUSTOMER', 'NATION', 'SUPPLIER')")
def overlapping_scans(t: Tables):
    g = t.graph
    both = scans.records(g, ["CUSTOMER", "NATION"]).unionByName(scans.records(g, ["SUPPLIER", "NATION"]))
    return both.select("vid", "label").dropDuplicates(["vid"])


@query("O4", with_(V) + "SELECT DISTINCT label FROM v WHERE label NOT IN ('TextChunk', 'Entity')")
def searchable_types(t: Tables):
    names = scans.type_names(t.graph).where(F.col("kind") == "vertex")
    return names.select("label").where(~F.col("label").isin("TextChunk", "Entity"))


@query("Q1 Q2", """SELECT n_name AS nation, CAST(count(*) AS BIGINT) AS customers FROM customer
JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY n_name""")
def sql_views(t: Tables):
    register_views(
        t.graph, {"CUSTOMER": ["c_mktsegment"]},
        {"CUSTOMER": "vertex", "NATION": "vertex", "FROM_NATION": "edge"},
    )
    return run_sql(t.spark, """
        SELECT nation.name AS nation, count(*) AS customers
        FROM CUSTOMER person, NATION nation, FROM_NATION rel
        WHERE rel.src = person.vid AND rel.dst = nation.vid AND person.c_mktsegment IN ('BUILDING', 'MACHINERY')
        GROUP BY nation.name""")


@query("S9", "SELECT doc_id, md5(text) AS text, 'text/plain' AS file_type, true AS named FROM documents")
def text_files(t: Tables):
    """Documents written as one text file each and read back whole, with their paths."""
    folder = f"{shared_dir(t.spark)}/texts-{uuid.uuid4().hex}"
    write_text(t("documents"), folder, F.col("doc_id").cast("string"), F.col("text"))
    found = read_text(t.spark, folder)
    # The writer ends a file with a line feed of its own.
    own = F.substring("text", F.lit(1), F.length("text") - 1)
    return found.select(
        F.regexp_extract("file_name", "^(-?[0-9]+)_", 1).try_cast("long").alias("doc_id"), F.md5(own.cast("binary")).alias("text"),
        "file_type", F.col("file_path").endswith(F.col("file_name")).alias("named"),
    )


@query("L2 O2", with_(V) + "SELECT vid FROM v WHERE label IN ('ORDERS', 'CUSTOMER') ORDER BY label, key LIMIT 11000")
def records_large_limit(t: Tables):
    """A limit beyond what one task sorts: whole ranges, and one that is cut."""
    return scans.records(t.graph, ["ORDERS", "CUSTOMER"], limit=11_000).select("vid")
