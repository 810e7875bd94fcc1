"""Upserts and other writes, shown by the rows they leave behind."""

from pyspark.sql import functions as F

from knotwork.functions.props import prop
from knotwork.model import PropertyGraph, shape_vertices
from knotwork.operators import merge
from workload.registry import TOPIC, V, Tables, content, props_rows, query, with_


def user_batch(t: Tables):
    """Events as entity nodes: one entity per user and type, many rows each."""
    return merge.batch_of(
        t("events"), merge.NODE_BATCH, kind=F.lit("entity"), label=F.col("event_type"),
        name=F.concat(F.lit(" User#"), "user_id", F.lit(" Inc")), seq=F.col("event_id"),
        props=F.create_map(
            F.lit("value"), F.when(F.col("value") > 20, F.col("value").cast("string")),
            F.lit("k"), F.get_json_object("props", "$.k"),
        ),
    )


def user_graph(t: Tables) -> PropertyGraph:
    """Users that are stored before the batch arrives."""
    users = t("events").select("user_id").distinct()
    name = F.concat(F.lit("User#"), "user_id")
    stored = shape_vertices(
        users, "CLICK", name, name=name,
        props=F.create_map(F.lit("origin"), F.lit("stored"), F.lit("value"), F.lit("-1")),
    )
    return PropertyGraph(stored, PropertyGraph.empty(t.spark).edges)


UPSERTED = """WITH b AS (SELECT upper(event_type) || '/User#' || user_id AS vid, event_id,
    CASE WHEN value > 20 THEN CAST(value AS VARCHAR) END AS value, json_extract_string(props, '$.k') AS k FROM events),
  stored AS (SELECT DISTINCT 'CLICK/User#' || user_id AS vid FROM events),
  new AS (SELECT vid, arg_max(value, event_id) FILTER (WHERE value IS NOT NULL) AS value, arg_max(k, event_id) AS k
    FROM b GROUP BY vid)
SELECT vid, 'k' AS property, k AS value FROM new
UNION ALL SELECT vid, 'origin', 'stored' FROM stored
UNION ALL SELECT vid, 'value', coalesce(new.value, CASE WHEN stored.vid IS NOT NULL THEN '-1' END)
  FROM new FULL JOIN stored USING (vid) WHERE coalesce(new.value, CASE WHEN stored.vid IS NOT NULL THEN '-1' END) IS NOT NULL"""


@query("U1 U12 N13", UPSERTED)
def upsert_last_wins(t: Tables):
    return props_rows(merge.upsert_nodes(user_graph(t), user_batch(t)).vertices)


@query("U1 U12", UPSERTED)
def upsert_known_properties(t: Tables):
    return props_rows(merge.upsert_nodes(user_graph(t), user_batch(t), ["value", "k"]).vertices)


@query("U2 S10", """WITH new AS (SELECT CAST(conv_id AS VARCHAR) AS id, arg_max(text, turn) AS text,
    arg_max(role, turn) AS role, 'conv' || conv_id AS ref_doc_id FROM conversations GROUP BY conv_id)
SELECT coalesce(new.id, CAST(doc_id AS VARCHAR)) AS id, coalesce(new.text, d.text) AS text,
  coalesce(new.ref_doc_id, d.source) AS ref_doc_id, new.role, d.lang
FROM new FULL JOIN documents d ON new.id = CAST(doc_id AS VARCHAR)""")
def upsert_chunks_merge(t: Tables):
    talk = t("conversations")
    batch = merge.batch_of(
        talk, merge.NODE_BATCH, kind=F.lit("chunk"), id=F.col("conv_id").cast("string"), text=F.col("text"),
        seq=F.col("turn"),
        props=F.create_map(F.lit("role"), F.col("role"), F.lit("ref_doc_id"), F.concat(F.lit("conv"), "conv_id")),
    )
    g = t.graph
    chunks = g.with_vertices(g.vertices.where(F.col("label") == "TextChunk"))
    merged = merge.upsert_nodes(chunks, batch).vertices
    return merged.select("id", "text", "ref_doc_id", prop("role").alias("role"), prop("lang").alias("lang"))


@query("U3", """SELECT 'STATUS/' || o_orderstatus AS vid, 'last' AS property,
  CAST(max(o_orderkey) AS VARCHAR) AS value FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'STATUS/' || o_orderstatus, 'priority', arg_max(o_orderpriority, o_orderkey) FROM orders
  GROUP BY o_orderstatus""")
def upsert_generic(t: Tables):
    batch = merge.batch_of(
        t("orders"), merge.NODE_BATCH, kind=F.lit("generic"), label=F.lit("STATUS"), id=F.col("o_orderstatus"),
        seq=F.col("o_orderkey"),
        props=F.create_map(F.lit("last"), F.col("o_orderkey").cast("string"),
                           F.lit("priority"), F.col("o_orderpriority")),
    )
    return props_rows(merge.upsert_nodes(PropertyGraph.empty(t.spark), batch, ["last", "priority"]).vertices)


@query("U9 A8", """SELECT 'PRODUCT/' || p_name AS vid, unnest(['brand', 'type', 'size']) AS property,
  unnest([arg_max(p_brand, p_partkey), arg_max(p_type, p_partkey), CAST(arg_max(p_size, p_partkey) AS VARCHAR)]) AS value
FROM part GROUP BY p_name""")
def bulk_upsert_parts(t: Tables):
    props = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"),
                         F.lit("size"), F.col("p_size").cast("string"))
    written = merge.bulk_upsert(
        PropertyGraph.empty(t.spark), "PRODUCT", t("part"), F.col("p_name"), F.col("p_partkey"), props,
        ["brand", "type", "size"], name=F.col("p_name"),
    )
    return props_rows(written.vertices)


@query("U4", with_(TOPIC) + """SELECT vid, CASE WHEN label < 'TOPIC_5' THEN CAST(1 AS DOUBLE)
  ELSE round(embedding[1], 5) END AS first FROM topic""")
def upsert_embeddings(t: Tables):
    g = t.graph
    topics = g.vertices.where(F.col("label").startswith("TOPIC"))
    rows = t("embeddings")
    batch = merge.batch_of(
        rows, merge.NODE_BATCH, kind=F.lit("entity"), label=F.concat(F.lit("topic "), "label"),
        name=F.concat(F.lit("vec_"), "vec_id"), seq=F.col("vec_id"),
        embedding=F.when(F.col("label") < 5, F.array(F.lit(1.0), F.lit(2.0))),
    )
    merged = merge.upsert_nodes(g.with_vertices(topics), batch, []).vertices
    return merged.select("vid", F.round(F.element_at("embedding", 1).cast("double"), 5).alias("first"))


@query("S12 A8", """SELECT 'EVENT' AS label, CAST(count(*) AS BIGINT) AS count FROM events
UNION ALL SELECT 'REGION', CAST(count(*) AS BIGINT) FROM region""")
def bulk_insert_events(t: Tables):
    g = t.graph
    regions = g.with_vertices(g.vertices.where(F.col("label") == "REGION"))
    key = F.col("event_id").cast("string")
    written = merge.bulk_insert(regions, "EVENT", t("events"), key, F.create_map(F.lit("type"), F.col("event_type")), id=key)
    return written.vertices.groupBy("label").agg(F.count("vid").alias("count"))


@query("U5 U6 L3", """WITH r AS (SELECT o_orderkey AS seq, 'CUSTOMER/' || c_name AS src, 'NATION/NATION_' || c_nationkey AS dst,
    CASE o_orderstatus WHEN 'F' THEN 'FROM_NATION' ELSE 'ORDERS_FROM' END AS label, o_orderpriority AS priority
    FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT label, src, dst, arg_min(priority, seq) AS priority FROM r WHERE label = 'ORDERS_FROM' GROUP BY label, src, dst
UNION ALL SELECT 'FROM_NATION', 'CUSTOMER/' || c_name, 'NATION/' || n_name, NULL FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'FROM_NATION', 'SUPPLIER/' || s_name, 'NATION/' || n_name, NULL FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def upsert_relations_dedup(t: Tables):
    nation = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    orders = t("orders").join(nation, "o_custkey")
    real = merge.batch_of(
        orders, merge.RELATION_BATCH, seq=F.col("o_orderkey"), source_id=F.concat("c_name", F.lit(" LLC")),
        target_id=F.concat(F.lit("NATION_"), "c_nationkey"),
        label=F.when(F.col("o_orderstatus") == "F", "FROM_NATION").otherwise("ORDERS_FROM"),
        props=F.create_map(F.lit("priority"), F.col("o_orderpriority")),
    )
    lost = real.withColumn("target_id", F.concat(F.lit("Ghost#"), "source_id"))
    written = merge.upsert_relations(t.graph, real.union(lost)).edges
    return written.where(F.col("label").isin("FROM_NATION", "ORDERS_FROM")).select(
        "label", "src", "dst", F.try_element_at("props", F.lit("priority")).alias("priority")
    )


@query("U7", """SELECT 'TextChunk/' || vec_id AS src, 'TOPIC_' || label || '/vec_' || vec_id AS dst
FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)""")
def mentions_edges(t: Tables):
    rows = t("embeddings")
    entities = merge.batch_of(
        rows, merge.NODE_BATCH, kind=F.lit("entity"), label=F.concat(F.lit("topic "), "label"),
        name=F.concat(F.lit("vec_"), "vec_id"), seq=F.col("vec_id"),
        props=F.create_map(F.lit("triplet_source_id"), F.col("vec_id").cast("string")),
    )
    documents = t("documents")
    chunks = merge.batch_of(
        documents, merge.NODE_BATCH, kind=F.lit("chunk"), id=F.col("doc_id").cast("string"), text=F.col("text"),
        seq=F.col("doc_id") + 1_000_000_000,
    )
    written = merge.upsert_nodes(PropertyGraph.empty(t.spark), entities.union(chunks), [])
    return written.edges.select("src", "dst")


TRIPLES = """triples AS (SELECT c_name AS s, 'HAS_PRIORITY' AS r, o_orderpriority AS o
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION SELECT n_name, 'LIES_IN', r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION SELECT c_name, 'LIVES_IN', n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def triples(t: Tables):
    customer = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return t("orders").join(customer, "o_custkey").select(
        F.col("c_name").alias("subject"), F.lit("has priority").alias("relation"),
        F.col("o_orderpriority").alias("object"),
    )


def stored_triples(t: Tables) -> PropertyGraph:
    region = t("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nation = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    lies = t("nation").join(region, "n_regionkey").select(
        F.col("n_name").alias("subject"), F.lit("lies in").alias("relation"), F.col("r_name").alias("object"))
    lives = t("customer").join(nation, "c_nationkey").select(
        F.col("c_name").alias("subject"), F.lit("lives in").alias("relation"), F.col("n_name").alias("object"))
    return merge.triples_graph(lies.union(lives), "Entity")


@query("U8", with_(TRIPLES) + """SELECT 'vertex' AS kind, 'Entity' AS label, 'Entity/' || s AS item FROM triples
UNION SELECT 'vertex', 'Entity', 'Entity/' || o FROM triples
UNION ALL SELECT 'edge', r, 'Entity/' || s || ' -> Entity/' || o FROM triples""")
def triplet_upsert(t: Tables):
    return content(merge.upsert_triples(stored_triples(t), triples(t), "Entity"))


@query("U10", """SELECT 'CUSTOMER/' || c_name AS vid, CASE WHEN c_acctbal < 0 THEN 'RISK' ELSE c_mktsegment END AS segment,
  CASE WHEN c_acctbal < 0 THEN 'yes' END AS flagged FROM customer""")
def update_matching(t: Tables):
    g = t.graph
    written = merge.update_where(
        g, "CUSTOMER", prop("c_acctbal").try_cast("double") < 0,
        {"c_mktsegment": F.lit("RISK"), "flagged": F.lit("yes")},
    )
    return written.vertices.where(F.col("label") == "CUSTOMER").select(
        "vid", prop("c_mktsegment").alias("segment"), prop("flagged").alias("flagged")
    )


@query("U11", """SELECT DISTINCT 'SHIPS_TO' AS label, 'SUPPLIER/' || s_name AS src, 'REGION/' || r_name AS dst
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def link_records(t: Tables):
    region = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    pairs = t("supplier").join(region, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.lit("SHIPS_TO").alias("label"), F.concat(F.lit("SUPPLIER/"), "s_name").alias("src"),
        F.concat(F.lit("REGION/"), "r_name").alias("dst"),
    )
    lost = pairs.withColumn("dst", F.concat(F.lit("PLANET/"), "src"))
    written = merge.link(t.graph, pairs.union(lost))
    return written.edges.where(F.col("label") == "SHIPS_TO").select("label", "src", "dst")


@query("J8", with_(V) + """, asked AS (SELECT DISTINCT 'ASKED' AS label, c_name AS source, o_orderpriority AS t, o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT DISTINCT 'BOUGHT' AS label, a.vid AS src, b.vid AS dst FROM asked
JOIN v a ON a.name = asked.source JOIN v b ON b.name = 'Order#' || asked.o_orderkey""")
def edges_from_selects(t: Tables):
    customer = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    asked = t("orders").join(customer, "o_custkey").select(
        F.lit("BOUGHT").alias("label"), F.col("c_name").alias("source"),
        F.concat(F.lit("Order#"), "o_orderkey").alias("target"),
    )
    written = merge.connect_matches(t.graph, asked)
    return written.edges.where(F.col("label") == "BOUGHT").select("label", "src", "dst")
