"""The two public stores over whole tables: written through their calls, read back through them."""

import uuid

from pyspark.sql import functions as F

from knotwork.functions.props import prop
from knotwork.model import PropertyGraph
from knotwork.operators import merge
from knotwork.plans.property_store import PropertyStore
from knotwork.plans.triple_store import TripleStore
from knotwork.session import shared_dir
from workload.deletes import left_sql
from workload.registry import E, P, TOPIC, V, Tables, content, content_sql, props_rows, query, with_
from workload.writes import TRIPLES, UPSERTED, triples, user_batch, user_graph


def new_store(t: Tables, graph: PropertyGraph | None = None, **options) -> PropertyStore:
    store = PropertyStore(t.spark, f"{shared_dir(t.spark)}/store-{uuid.uuid4().hex}", **options)
    if graph is not None:
        store.disk.overwrite(graph)
    return store


def part_of(t: Tables, *labels: str, edges: tuple[str, ...] = ()) -> PropertyGraph:
    g = t.graph
    return g.with_vertices(g.vertices.where(F.col("label").isin(*labels))).with_edges(
        g.edges.where(F.col("label").isin(*edges)) if edges else g.edges.limit(0))


@query("U1 U6 U12 S8", UPSERTED)
def store_upsert_twice(t: Tables):
    """The same batch again changes nothing; all nodes are read back without a cap."""
    store = new_store(t, user_graph(t), buckets=4)
    for _ in range(2):
        store.upsert_nodes(user_batch(t), ["value", "k"])
    return props_rows(store.get(limit_per_type=None))


@query("U5 J1 R2", """SELECT c_name AS subject, 'PLACED' AS relation, 'Order#' || o_orderkey AS object
FROM orders JOIN customer ON o_custkey = c_custkey""")
def store_relations(t: Tables):
    store = new_store(t, part_of(t, "CUSTOMER", "ORDERS"))
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(" LLC"))
    batch = merge.batch_of(
        t("orders"), merge.RELATION_BATCH, label=F.lit("PLACED"), source_id=name,
        target_id=F.concat(F.lit("Order#"), "o_orderkey"), seq=F.col("o_orderkey"),
    )
    for _ in range(2):
        store.upsert_relations(batch)
    return store.get_triplets(limit_per_type=None)


@query("R2", with_(V, E) + """SELECT s.name AS subject, e.label AS relation, o.name AS object FROM e
JOIN v s ON s.vid = e.src JOIN v o ON o.vid = e.dst WHERE s.name = 'ASIA' OR o.name = 'ASIA' OR s.name = 'NATION_3' OR o.name = 'NATION_3'""")
def store_triplets_of_names(t: Tables):
    """A filtered listing is not cut, whatever the hub."""
    store = new_store(t, part_of(t, "REGION", "NATION", "CUSTOMER", "SUPPLIER", edges=("IN_REGION", "FROM_NATION")))
    return store.get_triplets(entity_names=["ASIA", "NATION_3"])


@query("D1 D9 U6", left_sql("id IN ('3', '12') OR name IN ('NATION_4', 'Customer#000000009', 'Part#3')"))
def store_delete_ids(t: Tables):
    store = new_store(t, t.graph)
    store.delete(ids=["3", "12", "NATION_4", "Customer#000000009", "Part#3"])
    return content(store.graph)


@query("U10", """SELECT 'CUSTOMER/' || c_name AS vid, CASE WHEN c_acctbal < 0 THEN 'audit' END AS ref_doc_id,
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer""")
def store_update_where(t: Tables):
    """A declared property goes to its column, NULL clears a property."""
    store = new_store(t, part_of(t, "CUSTOMER"))
    store.update_where("CUSTOMER", prop("c_acctbal").try_cast("double") < 0,
                       {"ref_doc_id": F.lit("audit"), "c_mktsegment": F.lit(None)})
    return store.get(limit_per_type=None).select("vid", "ref_doc_id", prop("c_mktsegment").alias("segment"))


@query("U9 S12", """SELECT 'PRODUCT/' || p_name AS vid, unnest(['brand', 'type', 'size']) AS property,
  unnest([arg_max(p_brand, p_partkey), arg_max(p_type, p_partkey), CAST(arg_max(p_size, p_partkey) AS VARCHAR)]) AS value
FROM part GROUP BY p_name
UNION ALL SELECT 'COUNT/written', 'rows', CAST(count(*) AS VARCHAR) FROM part""")
def store_bulk_upsert(t: Tables):
    """Rows without a key are left out and not counted."""
    store = new_store(t)
    props = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"),
                         F.lit("size"), F.col("p_size").cast("string"))
    rows = t("part").unionByName(t("part").withColumn("p_name", F.lit(None).cast("string")))
    written = store.bulk_upsert("PRODUCT", rows, F.col("p_name"), F.col("p_partkey"), props, name=F.col("p_name"))
    counted = t.spark.createDataFrame([("COUNT/written", "rows", str(written))], "vid string, property string, value string")
    return props_rows(store.get(limit_per_type=None)).union(counted)


REFRESHED = """SELECT 'vertex' AS kind, label, vid AS item FROM v WHERE label LIKE 'TOPIC%'
UNION ALL SELECT 'vertex', label, vid FROM v WHERE label = 'TextChunk' AND ref_doc_id NOT IN ('src1', 'src4')
UNION ALL SELECT 'vertex', 'TextChunk', 'TextChunk/new ' || doc_id FROM documents WHERE source IN ('src1', 'src4')
UNION ALL SELECT 'edge', e.label, src || ' -> ' || dst FROM e JOIN v ON v.vid = e.src
  WHERE e.label = 'MENTIONS' AND v.ref_doc_id NOT IN ('src1', 'src4')
UNION ALL SELECT 'edge', 'ABOUT', 'TextChunk/new ' || doc_id || ' -> TOPIC_' || label || '/vec_' || vec_id
  FROM documents JOIN embeddings ON vec_id = doc_id WHERE source IN ('src1', 'src4')"""


@query("D10 U2", with_(V, E) + REFRESHED)
def store_refresh_documents(t: Tables):
    """Documents of two sources are replaced by new chunks with relations, as one change."""
    topics = [f"TOPIC_{i}" for i in range(10)]
    store = new_store(t, part_of(t, "TextChunk", *topics, edges=("MENTIONS",)))
    fresh = t("documents").where(F.col("source").isin("src1", "src4"))
    new_id = F.concat(F.lit("new "), "doc_id")
    chunks = merge.batch_of(
        fresh, merge.NODE_BATCH, kind=F.lit("chunk"), id=new_id, text=F.col("text"), seq=F.col("doc_id"),
        props=F.create_map(F.lit("ref_doc_id"), F.col("source")),
    )
    about = merge.batch_of(
        fresh.join(t("embeddings"), F.col("vec_id") == F.col("doc_id")), merge.RELATION_BATCH, label=F.lit("ABOUT"),
        source_id=new_id, target_id=F.concat(F.lit("vec_"), "vec_id"), seq=F.col("doc_id"),
    )
    store.refresh_documents(["src1", "src4"], chunks, about)
    return content(store.graph)


@query("U8 D6", with_(TRIPLES) + """, kept AS (SELECT * FROM triples WHERE r = 'HAS_PRIORITY'
  AND s NOT IN (SELECT c_name FROM customer WHERE c_acctbal < 0))
SELECT 'vertex' AS kind, 'Entity' AS label, 'Entity/' || s AS item FROM kept
UNION SELECT 'vertex', 'Entity', 'Entity/' || o FROM kept
UNION ALL SELECT 'edge', r, 'Entity/' || s || ' -> Entity/' || o FROM kept""")
def triple_store_roundtrip(t: Tables):
    """Blank parts are left out; deleted triples take the ends that nothing else holds."""
    store = TripleStore(t.spark, f"{shared_dir(t.spark)}/triples-{uuid.uuid4().hex}")
    blank = triples(t).withColumn("object", F.lit(None).cast("string"))
    store.upsert_triplets(triples(t).union(blank))
    poor = t("customer").where(F.col("c_acctbal") < 0).select(F.col("c_name").alias("subject"))
    store.delete_triplets(triples(t).join(poor, "subject", "left_semi").distinct())
    return content(store.graph)


@query("R1 T3", with_(V, E, TOPIC.replace("topic AS", "topics AS")) + """, s AS (SELECT vid, name, triplet_source_id,
    greatest(0, list_cosine_similarity(embedding, (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 7))) AS score FROM topics),
hits AS (SELECT * FROM s ORDER BY score DESC, vid LIMIT 25),
near AS (SELECT h.vid, h.score, e.label, e.src, e.dst, row_number() OVER (PARTITION BY h.vid ORDER BY e.label, e.src, e.dst) AS r
  FROM hits h JOIN e ON e.src = h.vid OR e.dst = h.vid)
SELECT coalesce(a.name, a.id) AS subject, near.label AS relation, coalesce(b.name, b.id) AS object, round(near.score, 6) AS score
FROM near JOIN v a ON a.vid = near.src JOIN v b ON b.vid = near.dst WHERE r <= 1""")
def store_retrieve_per_hit(t: Tables):
    """One relation for each hit, counted by itself."""
    topics = [f"TOPIC_{i}" for i in range(10)]
    store = new_store(t, part_of(t, "TextChunk", *topics, edges=("MENTIONS",)))
    asked = t("embeddings").where(F.col("vec_id") == 7).first().embedding
    found = store.retrieve([float(x) for x in asked], 25, include_text=False, limit_per_hit=1)
    return found.select("subject", "relation", "object", F.round("score", 6).alias("score"))


@query("F12 F13", with_(P) + """SELECT vid AS item, property, value FROM p
UNION ALL SELECT 'PLACED/' || o_orderkey, 'day', CAST(o_orderkey % 7 AS VARCHAR) FROM orders JOIN customer ON o_custkey = c_custkey""")
def viewed_property_values(t: Tables):
    """The values that node and relation views show, system and end fields left out."""
    from knotwork.operators.scans import node_view, relation_view

    g = t.graph
    shown = F.map_concat("props", F.create_map(F.lit("@rid"), F.lit("#1")))
    nodes = node_view(g.vertices.withColumn("props", shown)).select(F.col("vid").alias("item"), F.explode("props").alias("property", "value"))
    customer = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    placed = t("orders").join(customer, "o_custkey").select(
        F.lit("PLACED").alias("label"), F.concat(F.lit("CUSTOMER/"), "c_name").alias("src"),
        F.concat(F.lit("ORDERS/Order#"), "o_orderkey").alias("dst"),
        F.create_map(F.lit("day"), (F.col("o_orderkey") % 7).cast("string"), F.lit("source_id"), F.lit("x"), F.lit("@out"), F.lit("y")).alias("props"))
    relations = relation_view(placed).select(
        F.concat(F.lit("PLACED/"), F.substring_index("target_id", "#", -1)).alias("item"), F.explode("props").alias("property", "value"))
    return nodes.union(relations)
