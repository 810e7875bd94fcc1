"""Deletions, shown by what is left."""

from pyspark.sql import functions as F

from knotwork.operators import delete, merge
from workload.registry import E, V, Tables, content, content_sql, query, with_
from workload.writes import TRIPLES, stored_triples

TOUCHES = "src NOT IN (SELECT vid FROM d) AND dst NOT IN (SELECT vid FROM d)"


def left_sql(doomed: str) -> str:
    """What remains after the vertices that satisfy a predicate are gone."""
    return (
        with_(V, E, f"d AS (SELECT vid FROM v WHERE {doomed})")
        + content_sql("vid NOT IN (SELECT vid FROM d)", TOUCHES)
    )


@query("D1 D5 D9", left_sql("id IN ('3', '12') OR name IN ('NATION_4', 'Customer#000000009', 'Part#3')"))
def delete_by_ids(t: Tables):
    return content(delete.delete(t.graph, ["ignored"], ids=["3", "12", "NATION_4", "Customer#000000009", "Part#3"]))


@query("D1 D9", left_sql("id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1) OR name IN (SELECT 'Order#' || event_id FROM events WHERE event_type = 'error')"))
def delete_by_id_table(t: Tables):
    toxic = t("labels").where(F.col("toxic") == 1).select(F.col("doc_id").cast("string").alias("ref"))
    errors = t("events").where(F.col("event_type") == "error").select(F.concat(F.lit("Order#"), "event_id"))
    return content(delete.delete_ids(t.graph, toxic.union(errors)))


@query("D2 D9", left_sql("name IN ('ASIA', 'NATION_11') OR id = '7'"))
def delete_by_names(t: Tables):
    return content(delete.delete(t.graph, ["ASIA", "NATION_11", "7"]))


@query("D3 D9", left_sql("label = 'CUSTOMER' AND name IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3)"))
def delete_by_properties(t: Tables):
    return content(delete.delete(t.graph, properties={"c_mktsegment": "BUILDING", "c_nationkey": 3}))


@query("D4 D5", with_(V, E, "d AS (SELECT vid FROM v WHERE label = 'REGION')") + content_sql(
    "label <> 'REGION'", "label NOT IN ('CONTAINS', 'SUPPLIED_BY') AND " + TOUCHES))
def delete_relations(t: Tables):
    return content(delete.delete(t.graph, relation_names=["CONTAINS", "SUPPLIED_BY", "REGION"]))


@query("D5", with_(V, E) + content_sql("true", "true"))
def delete_nothing(t: Tables):
    return content(delete.delete(t.graph))


@query("D6 J10", with_(TRIPLES, """alive AS (SELECT * FROM triples WHERE r = 'LIVES_IN' OR r = 'LIES_IN'),
  cut AS (SELECT * FROM alive WHERE NOT (r = 'LIVES_IN' AND s IN (SELECT c_name FROM customer WHERE c_acctbal < 0)))""") + """
SELECT 'edge' AS kind, r AS label, 'Entity/' || s || ' -> Entity/' || o AS item FROM cut
UNION ALL SELECT 'vertex', 'Entity', 'Entity/' || x FROM (SELECT s AS x FROM cut UNION SELECT o FROM cut)""")
def delete_triplet_orphans(t: Tables):
    nation = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    doomed = t("customer").where(F.col("c_acctbal") < 0).join(nation, "c_nationkey").select(
        F.col("c_name").alias("subject"), F.lit("lives in").alias("relation"), F.col("n_name").alias("object")
    )
    return content(delete.delete_triples(stored_triples(t), doomed, "Entity"))


@query("D7 A8", with_(V, E, "d AS (SELECT vid FROM v WHERE label = 'ORDERS')") + """SELECT label, CAST(count(*) AS BIGINT) AS left_over,
  (SELECT CAST(count(*) AS BIGINT) FROM d) AS removed FROM v WHERE label <> 'ORDERS' GROUP BY label""")
def delete_whole_type(t: Tables):
    left, removed = delete.delete_all_of(t.graph, "ORDERS")
    return left.vertices.groupBy("label").agg(F.count("vid").alias("left_over")).withColumn(
        "removed", F.lit(removed).cast("bigint")
    )


@query("D8 D9", left_sql("label = 'PART' AND key IN (SELECT 'Part#' || p_partkey FROM part WHERE p_brand = 'Brand#2' OR (p_type = 'ECONOMY' AND p_size = 11))"))
def bulk_delete(t: Tables):
    return content(delete.bulk_delete(t.graph, "PART", [{"p_brand": "Brand#2"}, {"p_type": "ECONOMY", "p_size": 11}]))


@query("D11 Q4", left_sql("vid IN ('NATION/NATION_2', 'TextChunk/5', 'ORDERS/Order#8')"))
def delete_by_record_id(t: Tables):
    return content(delete.delete_records(t.graph, ["NATION/NATION_2", "TextChunk/5", "ORDERS/Order#8"]))


@query("D10 D9 U7", with_("""chunk AS (SELECT CAST(doc_id AS VARCHAR) AS id, text, source AS ref FROM documents
  WHERE source NOT IN ('src1', 'src2') UNION ALL
  SELECT 'new-' || doc_id, 'again ' || text, source FROM documents WHERE source IN ('src1', 'src2')),
  entity AS (SELECT 'vec_' || vec_id AS name, 'new-' || vec_id AS chunk, 'TOPIC_' || label AS label FROM embeddings
    JOIN documents ON vec_id = doc_id WHERE source IN ('src1', 'src2'))""") + """
SELECT 'vertex' AS kind, 'TextChunk' AS label, 'TextChunk/' || id AS item FROM chunk
UNION ALL SELECT 'vertex', 'TOPIC_' || label, 'TOPIC_' || label || '/vec_' || vec_id FROM embeddings
UNION ALL SELECT 'edge', 'MENTIONS', 'TextChunk/' || chunk || ' -> ' || label || '/' || name FROM entity
UNION ALL SELECT 'edge', 'MENTIONS', 'TextChunk/' || vec_id || ' -> TOPIC_' || label || '/vec_' || vec_id
  FROM embeddings JOIN documents ON vec_id = doc_id WHERE source NOT IN ('src1', 'src2')""")
def refresh_document(t: Tables):
    """Two sources are dropped and written again under new chunk ids."""
    g = t.graph
    mine = F.col("label").startswith("TOPIC") | (F.col("label") == "TextChunk")
    part = g.with_vertices(g.vertices.where(mine)).with_edges(g.edges.where(F.col("label") == "MENTIONS"))
    kept = delete.drop_document(part, ["src1", "src2"])
    fresh = t("documents").where(F.col("source").isin("src1", "src2"))
    new_id = F.concat(F.lit("new-"), "doc_id")
    chunks = merge.batch_of(
        fresh, merge.NODE_BATCH, kind=F.lit("chunk"), id=new_id, seq=F.col("doc_id"),
        text=F.concat(F.lit("again "), "text"), props=F.create_map(F.lit("ref_doc_id"), F.col("source")),
    )
    named = t("embeddings").join(fresh.select(F.col("doc_id").alias("vec_id")), "vec_id")
    entities = merge.batch_of(
        named, merge.NODE_BATCH, kind=F.lit("entity"), label=F.concat(F.lit("topic "), "label"),
        name=F.concat(F.lit("vec_"), "vec_id"), seq=-1 - F.col("vec_id"),
        props=F.create_map(F.lit("triplet_source_id"), F.concat(F.lit("new-"), "vec_id")),
    )
    return content(merge.upsert_nodes(kept, chunks.union(entities), []))
