"""Similarity search."""

import uuid

import numpy as np
from pyspark.sql import functions as F

from knotwork.model import PropertyGraph
from knotwork.operators import vector
from knotwork.operators.lsh import LshIndex
from knotwork.operators.nearest import nearest_join
from knotwork.plans.property_store import PropertyStore
from knotwork.plans.retrieval import retrieve_table
from knotwork.session import shared_dir
from workload.registry import TOPIC, VECTOR, Tables, query, vector_literal, with_

COS = "list_cosine_similarity(embedding, {0})"
SCORED = with_(TOPIC, f"s AS (SELECT *, greatest(0, {COS.format(vector_literal())}) AS score FROM topic)")


def rounded(found, *columns: str):
    return found.select(*columns, F.round("score", 6).alias("score"))


@query("V1 V5 L5", SCORED + "SELECT vid, label, round(score, 6) AS score FROM s ORDER BY s.score DESC, vid LIMIT 10")
def vector_topk(t: Tables):
    return rounded(vector.vector_query(t.graph, VECTOR), "vid", "label")


@query("V2 L1", SCORED + """SELECT vid, label, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vid) AS r FROM s) WHERE r <= 5""")
def vector_topk_per_label(t: Tables):
    return rounded(vector.vector_query_per_type(t.graph, VECTOR, 5), "vid", "label")


@query("V2", SCORED + "SELECT vid, round(score, 6) AS score FROM s WHERE label = 'TOPIC_3' ORDER BY s.score DESC, vid LIMIT 8")
def vector_neighbors(t: Tables):
    return rounded(vector.vector_query(t.graph, VECTOR, 8, "TOPIC_3"), "vid")


@query("V5", SCORED + "SELECT vid, label, name, round(score, 6) AS score FROM s")
def vector_scores(t: Tables):
    return rounded(vector.scored(t.graph, VECTOR), "vid", "label", "name")


def searches() -> list[dict]:
    """Three searches per topic type: the vector, its reverse and its negative."""
    forms = [VECTOR, VECTOR[::-1], [-x for x in VECTOR]]
    return [
        {"type_name": f"TOPIC_{i}", "query_embedding": q, "top_k": 5} for i in range(10) for q in forms
    ]


BATCH = with_(TOPIC) + ",\nq AS (" + "\nUNION ALL ".join(
    f"SELECT {i} AS search, '{s['type_name']}' AS type, {vector_literal(s['query_embedding'])} AS q"
    for i, s in enumerate(searches())
) + """)
SELECT CAST(search AS BIGINT) AS search, vid, round(score, 6) AS score FROM (
  SELECT search, vid, score, row_number() OVER (PARTITION BY search ORDER BY score DESC, vid) AS r FROM (
    SELECT search, vid, greatest(0, list_cosine_similarity(embedding, q.q)) AS score FROM q JOIN topic ON topic.label = q.type))
WHERE r <= 5"""


@query("V3 V2", BATCH)
def batch_vector_search(t: Tables):
    return rounded(vector.batch_vector_search(t.graph, searches()), "search", "vid")


@query("V4", SCORED + f"SELECT vid, round({COS.format(vector_literal())}, 6) AS similarity FROM topic WHERE name = 'vec_40'")
def vector_similarity(t: Tables):
    row = t("embeddings").where(F.col("vec_id") == 40).first()
    found = vector.vector_similarity(t.graph, f"TOPIC_{row.label}/vec_40", VECTOR)
    return found.select("vid", F.round("similarity", 6).alias("similarity"))


@query("A7", SCORED + """SELECT label, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT label FROM s ORDER BY score DESC, vid LIMIT 50) GROUP BY label""")
def hit_types(t: Tables):
    return vector.hit_types(vector.vector_query(t.graph, VECTOR, 50))


def lsh_sql(changed: str = "topic", tables: int = 8, cells: int = 3, seed: int = 7, dim: int = 64) -> str:
    """The rows of ``changed`` that share all cells of one table with the query, ranked exactly.  The
    directions follow from the seed, as in the index."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(dim, tables * cells))
    directions /= np.linalg.norm(directions, axis=0)
    offsets, cell = rng.uniform(size=tables * cells), 1.0 / np.sqrt(dim)
    asked = np.array(VECTOR) / np.linalg.norm(VECTOR)
    held = np.floor(asked @ directions / cell + offsets).astype(int)
    same = [
        f"floor(list_dot_product(embedding, {vector_literal(directions[:, i].tolist())}) / (norm * {float(cell)!r}) + {float(offsets[i])!r}) = {held[i]}"
        for i in range(tables * cells)
    ]
    shared = " OR ".join("(" + " AND ".join(same[t * cells:(t + 1) * cells]) + ")" for t in range(tables))
    return with_(TOPIC, f"u AS (SELECT *, sqrt(list_dot_product(embedding, embedding)) AS norm FROM {changed})") + (
        f"SELECT vid, label, round(score, 6) AS score FROM (SELECT vid, label, greatest(0, {COS.format(vector_literal())}) AS score "
        f"FROM u WHERE {shared}) ORDER BY round(score, 12) DESC, vid LIMIT 10")


@query("V7", lsh_sql())
def vector_topk_lsh(t: Tables):
    path = f"{shared_dir(t.spark)}/index-{uuid.uuid4().hex}"
    return rounded(LshIndex.build(t.graph, 64, path).search(t.graph, VECTOR), "vid", "label")


NEAREST = with_(TOPIC) + """, q AS (SELECT CAST(vec_id AS BIGINT) AS query_id, label AS class, CAST(embedding AS DOUBLE[]) AS q FROM embeddings),
h AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vid) AS r FROM (
  SELECT query_id, name, triplet_source_id, vid, round(greatest(0, list_cosine_similarity(embedding, q)), 12) AS score
  FROM q JOIN topic ON {which}))
"""


def asked(t: Tables, *labels: int):
    """Stored vectors of some classes as a table of queries."""
    rows = t("embeddings").where(F.col("label").isin(*labels))
    return rows.select(F.col("vec_id").cast("long").alias("query_id"), "embedding", "label")


@query("V3 V1", NEAREST.format(which="q.class IN (2, 5)") + "SELECT query_id, vid, round(score, 6) AS score FROM h WHERE r <= 5")
def vector_nearest_join(t: Tables):
    """Every vector of two classes looks for its five nearest among all topics."""
    return rounded(nearest_join(t.graph, asked(t, 2, 5), 5), "query_id", "vid")


@query("V3 V2", NEAREST.format(which="q.class IN (1, 4) AND topic.label = 'TOPIC_' || (q.class + 1)")
       + "SELECT query_id, vid, round(score, 6) AS score FROM h WHERE r <= 7")
def vector_nearest_join_by_type(t: Tables):
    """Every vector of two classes looks among the topics of the next class."""
    typed = asked(t, 1, 4).withColumn("type", F.concat(F.lit("TOPIC_"), F.col("label") + 1))
    return rounded(nearest_join(t.graph, typed, 7), "query_id", "vid")


@query("R1 V3", NEAREST.format(which="q.class = 3") + """SELECT query_id, CAST(d.doc_id AS VARCHAR) AS subject, 'MENTIONS' AS relation, name AS object,
  round(score, 6) AS score, triplet_source_id AS source_id, md5(d.text) AS text_md5
FROM h JOIN documents d ON CAST(d.doc_id AS VARCHAR) = h.triplet_source_id WHERE r <= 4""")
def retrieve_query_table(t: Tables):
    """Retrieval for every vector of a class at once, with the texts."""
    found = retrieve_table(t.graph, asked(t, 3), 4)
    return found.select("query_id", "subject", "relation", "object", F.round("score", 6).alias("score"), "source_id",
                        F.md5(F.col("source_text").cast("binary")).alias("text_md5"))


CHANGED = """(SELECT label, vid, name, CASE WHEN CAST(triplet_source_id AS BIGINT) % 10 = 3 THEN list_transform(embedding, lambda x: -x)
  ELSE embedding END AS embedding FROM topic WHERE CAST(triplet_source_id AS BIGINT) % 7 <> 0)"""


@query("V7 U1 U4 D11", lsh_sql(CHANGED))
def store_approximate_after_changes(t: Tables):
    """The index follows an upsert that turns vectors round and a deletion."""
    store = PropertyStore(t.spark, f"{shared_dir(t.spark)}/store-{uuid.uuid4().hex}", embedding_dimension=64, buckets=2)
    g, number = t.graph, F.expr("CAST(substr(name, 5) AS BIGINT)")
    topics = g.vertices.where(F.col("label").startswith("TOPIC_"))
    store.create_vector_index()
    store.disk.overwrite(PropertyGraph.empty(t.spark).with_vertices(topics))
    turned = topics.where(number % 10 == 3).select(
        F.lit("entity").alias("kind"), "label", "name", F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("text"),
        F.transform("embedding", lambda x: -x).alias("embedding"), F.create_map().cast("map<string,string>").alias("props"), number.alias("seq"))
    store.upsert_nodes(turned, [])
    store.delete_records(topics.where(number % 7 == 0).select("vid"))
    return rounded(store.vector_query(VECTOR, 10, approximate=True), "vid", "label")
