"""Retrieval, the ingest pipeline and the stored graph."""

import uuid

from pyspark.sql import functions as F

from knotwork.model import PropertyGraph
from knotwork.operators import merge
from knotwork.plans.retrieval import ingest, retrieve
from knotwork.session import shared_dir
from knotwork.sources.documents import chunk_batch
from knotwork.sources.store import GraphStore
from workload.registry import E, V, VECTOR, Tables, content, content_sql, query, with_
from workload.vectors import SCORED

HITS = SCORED + """, hits AS (SELECT * FROM s ORDER BY score DESC, vid LIMIT 10),
around AS (SELECT h.name, h.score, h.triplet_source_id AS source_id, d.doc_id, d.text FROM hits h
  JOIN documents d ON CAST(d.doc_id AS VARCHAR) = h.triplet_source_id)
SELECT CAST(doc_id AS VARCHAR) AS subject, 'MENTIONS' AS relation, name AS object, round(score, 6) AS score, source_id"""


def rounded(found):
    return found.withColumn("score", F.round("score", 6))


@query("R1 V1 T3 T4 J5 J6", HITS + ", text AS source_text FROM around")
def retrieve_context(t: Tables):
    return rounded(retrieve(t.graph, VECTOR, 10, limit_per_hit=None, limit=30))


@query("R1", HITS + " FROM around")
def retrieve_graph_only(t: Tables):
    return rounded(retrieve(t.graph, VECTOR, 10, include_text=False))


INGESTED = """WITH said AS (SELECT conv_id || ':' || turn AS chunk, 'conv ' || conv_id AS doc, role, conv_id, turn FROM conversations)
SELECT 'vertex' AS kind, 'TextChunk' AS label, 'TextChunk/' || chunk AS item FROM said
UNION ALL SELECT 'vertex', 'SPEAKER', 'SPEAKER/' || x FROM (SELECT DISTINCT role AS x FROM said)
UNION ALL SELECT 'vertex', 'TALK', 'TALK/' || x FROM (SELECT DISTINCT doc AS x FROM said)
UNION ALL SELECT 'edge', 'MENTIONS', 'TextChunk/' || chunk || ' -> SPEAKER/' || role FROM said
UNION ALL SELECT DISTINCT 'edge', 'SPOKE_IN', 'SPEAKER/' || role || ' -> TALK/' || doc FROM said
UNION ALL SELECT 'edge', 'SPEAKER_REL', 'TextChunk/' || chunk || ' -> TALK/' || doc FROM said"""


@query("R3 S10 N9 N11 U1 U2 U5 U7", INGESTED)
def ingest_pipeline(t: Tables):
    """Conversations as chunks, their speakers and talks as entities, and the
    relations between them; every speaker holds a large share of all turns."""
    said = t("conversations").withColumn("chunk", F.concat_ws(":", "conv_id", "turn")).withColumn(
        "doc", F.concat(F.lit("conv "), "conv_id")
    )
    order = F.col("conv_id") * 1_000_000 + F.col("turn") * 10
    chunks = chunk_batch(said, F.col("chunk"), F.col("doc"), order, ["role"])
    speakers = merge.batch_of(
        said, merge.NODE_BATCH, kind=F.lit("entity"), label=F.lit("speaker"), name=F.col("role"), seq=order + 1,
        props=F.create_map(F.lit("triplet_source_id"), F.col("chunk")),
    )
    talks = merge.batch_of(
        said, merge.NODE_BATCH, kind=F.lit("entity"), label=F.lit("Talk"), name=F.concat("doc", F.lit(" Inc")), seq=order + 2,
    )
    spoke = merge.batch_of(
        said, merge.RELATION_BATCH, label=F.lit("SPOKE_IN"), source_id=F.col("role"), target_id=F.col("doc"), seq=order,
    )
    part_of = merge.batch_of(
        said, merge.RELATION_BATCH, label=F.lit("SPEAKER"), source_id=F.col("chunk"), target_id=F.col("doc"), seq=order + 1,
    )
    return content(ingest(PropertyGraph.empty(t.spark), chunks, speakers.union(talks), spoke.union(part_of), ["role"]))


@query("S1 U6 N13", with_(V, E) + content_sql("true", "true"))
def stored_graph(t: Tables):
    """Written partitioned by label, opened again by path."""
    path = f"{shared_dir(t.spark)}/stored-{uuid.uuid4().hex}"
    GraphStore(t.spark, path).overwrite(t.graph)
    return content(GraphStore(t.spark, path, create=False).graph())


@query("S13", "SELECT 'vertex' AS kind, 'TEAM' AS label, 'TEAM/' || x AS item FROM (SELECT DISTINCT role AS x FROM conversations)")
def truncate_and_reload(t: Tables):
    path = f"{shared_dir(t.spark)}/stored-{uuid.uuid4().hex}"
    store = GraphStore(t.spark, path)
    store.overwrite(t.graph)
    store.truncate()
    batch = merge.batch_of(
        t("conversations"), merge.NODE_BATCH, kind=F.lit("entity"), label=F.lit("team"), name=F.col("role"),
        seq=F.col("conv_id") * 1_000_000 + F.col("turn"),
    )
    store.overwrite(merge.upsert_nodes(store.graph(), batch, []))
    return content(store.graph())
