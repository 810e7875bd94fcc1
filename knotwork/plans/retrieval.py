"""Graph-augmented retrieval and the ingest pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from knotwork.functions.text import TEXT_CHUNK
from knotwork.model import PropertyGraph
from knotwork.operators.lookup import literal_ids, settle, vertices_of
from knotwork.operators.merge import upsert_nodes, upsert_relations
from knotwork.operators.nearest import nearest_join
from knotwork.operators.ranking import first_rows, top_per_group
from knotwork.operators.sizes import fits_memory, mark
from knotwork.operators.traverse import EDGE_ORDER, display_name, touching
from knotwork.operators.vector import DEFAULT_TOP_K, vector_query
from knotwork.session import cut_lineage


def retrieve(graph: PropertyGraph, query: Sequence[float], top_k: int = DEFAULT_TOP_K,
             include_text: bool = True, limit_per_hit: int | None = 30, limit: int | None = None) -> DataFrame:
    """Best entities for a query vector, the relations around them and the text
    they come from.

    One row per relation, scored by its better end.  ``limit_per_hit`` counts for each
    hit by itself, so a hub leaves room for the others, ``limit`` over all of them; None
    lifts either.  Hits and relations are settled in turn, so every table is read once:
    vectors for the hits, edges around them, the vertices and chunks those name.
    """
    hits = settle(vector_query(graph, query, top_k).select("vid", "score"), top_k)
    found = touching(graph.edges.select(*EDGE_ORDER), hits, top_k)
    if limit_per_hit is not None:
        ends = found.select(*EDGE_ORDER, F.explode(F.array_distinct(F.array("src", "dst"))).alias("vid"))
        ends = ends.join(hits.select("vid"), "vid", "left_semi")
        order = [F.col(c) for c in EDGE_ORDER]
        found = top_per_group(ends, ["vid"], order, limit_per_hit).select(*EDGE_ORDER).distinct()
        bound = top_k * limit_per_hit
        limit = bound if limit is None else min(limit, bound)
    around = cut_lineage(found) if limit is None else settle(first_rows(found, EDGE_ORDER, limit), limit)
    if limit is None:
        limit = around.count()
    ends = vertices_of(graph, around, limit, "src", "dst").select(
        "vid", display_name().alias("shown"), F.col("triplet_source_id").alias("source")
    )
    ends = settle(ends, 2 * limit).join(hits, "vid", "left")

    def end(vid: str, shown: str) -> DataFrame:
        return ends.select(F.col("vid").alias(vid), F.col("shown").alias(shown),
                           F.col("score").alias(f"{vid}_score"), F.col("source").alias(f"{vid}_source"))

    src_score, dst_score = (F.coalesce(c, F.lit(-1.0)) for c in ("src_score", "dst_score"))
    found = around.join(end("src", "subject"), "src").join(end("dst", "object"), "dst").select(
        "subject", F.col("label").alias("relation"), "object",
        F.greatest("src_score", "dst_score").alias("score"),
        F.when(src_score >= dst_score, F.col("src_source")).otherwise(F.col("dst_source")).alias("source_id"),
    )
    if not include_text:
        return found
    found = settle(found, limit)
    chunks = graph.vertices.where(F.col("label") == TEXT_CHUNK)
    ids = literal_ids(found, limit, "source_id")
    if ids is not None:
        chunks = chunks.where(F.col("id").isin(*ids))
    text = chunks.select(F.col("id").alias("source_id"), F.col("text").alias("source_text"))
    return found.join(text, "source_id", "left").select(
        "subject", "relation", "object", "score", "source_id", "source_text"
    )


def ingest(graph: PropertyGraph, chunks: DataFrame, entities: DataFrame, relations: DataFrame,
           property_names: Sequence[str] | None = None) -> PropertyGraph:
    """Chunks, extracted entities and extracted relations into a graph.

    Chunks and entities merge as one node batch, provenance edges included; then
    relations resolve their ends against the result, which is therefore computed
    once and kept.
    """
    merged = upsert_nodes(graph, chunks.unionByName(entities), property_names)
    merged = merged.with_vertices(cut_lineage(merged.vertices))
    return upsert_relations(merged, relations)


def retrieve_table(graph: PropertyGraph, queries: DataFrame, top_k: int = DEFAULT_TOP_K, include_text: bool = True,
                   limit_per_hit: int | None = 30) -> DataFrame:
    """``retrieve`` for a whole table of queries (query_id, embedding, optionally type): one row
    per query and relation.

    Hits of all queries are found in one pass.  The relations around a vertex are looked up
    once, whatever number of queries hit it.
    """
    hits = cut_lineage(nearest_join(graph, queries, top_k).select("query_id", "vid", "score"))
    found = cut_lineage(hits.select("vid").distinct())
    fits = fits_memory(found)
    ends = graph.edges.select(*EDGE_ORDER, F.explode(F.array_distinct(F.array("src", "dst"))).alias("vid")).join(
        mark(found, fits), "vid", "left_semi")
    if limit_per_hit is not None:
        ends = top_per_group(ends, ["vid"], [F.col(c) for c in EDGE_ORDER], limit_per_hit)
    around = cut_lineage(hits.join(ends, "vid").select("query_id", *EDGE_ORDER).distinct())
    named = cut_lineage(around.select(F.explode(F.array("src", "dst")).alias("vid")).distinct())
    vertices = graph.vertices.join(mark(named, fits_memory(named)), "vid", "left_semi").select(
        "vid", display_name().alias("shown"), F.col("triplet_source_id").alias("source"))

    def end(rows: DataFrame, vid: str, shown: str) -> DataFrame:
        own = vertices.select(F.col("vid").alias(vid), F.col("shown").alias(shown), F.col("source").alias(f"{vid}_source"))
        hit = hits.select("query_id", F.col("vid").alias(vid), F.col("score").alias(f"{vid}_score"))
        return rows.join(own, vid).join(hit, ["query_id", vid], "left")

    src_score, dst_score = (F.coalesce(c, F.lit(-1.0)) for c in ("src_score", "dst_score"))
    rows = end(end(around, "src", "subject"), "dst", "object").select(
        "query_id", "subject", F.col("label").alias("relation"), "object", F.greatest("src_score", "dst_score").alias("score"),
        F.when(src_score >= dst_score, F.col("src_source")).otherwise(F.col("dst_source")).alias("source_id"),
    )
    if not include_text:
        return rows
    rows = cut_lineage(rows)
    wanted = cut_lineage(rows.select(F.col("source_id").alias("id")).where("id IS NOT NULL").distinct())
    chunks = graph.vertices.where(F.col("label") == TEXT_CHUNK).join(mark(wanted, fits_memory(wanted)), "id", "left_semi")
    text = chunks.select(F.col("id").alias("source_id"), F.col("text").alias("source_text"))
    return rows.join(text, "source_id", "left").select(
        "query_id", "subject", "relation", "object", "score", "source_id", "source_text")
