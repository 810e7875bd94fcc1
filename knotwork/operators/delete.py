"""Deletes: what has to go is planned first, then filtered or anti joined away.

Edges never outlive their vertices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from knotwork.functions.props import all_equal, prop
from knotwork.functions.text import TEXT_CHUNK, fold_literal, relation_name
from knotwork.model import PropertyGraph, vertex_id
from knotwork.operators.lookup import MAX_LITERALS, ids_table
from knotwork.operators.sizes import fits_memory, mark
from knotwork.operators.traverse import touched, touching
from knotwork.session import cut_lineage

EDGE_KEY = ["label", "src", "dst"]


@dataclass(frozen=True)
class Removal:
    """Vertices that satisfy a predicate or are listed, whole edge types, and single
    edges.  Edges at removed vertices follow by themselves.  ``found`` says that the
    list came out of the vertices and holds their labels, so they need no second look."""

    where: Column | None = None
    vids: DataFrame | None = None
    found: bool = False
    edge_types: tuple[str, ...] = ()
    edges: DataFrame | None = None

    def doomed_vertices(self, graph: PropertyGraph) -> DataFrame:
        """``label`` and ``vid`` of the vertices that go."""
        narrow = graph.vertices
        found = None
        if self.where is not None:
            found = narrow.where(F.coalesce(self.where, F.lit(False))).select("label", "vid")
        if self.vids is not None:
            listed = self.vids
            if not self.found:
                listed = narrow.select("label", "vid").join(self.vids.select("vid"), "vid", "left_semi")
            found = listed.select("label", "vid") if found is None else found.union(listed.select("label", "vid")).distinct()
        return narrow.select("label", "vid").limit(0) if found is None else found

    def doomed_edges(self, graph: PropertyGraph, gone: DataFrame, fits: bool = False,
                     bound: int | None = None) -> DataFrame:
        """Keys of the edges that go, given the vertices that go (``bound`` rows, if counted)."""
        edges = graph.edges.select(*EDGE_KEY)
        found = touching(edges, gone, bound, fits).select(*EDGE_KEY)
        if self.edge_types:
            found = found.union(edges.where(F.col("label").isin(*self.edge_types)))
        if self.edges is not None:
            found = found.union(edges.join(self.edges.select(*EDGE_KEY), EDGE_KEY, "left_semi").select(*EDGE_KEY))
        return found.distinct()

    def apply(self, graph: PropertyGraph) -> PropertyGraph:
        """The graph that is left.

        Edges are anti joined with the removed ids only (usually few), not semi
        joined with all vertices that stay.  The ids are found once and, where they
        were measured to fit, sent to the edges, which then stay where they are.
        """
        vertices, edges = graph.vertices, graph.edges
        if self.edge_types:
            edges = edges.where(~F.col("label").isin(*self.edge_types))
        if self.edges is not None:
            edges = edges.join(self.edges, EDGE_KEY, "left_anti").select(*edges.columns)
        if self.where is not None or self.vids is not None:
            gone = self.doomed_vertices(graph).select(F.col("vid").alias("_gone"))
            if not (self.found and self.where is None):
                gone = cut_lineage(gone)
            fits = fits_memory(gone)
            for end in ("src", "dst"):
                edges = edges.join(mark(gone, fits), F.col(end) == F.col("_gone"), "left_anti")
        if self.where is not None:
            vertices = vertices.where(~F.coalesce(self.where, F.lit(False)))
        if self.vids is not None:
            vertices = vertices.join(self.vids.select("vid"), "vid", "left_anti").select(*vertices.columns)
        return graph.with_vertices(vertices).with_edges(edges)


def _with_keys(graph: PropertyGraph, keys: DataFrame, answers: Column) -> Removal:
    """The vertices one of whose ``answers`` is in a table of keys, looked up once."""
    named = graph.vertices.select("label", "vid", F.explode(answers).alias("ref"))
    hits = named.join(keys.where(F.col("ref").isNotNull()), "ref", "left_semi")
    return Removal(vids=cut_lineage(hits.select("label", "vid").distinct()), found=True)


def _short(values: object) -> bool:
    return not isinstance(values, DataFrame) and len(values) <= MAX_LITERALS


def plan_ids(graph: PropertyGraph, ids: Sequence[str] | DataFrame) -> Removal:
    """By logical id in all types: chunks by id, other vertices by name or id."""
    chunk = F.col("label") == TEXT_CHUNK
    if _short(ids):
        values = [fold_literal(i) for i in ids]
        named = ~chunk & F.coalesce(F.col("name").isin(*values), F.lit(False))
        return Removal(F.coalesce(F.col("id").isin(*values), F.lit(False)) | named)
    answers = F.when(chunk, F.array("id")).otherwise(F.array_distinct(F.array("id", "name")))
    return _with_keys(graph, ids_table(graph, ids), answers)


def plan_names(graph: PropertyGraph, names: Sequence[str] | DataFrame) -> Removal:
    """By entity name in all types (chunks: by id)."""
    answer = F.when(F.col("label") == TEXT_CHUNK, F.col("id")).otherwise(F.col("name"))
    if _short(names):
        return Removal(answer.isin(*[fold_literal(n) for n in names]))
    return _with_keys(graph, ids_table(graph, names), F.array(answer))


def plan_types(labels: Sequence[str]) -> Removal:
    """Everything stored under the given labels, edge types and vertex types alike."""
    return Removal(F.col("label").isin(*labels), edge_types=tuple(labels))


def plan(graph: PropertyGraph, entity_names: Sequence[str] | None = None,
         relation_names: Sequence[str] | None = None, properties: Mapping[str, object] | None = None,
         ids: Sequence[str] | None = None) -> Removal:
    """Combined form: ids before entity names before properties; relation names in
    addition.  Nothing given removes nothing."""
    removal = Removal()
    if ids:
        removal = plan_ids(graph, ids)
    elif entity_names:
        removal = plan_names(graph, entity_names)
    elif properties:
        removal = Removal(all_equal(properties))
    if not relation_names:
        return removal
    types = plan_types(relation_names)
    where = types.where if removal.where is None else F.coalesce(removal.where, F.lit(False)) | types.where
    return replace(removal, where=where, edge_types=types.edge_types)


def plan_bulk(label: str, conditions: Sequence[Mapping[str, object]], safe_mode: bool = True) -> Removal:
    """Rows of a type that satisfy any of several property mappings.

    Without conditions the whole type would go, which safe mode refuses.
    """
    if not conditions:
        if safe_mode:
            raise ValueError("safe mode refuses a bulk delete without conditions")
        return plan_types([label])
    hit = F.lit(False)
    for condition in conditions:
        hit = hit | all_equal(condition)
    return Removal((F.col("label") == label) & hit)


def plan_records(graph: PropertyGraph, vids: Sequence[str] | DataFrame) -> Removal:
    """By record id."""
    if _short(vids):
        # The record ids hold the labels, which prune the scan.
        labels = sorted({v.split("/", 1)[0] for v in vids})
        return Removal(F.col("label").isin(*labels) & F.col("vid").isin(*vids))
    table = vids if isinstance(vids, DataFrame) else graph.spark.createDataFrame([(v,) for v in vids], "vid string")
    return Removal(vids=table.select("vid").distinct())


def plan_triples(graph: PropertyGraph, triples: DataFrame, node_label: str) -> Removal:
    """Triples (``subject``, ``relation``, ``object``), and those of their ends that
    are left without an edge."""
    label = F.lit(node_label)
    doomed = triples.select(
        relation_name(F.col("relation")).alias("label"),
        vertex_id(label, F.col("subject")).alias("src"),
        vertex_id(label, F.col("object")).alias("dst"),
    )
    doomed = cut_lineage(doomed.distinct())
    kept = graph.edges.join(doomed, EDGE_KEY, "left_anti")
    lonely = cut_lineage(touched(doomed).join(touched(kept), "vid", "left_anti"))
    return Removal(vids=lonely, edges=doomed)


def plan_documents(graph: PropertyGraph, documents: Sequence[str] | DataFrame) -> Removal:
    """The chunks of documents (``ref_doc_id``) and the entities taken from them
    (``doc_id``)."""
    of_document = F.when(F.col("label") == TEXT_CHUNK, prop("ref_doc_id")).otherwise(prop("doc_id"))
    if _short(documents):
        return Removal(of_document.isin(*[fold_literal(d) for d in documents]))
    return _with_keys(graph, ids_table(graph, documents), F.array(of_document))


# The same as one step from graph to graph ---------------------------------------


def delete_ids(graph: PropertyGraph, ids: Sequence[str] | DataFrame) -> PropertyGraph:
    return plan_ids(graph, ids).apply(graph)


def delete_names(graph: PropertyGraph, names: Sequence[str] | DataFrame) -> PropertyGraph:
    return plan_names(graph, names).apply(graph)


def delete_records(graph: PropertyGraph, vids: Sequence[str] | DataFrame) -> PropertyGraph:
    return plan_records(graph, vids).apply(graph)


def delete(graph: PropertyGraph, entity_names: Sequence[str] | None = None,
           relation_names: Sequence[str] | None = None, properties: Mapping[str, object] | None = None,
           ids: Sequence[str] | None = None) -> PropertyGraph:
    return plan(graph, entity_names, relation_names, properties, ids).apply(graph)


def delete_all_of(graph: PropertyGraph, label: str) -> tuple[PropertyGraph, int]:
    """Remove a whole type; returns the graph and the number of removed rows."""
    return plan_types([label]).apply(graph), count_of_type(graph, label)


def count_of_type(graph: PropertyGraph, label: str) -> int:
    hit = F.col("label") == label
    return graph.vertices.where(hit).count() + graph.edges.where(hit).count()


def bulk_delete(graph: PropertyGraph, label: str, conditions: Sequence[Mapping[str, object]],
                safe_mode: bool = True) -> PropertyGraph:
    return plan_bulk(label, conditions, safe_mode).apply(graph)


def delete_triples(graph: PropertyGraph, triples: DataFrame, node_label: str) -> PropertyGraph:
    return plan_triples(graph, triples, node_label).apply(graph)


def drop_document(graph: PropertyGraph, documents: Sequence[str] | DataFrame) -> PropertyGraph:
    return plan_documents(graph, documents).apply(graph)
