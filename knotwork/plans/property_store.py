"""The property store: reads as DataFrames, writes as changes of the stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from knotwork.model import BASIC_TYPES, CORE_RELATIONS, PropertyGraph
from knotwork.operators import delete as deletes, lookup, merge, nearest, scans, traverse, vector
from knotwork.operators.lsh import Projection
from knotwork.operators.sizes import KEY_HASH, fits_memory, mark, not_stored
from knotwork.plans import retrieval, sql
from knotwork.plans.nodes import Relation, node_batch, reference, relation_batch
from knotwork.session import cut_lineage, shared_dir
from knotwork.sources.store import GraphStore


class PropertyStore:
    """A named graph with embeddings.

    ``path`` is a folder all executors can reach; without one the graph lives
    under the shared checkpoint folder.  Every read and every write starts from the
    tables as they are, so what other writers wrote is seen.  The session's settings
    are left alone; ``session.tune`` has the ones that suit hubs.
    """

    # Stands for "50 or 100 per type, unless a filter already says what is wanted".
    DEFAULT = object()

    def __init__(self, spark: SparkSession, path: str | None = None, create: bool = True,
                 include_basic_schema: bool = True, embedding_dimension: int | None = None,
                 parents: Mapping[str, str | None] | None = None, buckets: int = 1) -> None:
        self.spark = spark
        self.basic = include_basic_schema
        self.dimension = embedding_dimension
        path = path or f"{shared_dir(spark)}/graph-{uuid.uuid4().hex}"
        self.disk = GraphStore(spark, path, create, parents, buckets)

    @property
    def graph(self) -> PropertyGraph:
        self.disk.refresh()
        return self.disk.graph()

    # Reads --------------------------------------------------------------------

    def get(self, properties: Mapping[str, object] | None = None,
            ids: Sequence[str] | DataFrame | None = None, limit_per_type: int | None = 50) -> DataFrame:
        """Nodes by ids, else by properties, else up to ``limit_per_type`` of every type
        (None for all)."""
        if ids is not None and (isinstance(ids, DataFrame) or len(ids)):
            return lookup.nodes_by_ids(self.graph, ids)
        if properties:
            return lookup.nodes_by_properties(self.graph, properties)
        return scans.all_nodes(self.graph, limit_per_type)

    def get_triplets(self, entity_names: Sequence[str] | None = None,
                     relation_names: Sequence[str] | None = None,
                     properties: Mapping[str, object] | None = None,
                     ids: Sequence[str] | None = None, limit_per_type: int | None | object = DEFAULT) -> DataFrame:
        """Triplets that satisfy all filters.  Without a filter, 100 per edge type unless
        ``limit_per_type`` says otherwise; None for all."""
        if limit_per_type is self.DEFAULT:
            limit_per_type = None if entity_names or relation_names or properties or ids else 100
        found = traverse.triplet_listing(self.graph, entity_names, relation_names, properties, ids, limit_per_type)
        return found.select("subject", "relation", "object")

    def get_triplets_by_type(self, subject_types: Sequence[str] | None = None,
                             relation_types: Sequence[str] | None = None,
                             object_types: Sequence[str] | None = None) -> DataFrame:
        found = traverse.triplets_by_type(self.graph, subject_types, relation_types, object_types)
        return found.select("subject", "relation", "object")

    def get_rel_map(self, graph_nodes: Sequence[object] | DataFrame, depth: int = 2, limit: int = 30,
                    ignore_rels: Sequence[str] | None = None, one_hop: bool = False) -> DataFrame:
        """Relations within ``depth`` hops of nodes, given as nodes, as names or ids, or as
        a table; ``one_hop`` stops after the first."""
        graph, bound = self.graph, None
        if not isinstance(graph_nodes, DataFrame):
            refs = [reference(n) for n in graph_nodes]
            graph_nodes, bound = lookup.ids_table(graph, refs), len(refs)
        return traverse.rel_map(graph, graph_nodes, depth, limit, ignore_rels, one_hop=one_hop, bound=bound)

    def get_chunk_nodes(self, node_ids: Sequence[str]) -> DataFrame:
        """Chunk text and file fields, in request order."""
        return lookup.chunk_sources(self.graph, lookup.request_list(self.graph, node_ids)).orderBy("pos")

    def get_records(self, types: str | Sequence[str], where: Column | None = None,
                    limit: int | None = None) -> DataFrame:
        return scans.records(self.graph, types, where, limit)

    def get_schema(self) -> dict:
        """Types, properties and sample names; only the samples need a scan."""
        return scans.schema_summary(self.graph, self.basic, known=self.disk.catalogue())

    def get_schema_table(self) -> DataFrame:
        """The same with one row per type, whatever the number of types."""
        return scans.schema_table(self.graph, self.basic, known=self.disk.catalogue())

    def get_entity_names(self, limit: int | None = 100) -> DataFrame:
        return scans.entity_names(self.graph, limit)

    def create_vector_index(self, tables: int = 8, cells: int = 3, cell: float | None = None) -> None:
        """An index for approximate search, which all later writes keep up to date."""
        if not self.dimension:
            raise ValueError("an index needs an embedding dimension")
        self.disk.create_index(Projection(self.dimension, tables, cells, cell), 2 * self.disk.buckets + 14)

    def vector_query(self, query_embedding: Sequence[float] | None, similarity_top_k: int | None = None,
                     approximate: bool = False, type_name: str | None = None) -> DataFrame:
        """The nearest entities; with ``approximate`` only those that the index finds."""
        if query_embedding and self.dimension and len(query_embedding) != self.dimension:
            raise ValueError(f"the query must have {self.dimension} elements")
        graph = self.graph
        if not approximate or not query_embedding:
            return vector.vector_query(graph, query_embedding, similarity_top_k, type_name)
        if self.disk.index is None:
            raise ValueError("call create_vector_index first")
        return self.disk.index.search(graph, query_embedding, similarity_top_k or vector.DEFAULT_TOP_K, type_name)

    def vector_search(self, type_name: str, query_embedding: Sequence[float], top_k: int = 10) -> DataFrame:
        return vector.vector_query(self.graph, query_embedding, top_k, type_name)

    def batch_vector_search(self, searches: Sequence[dict]) -> DataFrame:
        return vector.batch_vector_search(self.graph, searches)

    def vector_query_table(self, queries: DataFrame, similarity_top_k: int = 10) -> DataFrame:
        """The nearest entities of every query of a table (query_id, embedding, optionally type)."""
        return nearest.nearest_join(self.graph, queries, similarity_top_k)

    def retrieve_table(self, queries: DataFrame, similarity_top_k: int = 10, include_text: bool = True,
                       limit_per_hit: int | None = 30) -> DataFrame:
        """Relations and texts around the nearest entities of every query of a table."""
        return retrieval.retrieve_table(self.graph, queries, similarity_top_k, include_text, limit_per_hit)

    def get_vector_similarity(self, vid: str, query_embedding: Sequence[float]) -> DataFrame:
        return vector.vector_similarity(self.graph, vid, query_embedding)

    def retrieve(self, query_embedding: Sequence[float], similarity_top_k: int = 10,
                 include_text: bool = True, limit_per_hit: int | None = 30) -> DataFrame:
        return retrieval.retrieve(self.graph, query_embedding, similarity_top_k, include_text, limit_per_hit)

    def structured_query(self, query: str, param_map: Mapping[str, object] | None = None) -> DataFrame:
        """Spark SQL over one view per type.

        Properties are columns of the views; edge views have ``src`` and ``dst``.
        The views come from the stored catalogue, no data is read for them, and they
        exist only while the statement is analysed.
        """
        graph = self.graph
        return sql.query_views(graph, query, param_map, catalogue=self.disk.catalogue(), declared=self._declared())

    # Writes -------------------------------------------------------------------

    def _declared(self) -> list[str]:
        """Vertex types that need no row: core, basic (if chosen) and hierarchy types."""
        return sorted({*PropertyGraph.empty(self.spark).declared(), *self.disk.parents,
                       *(p for p in self.disk.parents.values() if p), *(BASIC_TYPES if self.basic else [])})

    def _check_types(self, vertices: DataFrame) -> None:
        """Vertex and edge types share one namespace."""
        core = self.spark.createDataFrame([(c,) for c in CORE_RELATIONS], "label string")
        clash = vertices.join(self.disk.labels("edges").union(core), "label", "left_semi").select("label").first()
        if clash:
            raise ValueError(f"{clash.label!r} is an edge type and cannot be a vertex type")

    def _fit(self, rows: DataFrame) -> DataFrame:
        """Embeddings of another width than the store's are left out."""
        if not self.dimension:
            return rows
        return rows.withColumn("embedding", F.when(F.size("embedding") == self.dimension, F.col("embedding")))

    def _prepared(self, nodes: Sequence[object] | DataFrame, property_names: Sequence[str] | None = None,
                  max_property_length: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The usable rows of a batch, and one row per vertex of it; both settled."""
        batch = nodes if isinstance(nodes, DataFrame) else node_batch(self.spark, nodes)
        prepared = cut_lineage(self._fit(merge.prepare_nodes(batch, max_property_length)))
        collapsed = cut_lineage(merge.collapse_nodes(prepared, property_names))
        self._check_types(collapsed)
        return prepared, collapsed

    def _merge(self, collapsed: DataFrame) -> None:
        """Lay a settled batch over the parts it touches."""
        stored = self.disk.part("vertices", self.disk.parts_of("vertices", collapsed))
        self.disk.enter("vertices", collapsed)
        self.disk.replace("vertices", merge.merge_vertices(stored, collapsed, fits_memory(collapsed)))
        self.disk.note("vertices", collapsed)

    def upsert_nodes(self, nodes: Sequence[object] | DataFrame, property_names: Sequence[str] | None = None,
                     max_property_length: int | None = None) -> None:
        """Merge nodes; only the parts that hold a node of the batch are rewritten."""
        self.disk.refresh()
        prepared, collapsed = self._prepared(nodes, property_names, max_property_length)
        if collapsed.isEmpty():
            return
        sourced = prepared.where((F.col("kind") == "entity") & F.col("triplet_source_id").isNotNull())
        fresh = None
        if not sourced.isEmpty():
            chunks = merge.chunk_ids(self.disk.graph().vertices).union(merge.chunk_ids(prepared))
            fresh = self._new_edges(merge.mentions(sourced, chunks))
        self._merge(collapsed)
        if fresh is not None:
            self.disk.append("edges", fresh)

    def upsert_relations(self, relations: Sequence[Relation] | DataFrame) -> None:
        """Add relations with known ends; stored edges are read by key only and kept."""
        usable, few, edges = self._resolved(self.graph, relations)
        if few:
            added = self._new_edges(edges.drop(KEY_HASH))
        else:
            # The labels of the batch are known before its edges, which are then computed once.
            stored = self.disk.graph(edge_labels=cut_lineage(usable.select("label").distinct())).edges
            added = cut_lineage(not_stored(edges, stored, ["label", "src", "dst"]))
        self.disk.append("edges", added)

    def _resolved(self, graph: PropertyGraph, relations: Sequence[Relation] | DataFrame,
                  more_labels: DataFrame | None = None) -> tuple[DataFrame, bool, DataFrame]:
        """A settled relation batch, whether what it refers to fits in memory, and the edges of
        the batch whose ends are in the graph."""
        batch = relations if isinstance(relations, DataFrame) else relation_batch(self.spark, relations)
        taken = self.disk.labels("vertices").union(
            self.spark.createDataFrame([(c,) for c in self._declared()], "label string"))
        taken = (taken if more_labels is None else taken.union(more_labels.select("label"))).distinct()
        usable = cut_lineage(merge.separate_labels(graph, merge.usable_relations(batch), taken))
        refs = cut_lineage(merge.references(usable))
        few = fits_memory(refs)
        known = cut_lineage(merge.endpoints(graph, refs, few))
        resolved = merge.fold_relations(merge.resolve_relations(graph, usable, known))
        return usable, few, merge.first_edges(resolved, keyed=True)

    def _new_edges(self, edges: DataFrame, stored: DataFrame | None = None) -> DataFrame:
        """Edges that are not stored yet, settled; compared with stored edges of their labels."""
        fresh = cut_lineage(edges)
        if stored is None:
            stored = self.disk.graph(edge_labels=cut_lineage(fresh.select("label").distinct())).edges
        return cut_lineage(not_stored(fresh, stored, ["label", "src", "dst"], fits_memory(fresh)))

    def bulk_insert(self, label: str, rows: DataFrame, key: Column, props: Column, **columns: Column) -> int:
        """Append rows of a type and return how many were written.

        Rows without a key are left out; a key that comes twice or is stored is an error.
        """
        self.disk.refresh()
        added = cut_lineage(self._fit(merge.plain_records(label, rows, key, props, **columns)))
        self._check_types(added)
        stored = self.disk.graph([label]).vertices.select("vid").join(mark(added, fits_memory(added)), "vid", "left_semi")
        twice = added.groupBy("vid").count().where("count > 1").select("vid")
        again = stored.union(twice).first()
        if again:
            raise ValueError(f"{again.vid!r} is there already")
        written = added.count()
        self.disk.append("vertices", added)
        return written

    def bulk_upsert(self, label: str, rows: DataFrame, key: Column, seq: Column, props: Column,
                    **columns: Column) -> int:
        """Insert or update rows of a type by key; returns the number of rows with a key."""
        self.disk.refresh()
        ordered = cut_lineage(self._fit(merge.plain_records(label, rows, key, props, [seq.alias("seq")], **columns)))
        self._check_types(ordered)
        self._merge(cut_lineage(merge.collapse_nodes(ordered)))
        return ordered.count()

    def update_where(self, label: str, where: Column, props: dict[str, Column]) -> None:
        self.disk.refresh()
        graph = self.disk.graph([label])
        hit = graph.vertices.where(where)
        parts = self.disk.parts_of("vertices", hit)
        if parts.isEmpty():
            return
        part = graph.with_vertices(self.disk.part("vertices", parts))
        self.disk.replace("vertices", merge.update_where(part, label, where, props).vertices)
        # Properties that any row has now; those cleared everywhere stay known.
        self.disk.note("vertices", cut_lineage(self.disk.part("vertices", parts).where(F.col("label") == label)))

    def delete(self, entity_names: Sequence[str] | None = None, relation_names: Sequence[str] | None = None,
               properties: Mapping[str, object] | None = None, ids: Sequence[str] | None = None) -> None:
        self.disk.remove(deletes.plan(self.graph, entity_names, relation_names, properties, ids))

    def delete_records(self, vids: Sequence[str] | DataFrame) -> None:
        self.disk.remove(deletes.plan_records(self.graph, vids))

    def delete_all_of(self, label: str) -> int:
        removed = deletes.count_of_type(self.graph, label)
        self.disk.remove(deletes.plan_types([label]))
        return removed

    def bulk_delete(self, label: str, conditions: Sequence[Mapping[str, object]], safe_mode: bool = True) -> None:
        self.disk.remove(deletes.plan_bulk(label, conditions, safe_mode))

    def refresh_documents(self, documents: Sequence[str], nodes: Sequence[object] | DataFrame,
                          relations: Sequence[Relation] | DataFrame = ()) -> None:
        """Drop what came from documents and write their new content.  Everything is computed
        before anything is written."""
        graph = self.graph
        gone, lost = self.disk.doomed(deletes.plan_documents(graph, documents))
        few_gone, few_lost = fits_memory(gone), fits_memory(lost)

        def left(rows: DataFrame, kind: str) -> DataFrame:
            doomed, few, key = (gone, few_gone, ["label", "vid"]) if kind == "vertices" else (
                lost, few_lost, ["label", "src", "dst"])
            return rows.join(mark(doomed, few), key, "left_anti").select(*rows.columns)

        prepared, collapsed = self._prepared(nodes)
        parts = cut_lineage(self.disk.parts_of("vertices", gone).union(self.disk.parts_of("vertices", collapsed)).distinct())
        vertices = cut_lineage(merge.merge_vertices(
            left(self.disk.part("vertices", parts), "vertices"), collapsed, fits_memory(collapsed)))
        kept = left(graph.vertices, "vertices")
        after = graph.with_vertices(merge.merge_vertices(kept, collapsed, fits_memory(collapsed))).with_edges(
            left(graph.edges, "edges"))
        sourced = prepared.where((F.col("kind") == "entity") & F.col("triplet_source_id").isNotNull())
        fresh = merge.mentions(sourced, merge.chunk_ids(after.vertices))
        if isinstance(relations, DataFrame) or len(relations):
            _, _, edges = self._resolved(after, relations, collapsed)
            fresh = fresh.unionByName(edges.drop(KEY_HASH)).dropDuplicates(["label", "src", "dst"])
        added = self._new_edges(fresh, after.edges)
        # All is settled.  Edges that go come first, edges that are new last: no edge lacks an end.
        self.disk.without("edges", lost)
        self.disk.enter("vertices", collapsed)
        self.disk.replace("vertices", vertices, parts)
        self.disk.note("vertices", collapsed)
        self.disk.append("edges", added)

    def clear(self) -> None:
        self.disk.refresh()
        self.disk.truncate()

    def compact(self) -> None:
        """Gather what many appends left in many files."""
        self.disk.compact()
