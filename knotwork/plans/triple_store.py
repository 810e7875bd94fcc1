"""The plain triple store."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from knotwork.functions.text import BASE_ENTITY
from knotwork.model import PropertyGraph
from knotwork.operators import delete as deletes, merge, scans, traverse
from knotwork.plans import sql
from knotwork.operators.sizes import fits_memory, not_stored
from knotwork.session import cut_lineage, shared_dir
from knotwork.sources.store import GraphStore

TRIPLE = "subject string, relation string, object string"


class TripleStore:
    """Triples over vertices that are known by id under one node label."""

    def __init__(self, spark: SparkSession, path: str | None = None, node_label: str = BASE_ENTITY,
                 create: bool = True) -> None:
        self.spark = spark
        self.node_label = node_label
        self.schema = ""
        self.disk = GraphStore(spark, path or f"{shared_dir(spark)}/triples-{uuid.uuid4().hex}", create)

    @property
    def graph(self) -> PropertyGraph:
        self.disk.refresh()
        return self.disk.graph()

    def _table(self, triples: Sequence[tuple[str, str, str]] | DataFrame) -> DataFrame:
        return triples if isinstance(triples, DataFrame) else self.spark.createDataFrame(list(triples), TRIPLE)

    def get(self, subject: str) -> DataFrame:
        return traverse.subject_triplets(self.graph, self.node_label, subject)

    def get_rel_map(self, subjects: Sequence[str] | None = None, depth: int = 2, limit: int = 30) -> DataFrame:
        """Paths of one to ``depth`` relations from each subject."""
        graph = self.graph
        starts = graph.vertices.where(
            (F.col("label") == self.node_label) & F.col("id").isin(*(subjects or []))
        )
        found = traverse.paths(graph, starts, depth, limit)
        return found.select(
            F.expr(f"substring(start, {len(self.node_label) + 2})").alias("subject"), "length",
            F.transform("path", lambda x, i: F.when(i % 2 == 0, x).otherwise(
                F.substr(x, F.lit(len(self.node_label) + 2)))).alias("path"),
        )

    def upsert_triplet(self, subject: str, relation: str, obj: str) -> None:
        self.upsert_triplets([(subject, relation, obj)])

    def upsert_triplets(self, triples: Sequence[tuple[str, str, str]] | DataFrame) -> None:
        """Make sure both ends and the edge of every triple exist; rows with a blank part
        are left out.  Only stored rows of the labels concerned are read."""
        self.disk.refresh()
        fresh = merge.triples_graph(self._table(triples), self.node_label)
        vertices, edges = cut_lineage(fresh.vertices), cut_lineage(fresh.edges)
        stored = self.disk.graph([self.node_label], cut_lineage(edges.select("label").distinct()))
        vertices = cut_lineage(not_stored(vertices, stored.vertices, ["vid"], fits_memory(vertices)))
        edges = cut_lineage(not_stored(edges, stored.edges, ["label", "src", "dst"], fits_memory(edges)))
        self.disk.append("vertices", vertices)
        self.disk.append("edges", edges)

    def delete(self, subject: str, relation: str, obj: str) -> None:
        self.delete_triplets([(subject, relation, obj)])

    def delete_triplets(self, triples: Sequence[tuple[str, str, str]] | DataFrame) -> None:
        self.disk.remove(deletes.plan_triples(self.graph, self._table(triples), self.node_label))

    def refresh_schema(self) -> None:
        self.schema = scans.schema_text(self.graph)

    def get_schema(self, refresh: bool = False) -> str:
        if not self.schema or refresh:
            self.refresh_schema()
        return self.schema

    def query(self, query: str, param_map: Mapping[str, object] | None = None) -> DataFrame:
        """Spark SQL; the values of ``param_map`` fill ``?`` marks in order, as text."""
        graph = self.graph
        return sql.query_views(graph, query, param_map, catalogue=self.disk.catalogue(),
                               declared=[self.node_label], positional=True)

    def clear(self) -> None:
        self.disk.refresh()
        self.disk.truncate()
