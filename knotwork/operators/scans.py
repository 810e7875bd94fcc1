"""Scans of vertices, edges and the type catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from knotwork.functions.props import DECLARED, without_system_fields
from knotwork.functions.text import BASE_ENTITY, TEXT_CHUNK, is_blank
from knotwork.model import BASIC_TYPES, CORE_RELATIONS, CORE_TYPES, PropertyGraph, edge_id
from knotwork.operators.ranking import first_rows, top_per_group

# Types that a summary for the driver may have.
MAX_TYPES = 10_000


def typed_scan(graph: PropertyGraph, label: str) -> DataFrame:
    """Vertices stored under exactly this label."""
    return graph.vertices.where(F.col("label") == label)


def polymorphic_scan(graph: PropertyGraph, base: str) -> DataFrame:
    """Vertices of a type and of every type below it."""
    return graph.vertices.where(graph.in_type(base))


def edge_scan(graph: PropertyGraph, label: str) -> DataFrame:
    """Record id and endpoints of one edge type."""
    return graph.edges.where(F.col("label") == label).select(
        edge_id().alias("eid"), "label", "src", "dst"
    )


def fetch(graph: PropertyGraph, vids: DataFrame) -> DataFrame:
    """Records by record id, for a whole table of ids at once (column ``vid``)."""
    return graph.vertices.join(vids.select("vid").distinct(), "vid", "left_semi")


def all_nodes(graph: PropertyGraph, per_type: int | None = 50) -> DataFrame:
    """Up to ``per_type`` vertices of every label, in key order; None for all."""
    if per_type is None:
        return graph.vertices
    return top_per_group(graph.vertices, ["label"], [F.col("key")], per_type)


def records(graph: PropertyGraph, types: str | Sequence[str], where: Column | None = None,
            limit: int | None = None) -> DataFrame:
    """Rows of one or several types with an optional predicate and limit."""
    names = [types] if isinstance(types, str) else list(types)
    rows = graph.vertices.where(F.col("label").isin(*names))
    if where is not None:
        rows = rows.where(where)
    return rows if limit is None else first_rows(rows, ["label", "key"], limit)


def node_view(vertices: DataFrame) -> DataFrame:
    """Vertices as returned nodes: system fields apart from properties.

    Text chunks show id and text, every other node its name or record id.
    """
    chunk = F.col("label") == TEXT_CHUNK
    return vertices.select(
        "vid", "label",
        F.when(chunk, F.coalesce("id", "vid"))
        .otherwise(F.coalesce(F.nullif("name", F.lit("")), F.col("vid"))).alias("node_id"),
        F.when(chunk, F.coalesce("text", F.lit(""))).alias("text"),
        without_system_fields(F.col("props")).alias("props"),
    )


def relation_view(edges: DataFrame) -> DataFrame:
    """Edges as returned relations, endpoint fields kept out of the properties."""
    endpoint_fields = ["source_id", "target_id", "out", "in"]
    return edges.select(
        edge_id().alias("eid"), "label",
        F.col("src").alias("source_id"), F.col("dst").alias("target_id"),
        F.map_filter(
            "props", lambda k, _: ~k.startswith("@") & ~k.isin(*endpoint_fields)
        ).alias("props"),
    )


# Catalogue --------------------------------------------------------------------


def type_names(graph: PropertyGraph, basic: bool = False) -> DataFrame:
    """Names of all vertex and edge types: the declared core and what is stored."""
    core = [("vertex", t) for t in CORE_TYPES + (BASIC_TYPES if basic else [])]
    core += [("edge", t) for t in CORE_RELATIONS]
    stored = graph.vertices.select(F.lit("vertex").alias("kind"), "label").union(
        graph.edges.select(F.lit("edge").alias("kind"), "label")
    )
    return stored.union(graph.spark.createDataFrame(core, "kind string, label string")).distinct()


def catalogue(graph: PropertyGraph, basic: bool = False) -> DataFrame:
    """Types with their parent type."""
    rows = [(c, p) for c, p in graph.parents.items()]
    given = graph.spark.createDataFrame(rows, "label string, given string").withColumn(
        "declared", F.lit(True)
    )
    outside = F.col("label").isin(BASE_ENTITY, TEXT_CHUNK) | (F.col("kind") == "edge")
    return (
        type_names(graph, basic).join(given, "label", "left")
        .select(
            "kind", "label",
            F.when(F.col("declared"), F.col("given"))
            .when(~outside, F.lit(BASE_ENTITY)).alias("parent"),
        )
    )


def property_names(df: DataFrame, declared: Sequence[str] = ()) -> Column:
    """Names of the properties a row has, as an array (NULL entries stand for none)."""
    used = [F.when(F.col(c).isNotNull(), F.lit(c)) for c in declared if c in df.columns]
    return F.array_union(F.array(*used, F.lit(None).cast("string")), F.map_keys("props"))


def type_properties(graph: PropertyGraph) -> DataFrame:
    """Property names in use per type."""
    found = [
        df.select(F.lit(kind).alias("kind"), "label",
                  F.explode(property_names(df, [*DECLARED, "embedding"])).alias("property"))
        for kind, df in (("vertex", graph.vertices), ("edge", graph.edges))
    ]
    return found[0].union(found[1]).where(F.col("property").isNotNull()).distinct()


def sample_names(graph: PropertyGraph, per_type: int = 5) -> DataFrame:
    """A few names per type, in name order."""
    named = graph.vertices.where(F.coalesce(F.col("name") != "", F.lit(False)))
    return top_per_group(
        named.select(F.col("label").alias("type"), "name"), ["type"], [F.col("name")], per_type
    )


def entity_names(graph: PropertyGraph, limit: int | None = 100) -> DataFrame:
    """Distinct names that are not blank."""
    names = graph.vertices.select("name").where(~is_blank(F.col("name"))).distinct()
    return names if limit is None else first_rows(names, ["name"], limit)


# Counts -----------------------------------------------------------------------


def count_by_label(graph: PropertyGraph) -> DataFrame:
    """Entities and chunks per concrete type, the most frequent first."""
    counted = graph.vertices.where(graph.in_type(BASE_ENTITY) | (F.col("label") == TEXT_CHUNK))
    return (
        counted.groupBy(F.col("label").alias("entity_type"))
        .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "entity_type")
    )


def count_of(graph: PropertyGraph, base: str) -> DataFrame:
    """Number of vertices of a type, subtypes included."""
    return polymorphic_scan(graph, base).agg(F.count(F.lit(1)).alias("count"))


def schema_table(graph: PropertyGraph, basic: bool = False, per_type: int = 5,
                 known: DataFrame | None = None) -> DataFrame:
    """(kind, label, properties, samples): one row per type, its properties sorted, and up to
    ``per_type`` names of its vertices.

    ``known`` is a stored catalogue (kind, label, property); without one the graph is scanned.
    A type's properties and samples are gathered, never the types.
    """
    core = [("vertex", t) for t in CORE_TYPES + (BASIC_TYPES if basic else [])] + [("edge", t) for t in CORE_RELATIONS]
    named = graph.spark.createDataFrame(core, "kind string, label string").withColumn("property", F.lit(None).cast("string"))
    if known is None:
        known = type_names(graph).withColumn("property", F.lit(None).cast("string")).union(type_properties(graph))
    types = named.union(known.select("kind", "label", "property")).groupBy("kind", "label").agg(
        F.sort_array(F.collect_set("property")).alias("properties"))
    names = sample_names(graph, per_type).groupBy(F.col("type").alias("label")).agg(
        F.sort_array(F.collect_list("name")).alias("samples"))
    vertex = types.where("kind = 'vertex'").join(names, "label", "left")
    edge = types.where("kind = 'edge'").withColumn("samples", F.lit(None).cast("array<string>"))
    return vertex.unionByName(edge).select(
        "kind", "label", "properties", F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def _bounded(rows: DataFrame, max_types: int) -> list:
    """All rows of a schema for the driver, or an error when there are too many."""
    found = rows.limit(max_types + 1).collect()
    if len(found) > max_types:
        raise ValueError(f"the graph has more than {max_types} types; use schema_table")
    return sorted(found, key=lambda r: (r.kind, r.label))


def schema_summary(graph: PropertyGraph, basic: bool = False, per_type: int = 5,
                   known: DataFrame | None = None, max_types: int = MAX_TYPES) -> dict:
    """Types with properties and sample names, as one dictionary of at most ``max_types`` types."""
    rows = _bounded(schema_table(graph, basic, per_type, known), max_types)

    def listing(kind: str) -> list[dict]:
        return [{"name": r.label, "properties": r.properties} for r in rows if r.kind == kind]

    samples = [{"type": r.label, "name": name} for r in rows for name in r.samples]
    return {
        "vertex_types": listing("vertex"),
        "edge_types": listing("edge"),
        "sample_entities": samples,
        "entity_count": len(samples),
    }


def schema_text(graph: PropertyGraph, max_types: int = MAX_TYPES) -> str:
    """The type listing as text, for at most ``max_types`` types."""
    names = _bounded(type_names(graph), max_types)
    vertex = [r.label for r in names if r.kind == "vertex"]
    edge = [r.label for r in names if r.kind == "edge"]
    return f"Vertex Types: {vertex}\nEdge Types: {edge}"
