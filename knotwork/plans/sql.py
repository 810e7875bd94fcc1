"""SQL over the graph: one temporary view per type, and graph steps as table functions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from knotwork.functions.props import DECLARED
from knotwork.functions.text import BASE_ENTITY
from knotwork.model import PropertyGraph, edge_id
from knotwork.operators.scans import polymorphic_scan, type_names


def vertex_view(graph: PropertyGraph, label: str, properties: Sequence[str] = ()) -> DataFrame:
    """Rows of a type and the types below it; named properties become columns."""
    fixed = ["vid", "label", *DECLARED, "embedding", "props"]
    return polymorphic_scan(graph, label).select(*fixed, *_own(properties, fixed))


def _own(properties: Sequence[str], fixed: Sequence[str]) -> list[Column]:
    """Properties as columns.  SQL names know no case: a name like that of a fixed
    column, or of another property, stays in ``props`` only."""
    seen = {c.lower() for c in fixed}
    shown = []
    for p in sorted(properties):
        if p.lower() not in seen:
            seen.add(p.lower())
            shown.append(F.try_element_at("props", F.lit(p)).alias(p))
    return shown


def edge_view(graph: PropertyGraph, label: str, properties: Sequence[str] = ()) -> DataFrame:
    fixed = ["eid", "label", "src", "dst", "props"]
    return graph.edges.where(F.col("label") == label).withColumn("eid", edge_id()).select(*fixed, *_own(properties, fixed))


def register_views(graph: PropertyGraph, properties: Mapping[str, Sequence[str]] | None = None,
                   labels: Mapping[str, str] | None = None) -> list[str]:
    """Create a view per vertex and edge type, and return their names.

    ``labels`` (name to ``vertex`` or ``edge``) saves the scan that finds the
    types; ``properties`` gives the map entries that a view shows as columns.
    """
    known = dict(labels) if labels is not None else {
        r.label: r.kind for r in type_names(graph).collect()
    }
    known.setdefault(BASE_ENTITY, "vertex")
    for label, kind in known.items():
        own = (properties or {}).get(label, ())
        view = vertex_view(graph, label, own) if kind == "vertex" else edge_view(graph, label, own)
        view.createOrReplaceTempView(f"`{label}`")
    return sorted(known)


# Table functions of a statement: arguments, result and body.  Spark puts the body in place of
# the call, so a lateral join with one is an equi join with the edges.
EDGE = "eid STRING, label STRING, src STRING, dst STRING, props MAP<STRING, STRING>"
NEAR = "vid STRING, relation STRING"
_CALL = "start STRING, kind STRING DEFAULT NULL"
_KIND = "(kind IS NULL OR label = kind)"
FUNCTIONS = {
    "out_v": (_CALL, NEAR, f"SELECT dst, label FROM `_edges` WHERE src = start AND {_KIND}"),
    "in_v": (_CALL, NEAR, f"SELECT src, label FROM `_edges` WHERE dst = start AND {_KIND}"),
    "both_v": (_CALL, NEAR, f"SELECT other, label FROM `_ways` WHERE this = start AND {_KIND}"),
    "out_e": (_CALL, EDGE, f"SELECT eid, label, src, dst, props FROM `_edges` WHERE src = start AND {_KIND}"),
    "in_e": (_CALL, EDGE, f"SELECT eid, label, src, dst, props FROM `_edges` WHERE dst = start AND {_KIND}"),
    "both_e": (_CALL, EDGE, f"SELECT eid, label, src, dst, props FROM `_ways` WHERE this = start AND {_KIND}"),
}


def _names(query: str) -> set[str]:
    """Every word and every quoted name of a statement, in lower case."""
    return {x.lower() for x in re.findall(r"\w+", query)} | {x.lower() for x in re.findall(r"`([^`]+)`", query)}


def _known(graph: PropertyGraph, catalogue: DataFrame | None, names: set[str],
           declared: Sequence[str]) -> dict[str, tuple[str, list[str]]]:
    """Kind and properties of the types that a statement names; no other type is collected."""
    if catalogue is None:
        catalogue = type_names(graph).withColumn("property", F.lit(None).cast("string"))
    found = {x: ("vertex", []) for x in (BASE_ENTITY, *declared) if x.lower() in names}
    rows = catalogue.where(F.lower("label").isin(*names)).groupBy("kind", "label").agg(F.collect_set("property").alias("own"))
    # An edge type that is declared as a vertex type too is what it was written as.
    return found | {r.label: (r.kind, r.own) for r in rows.orderBy(F.desc("kind")).collect()}


def _both_ways(edges: DataFrame) -> DataFrame:
    """Edges seen from either end (``this`` and ``other``), loops once, out of one scan."""
    there = F.struct(F.col("src").alias("this"), F.col("dst").alias("other"))
    back = F.struct(F.col("dst").alias("this"), F.col("src").alias("other"))
    ways = F.when(F.col("src") != F.col("dst"), F.array(there, back)).otherwise(F.array(there))
    return edges.select("*", F.inline(ways))


def query_views(graph: PropertyGraph, query: str, params: Mapping[str, object] | Sequence[object] | None = None,
                catalogue: DataFrame | None = None, declared: Sequence[str] = (), positional: bool = False) -> DataFrame:
    """Run a statement over the views of one graph.

    Types that the statement names get a view, ``V`` and ``E`` stand for all vertices and all
    edges, and the functions of FUNCTIONS can be called.  All of these go once the statement is
    analysed, so another graph never answers for this one.  ``catalogue`` (kind, label,
    property) saves the scan that finds the types.  Two named types that differ in case only
    cannot be told apart and are refused.
    """
    spark, names = graph.spark, _names(query)
    known = _known(graph, catalogue, names, declared)
    folded: dict[str, str] = {}
    for label in known:
        if folded.setdefault(label.lower(), label) != label:
            raise ValueError(f"types {folded[label.lower()]!r} and {label!r} have one name in SQL")
    called = [f for f in FUNCTIONS if f in names]
    views = {label: vertex_view(graph, label, own) if kind == "vertex" else edge_view(graph, label, own)
             for label, (kind, own) in known.items()}
    if "v" in names and "v" not in folded:
        views["V"] = graph.vertices.drop("key")
    edges = graph.edges.withColumn("eid", edge_id())
    if "e" in names and "e" not in folded:
        views["E"] = edges
    if called:
        views["_edges"] = edges
        views["_ways"] = _both_ways(edges)
    made = []
    try:
        for view, rows in views.items():
            rows.createOrReplaceTempView(f"`{view}`")
            made.append(f"VIEW IF EXISTS `{view}`")
        for name in called:
            arguments, result, body = FUNCTIONS[name]
            spark.sql(f"CREATE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({result}) RETURN {body}")
            made.append(f"TEMPORARY FUNCTION IF EXISTS {name}")
        return run_sql(spark, query, params, positional)
    finally:
        for thing in reversed(made):
            spark.sql(f"DROP {thing}")


def run_sql(spark: SparkSession, query: str, params: Mapping[str, object] | Sequence[object] | None = None,
            positional: bool = False) -> DataFrame:
    """Run a statement with bound parameters.

    With ``positional`` a mapping's values fill the ``?`` marks in order, as text.
    """
    if not params:
        return spark.sql(query)
    if positional and isinstance(params, Mapping):
        return spark.sql(query, args=[str(v) for v in params.values()])
    return spark.sql(query, args=params if isinstance(params, Mapping) else list(params))
