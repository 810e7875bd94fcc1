"""Triplets, neighbourhoods and paths."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from knotwork.functions.props import all_equal
from knotwork.functions.text import TEXT_CHUNK
from knotwork.model import PropertyGraph, edge_id
from knotwork.operators.lookup import MAX_LITERALS, literal_ids, settle, start_vertices, vertices_of
from knotwork.operators.ranking import first_rows, top_per_group
from knotwork.operators.sizes import MAX_BROADCAST_BYTES, fits_memory, mark, measured_bytes
from knotwork.session import cut_lineage

EDGE_ORDER = ("label", "src", "dst")


def display_name() -> Column:
    """What a triplet shows for a vertex: its name, else its id."""
    return F.coalesce(F.nullif(F.col("name"), F.lit("")), F.nullif(F.col("id"), F.lit("")))


# Triplets ---------------------------------------------------------------------


def triplets(graph: PropertyGraph, relations: Sequence[str] | None = None,
             subject_where: Column | None = None, object_where: Column | None = None,
             per_type: int | None = None) -> DataFrame:
    """(subject, relation, object) by name, edges joined to both ends.

    Filters sit on the scans below the joins.  Ends without a name or id drop out.
    ``per_type`` keeps the first edges of every type, before names are looked up.
    """
    edges = graph.edges.select("label", "src", "dst")
    if relations is not None:
        edges = edges.where(F.col("label").isin(*relations))
    if per_type is not None:
        edges = top_per_group(edges, ["label"], [F.col("src"), F.col("dst")], per_type)

    def ends(where: Column | None, vid: str, shown: str) -> DataFrame:
        side = graph.vertices if where is None else graph.vertices.where(where)
        named = side.select(F.col("vid").alias(vid), display_name().alias(shown))
        return named.where(F.col(shown).isNotNull())

    joined = edges.join(ends(subject_where, "src", "subject"), "src").join(
        ends(object_where, "dst", "object"), "dst"
    )
    return joined.select("subject", F.col("label").alias("relation"), "object", "src", "dst")


def triplets_by_type(graph: PropertyGraph, subject_types: Sequence[str] | None = None,
                     relation_types: Sequence[str] | None = None,
                     object_types: Sequence[str] | None = None) -> DataFrame:
    """Single-edge pattern with optional type sets on each part."""
    def typed(names: Sequence[str] | None) -> Column | None:
        return None if names is None else F.col("label").isin(*names)

    return triplets(graph, relation_types, typed(subject_types), typed(object_types))


def triplet_listing(graph: PropertyGraph, entity_names: Sequence[str] | None = None,
                    relation_names: Sequence[str] | None = None, properties: dict | None = None,
                    ids: Sequence[str] | None = None, per_type: int | None = 100) -> DataFrame:
    """Triplets that satisfy every given filter; name, id and property filters hold
    when either end satisfies them.  Edges are cut down before names are joined."""
    edges = graph.edges.select("label", "src", "dst")
    if relation_names:
        edges = edges.where(F.col("label").isin(*relation_names))
    for wanted in (
        F.col("name").isin(*entity_names) if entity_names else None,
        F.col("id").isin(*ids) | F.col("name").isin(*ids) if ids else None,
        all_equal(properties) if properties else None,
    ):
        if wanted is not None:
            edges = touching(edges, graph.vertices.where(F.coalesce(wanted, F.lit(False))))
    return triplets(graph.with_edges(edges), per_type=per_type)


def subject_triplets(graph: PropertyGraph, node_label: str, subject: str) -> DataFrame:
    """Outgoing triplets of one subject id in the triple store.

    Record ids hold the id, so this is a filtered scan of the edges without a join.
    """
    prefix = f"{node_label}/"
    out = graph.edges.where((F.col("src") == prefix + subject) & F.col("dst").startswith(prefix))
    return out.select(
        F.lit(subject).alias("subject"), F.col("label").alias("relation"),
        F.substr("dst", F.lit(len(prefix) + 1)).alias("object"),
    )


NODE_FIELDS = ["vid", "label", "name", "id", "text", "ref_doc_id", "doc_id", "triplet_source_id", "props"]


def rich_triplets(graph: PropertyGraph, edges: DataFrame, limit: int | None = None) -> DataFrame:
    """Edges with full nodes on both ends: (source, relation, target) structs.

    Edges cut to ``limit`` rows are settled first, so only the vertices they name
    are read; without a limit both ends are joined.
    """
    nodes = graph.vertices
    if limit is not None:
        edges = settle(edges, limit)
        nodes = vertices_of(graph, edges, limit, "src", "dst")

    def node(vid: str, name: str) -> DataFrame:
        return nodes.select(F.col("vid").alias(vid), F.struct(*NODE_FIELDS).alias(name))

    both = edges.join(node("src", "source"), "src").join(node("dst", "target"), "dst")
    relation = F.struct(edge_id().alias("eid"), "label", "src", "dst", "props")
    return both.select("source", relation.alias("relation"), "target")


# Neighbours -------------------------------------------------------------------


def out_neighbors(graph: PropertyGraph, starts: DataFrame, relation: str | None = None) -> DataFrame:
    """``vid`` to ``neighbor`` along edges that leave the start vertices."""
    return _hop(graph, starts, "src", "dst", relation)


def in_neighbors(graph: PropertyGraph, starts: DataFrame, relation: str | None = None) -> DataFrame:
    return _hop(graph, starts, "dst", "src", relation)


def both_neighbors(graph: PropertyGraph, starts: DataFrame, relation: str | None = None) -> DataFrame:
    return out_neighbors(graph, starts, relation).unionByName(in_neighbors(graph, starts, relation))


def _hop(graph: PropertyGraph, starts: DataFrame, here: str, there: str, relation: str | None) -> DataFrame:
    edges = graph.edges if relation is None else graph.edges.where(F.col("label") == relation)
    wanted = starts.select("vid").distinct()
    return edges.select(F.col(here).alias("vid"), "label", F.col(there).alias("neighbor")).join(
        wanted, "vid", "left_semi"
    )


def touching(edges: DataFrame, starts: DataFrame, bound: int | None = None, fits: bool = False) -> DataFrame:
    """Rows with ``src`` or ``dst`` among the start vertices, each once.

    One pass over the edges: both membership tests are existence flags, so an edge
    inside the start set is not produced twice and needs no de-duplication.  A
    settled start set of at most ``bound`` rows is a plain predicate instead, and one
    that was measured (``fits``) is broadcast.
    """
    ids = literal_ids(starts, bound, "vid")
    if ids is not None:
        return edges.where(F.col("src").isin(*ids) | F.col("dst").isin(*ids))
    wanted = starts.select(F.col("vid").alias("_vid")).distinct()
    flagged = edges
    for end, flag in (("src", "_out"), ("dst", "_in")):
        side = mark(wanted.withColumn(flag, F.lit(True)), fits)
        flagged = flagged.join(side, F.col(end) == F.col("_vid"), "left").drop("_vid")
    return flagged.where(F.col("_out") | F.col("_in")).drop("_out", "_in")


def types_among(settled: DataFrame) -> list[str] | None:
    """The types that settled record ids (column ``vid``) begin with, or None when they are
    too many for a predicate."""
    found = settled.select(_type_of("vid").alias("type")).where(F.col("type").isNotNull()).distinct()
    types = sorted(r.type for r in found.limit(MAX_LITERALS + 1).collect())
    return types if len(types) <= MAX_LITERALS else None


def _type_of(vid: str) -> Column:
    return F.substring_index(vid, "/", 1)


def at_types(rows: DataFrame, types: list[str] | None, *ends: str) -> DataFrame:
    """Rows with a record id of one of the types in some of the columns.  Other rows cannot
    meet vertices of these types, so they are left out before any shuffle."""
    if types is None:
        return rows
    return rows.where(reduce(Column.__or__, [_type_of(end).isin(*types) if types else F.lit(False) for end in ends]))


def incident_edges(graph: PropertyGraph, starts: DataFrame, limit: int | None = None) -> DataFrame:
    """Edges in either direction around the start vertices."""
    edges = touching(graph.edges, starts)
    return edges if limit is None else first_rows(edges, EDGE_ORDER, limit)


def rel_map(graph: PropertyGraph, refs: DataFrame, depth: int = 2, limit: int = 30,
            ignore_rels: Sequence[str] | None = None, limit_first: bool = True,
            one_hop: bool = False, bound: int | None = None) -> DataFrame:
    """Relationship map around nodes given by name or id (column ``ref``).

    Relations up to ``depth`` hops away belong to it; ``one_hop`` expands a single
    hop whatever ``depth`` says.  The limit applies before relations are ignored, or
    after that with ``limit_first=False``.  ``bound`` is the number of references when
    the caller knows it.
    """
    starts = start_vertices(graph, refs).select("vid").distinct()
    if not one_hop and depth > 1:
        starts, bound = k_hop(graph, starts, depth - 1).select("vid"), None
    else:
        starts = settle(starts, bound)
    wanted = None if not ignore_rels else ~F.col("label").isin(*ignore_rels)
    if bound is None:
        near = at_types(graph.edges, types_among(starts), "src", "dst")
        edges = touching(near, starts, fits=fits_memory(starts))
    else:
        edges = touching(graph.edges, starts, bound)
    if wanted is not None and not limit_first:
        edges = edges.where(wanted)
    edges = first_rows(edges, EDGE_ORDER, limit)
    if wanted is not None and limit_first:
        edges = edges.where(wanted)
    return rich_triplets(graph, edges, limit)


def k_hop(graph: PropertyGraph, starts: DataFrame, depth: int) -> DataFrame:
    """Vertices within ``depth`` undirected hops: ``vid`` and smallest ``depth``.

    Breadth first over a table of frontiers.  Visited vertices are removed, and every
    level is written to the checkpoint folder so the plan does not grow with the number
    of hops.  Vertices that were measured to fit are sent to the edges.
    """
    frontier = cut_lineage(starts.select("vid").distinct())
    reached, held = frontier.withColumn("depth", F.lit(0)), 0
    for level in range(1, depth + 1):
        own = measured_bytes(frontier)
        held += own
        step = _around(graph.edges, frontier, own <= MAX_BROADCAST_BYTES)
        visited = mark(reached.select("vid"), held <= MAX_BROADCAST_BYTES)
        frontier = cut_lineage(step.join(visited, "vid", "left_anti"))
        reached = reached.union(frontier.withColumn("depth", F.lit(level)))
    return reached


def _around(edges: DataFrame, settled: DataFrame, fits: bool) -> DataFrame:
    """Neighbours of settled vertices, each once."""
    types = types_among(settled)
    ways = at_types(both_ways(at_types(edges, types, "src", "dst")), types, "vid")
    found = ways.join(mark(settled.select("vid"), fits), "vid", "left_semi")
    return found.select(F.col("neighbor").alias("vid")).distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge seen from either end, out of one scan."""
    ends = F.array(
        F.struct(F.col("src").alias("vid"), F.col("dst").alias("neighbor")),
        F.struct(F.col("dst").alias("vid"), F.col("src").alias("neighbor")),
    )
    return edges.select(F.inline(ends))


def k_hop_neighbors(graph: PropertyGraph, starts: DataFrame, depth: int) -> DataFrame:
    """Neighbours of everything within ``depth`` hops, each once."""
    reached = k_hop(graph, starts, depth).select("vid")
    return _around(graph.edges, reached, fits_memory(reached))


def paths(graph: PropertyGraph, starts: DataFrame, depth: int = 2, limit: int | None = 30,
          final_target: bool = True) -> DataFrame:
    """Outgoing paths of one to ``depth`` edges, no edge used twice in a path.

    ``path`` alternates relation and target; with ``final_target`` the last target
    stands after every relation.  Shorter paths come first, then alphabetical
    order.  With a limit a level is cut to the rows that are still missing; once they
    are found no longer path is walked, and until then a level holds fewer rows than
    the limit.  No vertex needs more than its first ``limit + depth`` outgoing edges,
    whatever its degree: later ones can only give paths that sort behind ``limit``
    others (``depth`` more allow for edges a path already used).
    """
    edges = graph.edges.select("label", "src", "dst")
    first = cut_lineage(starts.select(F.col("vid").alias("start")))
    walks = first.select("start", F.col("start").alias("end"), F.array().cast("array<string>").alias("steps"))
    levels, missing = [], limit or 0
    for level in range(1, depth + 1):
        ends = cut_lineage(walks.select(F.col("end").alias("vid")).distinct())
        nearby = at_types(edges, types_among(ends), "src")
        # Edges that leave few ends are few, unless one is a hub, and sent to the walks if so.
        few = fits_memory(ends)
        if few or limit is not None:
            nearby = nearby.join(mark(ends.select(F.col("vid").alias("src")), few), "src", "left_semi")
        if limit is not None:
            nearby = top_per_group(nearby, ["src"], [F.col("label"), F.col("dst")], limit + depth)
        elif few and level > 1:
            nearby = cut_lineage(nearby)
            nearby = mark(nearby, fits_memory(nearby))
        walks = walks.join(nearby, walks["end"] == nearby["src"]).where(~_walked(level - 1)).select(
            "start", F.col("dst").alias("end"), F.concat("steps", F.array("label", "dst")).alias("steps"),
        )
        if limit is not None:
            walks = cut_lineage(first_rows(walks, ["start", "steps"], missing))
            missing -= walks.count()
        elif level < depth and depth > 2:
            walks = cut_lineage(walks)
        levels.append(walks.select("start", "end", F.lit(level).alias("length"), "steps"))
        if limit is not None and missing <= 0:
            break
    found = levels[0]
    for more in levels[1:]:
        found = found.union(more)
    if limit is not None:
        found = first_rows(found, ["length", "start", "steps"], limit)
    if not final_target:
        return found.withColumnRenamed("steps", "path")
    return found.withColumn("path", F.transform(
        "steps", lambda x, i: F.when(i % 2 == 0, x).otherwise(F.col("end"))
    )).drop("steps")


def _walked(length: int) -> Column:
    """Whether an edge is one of the ``length`` edges that a path consists of."""
    same = F.lit(False)
    for i in range(length):
        src = F.col("start") if i == 0 else F.get("steps", F.lit(2 * i - 1))
        edge = zip(("label", "src", "dst"), (F.get("steps", F.lit(2 * i)), src, F.get("steps", F.lit(2 * i + 1))))
        same = same | reduce(Column.__and__, [F.col(name).eqNullSafe(value) for name, value in edge])
    return same


# Degrees and leftovers --------------------------------------------------------


def degree(graph: PropertyGraph) -> DataFrame:
    """Number of edge ends per vertex that has any.

    Both ends come out of one scan and are combined in the map tasks, so a hub
    costs one partial row per task.
    """
    ends = graph.edges.select(F.explode(F.array("src", "dst")).alias("vid"))
    return ends.groupBy("vid").agg(F.count(F.lit(1)).alias("degree"))


def touched(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("vid")).distinct()


def orphans(graph: PropertyGraph, among: DataFrame | None = None) -> DataFrame:
    """Vertices without any edge, optionally only among given ones."""
    rows = graph.vertices
    if among is not None:
        rows = rows.join(among.select("vid"), "vid", "left_semi")
    return rows.join(touched(graph.edges), "vid", "left_anti")


def source_chunks(graph: PropertyGraph, entities: DataFrame) -> DataFrame:
    """Entities with the text of the chunk they were extracted from."""
    chunks = graph.vertices.where(F.col("label") == TEXT_CHUNK).select(
        F.col("id").alias("triplet_source_id"), F.col("text").alias("source_text"),
        F.col("ref_doc_id").alias("source_doc"),
    )
    return entities.join(chunks, "triplet_source_id")
