"""Upserts of vertices and edges as set-based merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from knotwork.functions.props import (
    DECLARED, PROPS_TYPE, drop_large, fold_values, no_props, overlay, without,
)
from knotwork.functions.text import (
    MENTIONS, TEXT_CHUNK, entity_label, fold_punctuation, is_blank, normalize_name, relation_name,
    strip, without_metadata,
)
from knotwork.model import (
    EDGE_SCHEMA, VERTEX_SCHEMA, PropertyGraph, shape_edges, shape_vertices, vertex_id,
)
from knotwork.operators.lookup import type_rank
from knotwork.operators.sizes import KEY_HASH, hashed, mark, not_stored

# Nodes to write.  ``kind`` is entity, chunk or generic; ``seq`` orders the batch
# and must be unique in it.
NODE_BATCH = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("props", PROPS_TYPE),
    T.StructField("seq", T.LongType()),
])
RELATION_BATCH = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("target_id", T.StringType()),
    T.StructField("props", PROPS_TYPE),
    T.StructField("seq", T.LongType()),
])

# Property names that never enter the map: they have their own column.
RESERVED = (*DECLARED, "embedding")
SCALARS = [f.name for f in VERTEX_SCHEMA.fields if f.name not in ("label", "key", "vid", "props")]


def batch_of(df: DataFrame, schema: T.StructType, **columns: Column) -> DataFrame:
    """Project any table onto a batch schema; columns not given are NULL."""
    given = {"props": no_props(), **columns}
    return df.select(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


# Vertices ---------------------------------------------------------------------


def prepare_nodes(batch: DataFrame, max_property_length: int | None = None) -> DataFrame:
    """Batch rows in vertex shape plus ``seq``: types and names decided, reserved
    properties moved to their columns, punctuation folded, blank keys dropped."""
    kind = F.col("kind")
    entity, chunk = kind == "entity", kind == "chunk"

    def given(key: str) -> Column:
        return F.nullif(F.try_element_at("props", F.lit(key)), F.lit(""))

    own_id = F.when(chunk, F.coalesce("id", F.sha2("text", 256))).when(kind == "generic", F.col("id"))
    own_name = F.when(entity, normalize_name(F.col("name")))
    # Tested on the given columns, so the rules below are evaluated once per row.
    nameless = entity & is_blank(without_metadata(F.col("name")))
    unusable = is_blank(F.col("label")) | F.col("label").contains("/")
    unkeyed = (kind == "generic") & (is_blank(F.col("id")) | unusable)
    typed = batch.where(~nameless & ~unkeyed & ~(chunk & is_blank(own_id))).select(
        "seq", "kind",
        F.when(entity, entity_label(F.col("label"), F.coalesce("name", F.lit(""))))
        .when(chunk, F.lit(TEXT_CHUNK)).otherwise(strip(F.col("label"))).alias("label"),
        fold_punctuation(F.coalesce(own_name, given("name"))).alias("name"),
        fold_punctuation(F.coalesce(own_id, given("id"))).alias("id"),
        fold_punctuation(F.when(chunk, F.col("text")).otherwise(given("text"))).alias("text"),
        *[fold_punctuation(given(c)).alias(c) for c in ("ref_doc_id", "doc_id", "triplet_source_id")],
        F.when(F.size("embedding") > 0, F.col("embedding")).alias("embedding"),
        fold_values(without(F.coalesce("props", no_props()), RESERVED)).alias("props"),
        F.when(entity, fold_punctuation(own_name)).otherwise(fold_punctuation(own_id)).alias("key"),
    )
    if max_property_length is not None:
        typed = typed.withColumn("props", drop_large(F.col("props"), max_property_length))
    columns = [f.name for f in VERTEX_SCHEMA.fields if f.name != "vid"]
    return typed.select("seq", "kind", vertex_id(F.col("label"), F.col("key")).alias("vid"), *columns)


def _last(column: str) -> Column:
    """The latest value that is present, in partial aggregation."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.col("seq"))).alias(column)


def collapse_nodes(prepared: DataFrame, property_names: Sequence[str] | None = None) -> DataFrame:
    """One row per vertex; for every property the latest value given wins.

    With ``property_names`` (the schema is known) everything is one aggregation
    whose partial results are combined before the shuffle, so a key that holds a
    third of the batch costs one row per task.  Otherwise property maps are
    aggregated per entry and put together again.
    """
    scalars = [_last(c) for c in SCALARS]
    # The record id holds label and key, so it is the only grouping column.
    label = F.substring_index("vid", "/", 1)
    identity = [label.alias("label"), F.substr("vid", F.length(label) + 2).alias("key"), F.col("vid")]
    if property_names is not None:
        wide = prepared.select(
            "vid", *SCALARS, "seq",
            *[F.try_element_at("props", F.lit(p)).alias(f"p_{p}") for p in property_names],
        )
        merged = wide.groupBy("vid").agg(*scalars, *[_last(f"p_{p}") for p in property_names])
        pairs = [x for p in property_names for x in (F.lit(p), F.col(f"p_{p}"))]
        props = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else no_props()
        return merged.select(*identity, *SCALARS, props.alias("props"))
    merged = prepared.groupBy("vid").agg(*scalars)
    entries = (
        prepared.select("vid", "seq", F.explode("props").alias("prop", "value"))
        .groupBy("vid", "prop").agg(F.max_by("value", "seq").alias("value"))
        .groupBy("vid").agg(F.map_from_entries(F.collect_list(F.struct("prop", "value"))).alias("props"))
    )
    return merged.join(entries, "vid", "left").select(
        *identity, *SCALARS, F.coalesce("props", no_props()).alias("props")
    )


def merge_vertices(stored: DataFrame, incoming: DataFrame, fits: bool = False) -> DataFrame:
    """Stored vertices with the collapsed batch laid over them.

    Both sides hold a vertex once, so the full outer join has no hot key.  When the
    batch was measured to fit in memory it is broadcast and the stored rows are
    merged where they are, without a shuffle.
    """
    columns = []
    for f in VERTEX_SCHEMA.fields:
        before, after = F.col(f"old.{f.name}"), F.col(f"new.{f.name}")
        value = overlay(before, after) if f.name == "props" else F.coalesce(after, before)
        columns.append(value.alias(f.name))
    same = F.col("old.vid") == F.col("new.vid")
    if not fits:
        return stored.alias("old").join(incoming.alias("new"), same, "full_outer").select(*columns)
    updated = stored.alias("old").join(F.broadcast(incoming).alias("new"), same, "left").select(*columns)
    inserted = not_stored(incoming, stored, ["vid"], fits)
    return updated.unionByName(inserted.select(*VERTEX_SCHEMA.fieldNames()))


def mentions(entities: DataFrame, chunk_ids: DataFrame) -> DataFrame:
    """Provenance edges from a chunk to every entity that names it as its source.

    ``entities`` has ``vid`` and ``triplet_source_id``, ``chunk_ids`` has ``id``.
    A chunk that is not stored gives no edge.  Record ids are deterministic, so a
    semi join on the id alone is enough; pairs are made distinct before it.
    """
    pairs = entities.where(F.col("triplet_source_id").isNotNull()).select(
        F.col("triplet_source_id").alias("id"), F.col("vid").alias("dst")
    ).distinct()
    found = pairs.join(chunk_ids.select("id"), "id", "left_semi")
    return shape_edges(found, MENTIONS, vertex_id(F.lit(TEXT_CHUNK), F.col("id")), F.col("dst"))


def chunk_ids(vertices: DataFrame) -> DataFrame:
    return vertices.where(F.col("label") == TEXT_CHUNK).select("id")


def upsert_nodes(graph: PropertyGraph, batch: DataFrame,
                 property_names: Sequence[str] | None = None,
                 max_property_length: int | None = None) -> PropertyGraph:
    """Merge a node batch and derive its provenance edges.

    Chunks and entities of one batch see each other.
    """
    prepared = prepare_nodes(batch, max_property_length)
    vertices = merge_vertices(graph.vertices, collapse_nodes(prepared, property_names))
    chunks = chunk_ids(graph.vertices).union(chunk_ids(prepared))
    fresh = mentions(prepared.where(F.col("kind") == "entity"), chunks)
    return graph.with_vertices(vertices).with_edges(add_edges(graph.edges, fresh))


# Edges ------------------------------------------------------------------------


def add_edges(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored edges win: only (label, src, dst) combinations not yet there are added."""
    added = not_stored(fresh, stored, ["label", "src", "dst"])
    columns = [f.name for f in EDGE_SCHEMA.fields]
    return stored.select(*columns).unionByName(added.select(*columns))


def first_edges(edges: DataFrame, keyed: bool = False) -> DataFrame:
    """One edge per (label, src, dst); the earliest of the batch gives the properties.
    ``keyed`` keeps the hash of the key, so that a join by key needs no other shuffle."""
    key = ["label", "src", "dst"]
    first = hashed(edges, *key).groupBy(KEY_HASH, *key).agg(F.min_by("props", "seq").alias("props"))
    return first if keyed else first.drop(KEY_HASH)


def usable_relations(batch: DataFrame) -> DataFrame:
    """Relations with a label; blank ones cannot become an edge type."""
    return batch.where(~is_blank(F.col("label")))


def separate_labels(graph: PropertyGraph, relations: DataFrame,
                    labels: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Vertex and edge types share one namespace: a relation label that is already
    a vertex label gets the suffix ``_REL``.

    ``labels`` are the vertex labels if the caller has them at hand.
    """
    if labels is None:
        declared = graph.spark.createDataFrame([(x,) for x in graph.declared()], "label string")
        labels = graph.vertices.select("label").union(declared).distinct()
    if isinstance(labels, DataFrame):
        marked = relations.join(labels.select("label", F.lit(True).alias("_taken")), "label", "left")
        taken = F.coalesce("_taken", F.lit(False))
    else:
        marked, taken = relations, F.col("label").isin(*labels)
    renamed = F.when(taken, F.concat("label", F.lit("_REL"))).otherwise(F.col("label"))
    return marked.withColumn("label", renamed).select(*relations.columns)


def endpoints(graph: PropertyGraph, refs: DataFrame, fits: bool = False) -> DataFrame:
    """``ref`` to ``vid``: a text chunk by its raw id, any other vertex by its
    normalised name; the first type in search order wins.

    ``fits`` says that the references were measured and may be broadcast: vertices are
    then cut to the wanted names where they are, before types are compared.
    """
    wanted = refs.select("ref").where(F.col("ref").isNotNull()).distinct().select(
        "ref", fold_punctuation(F.col("ref")).alias("raw"),
        fold_punctuation(normalize_name(F.col("ref"))).alias("name"),
    )
    chunk = F.col("label") == TEXT_CHUNK
    by_id = graph.vertices.where(chunk).select(F.col("id").alias("raw"), F.col("vid").alias("chunk"))
    by_name = graph.vertices.where(~chunk & F.col("name").isNotNull()).select("name", "label", "vid")
    if fits:
        by_id = by_id.join(F.broadcast(wanted.select("raw")), "raw", "left_semi")
        by_name = by_name.join(F.broadcast(wanted.select("name")), "name", "left_semi")
    best = (
        hashed(by_name, "name").groupBy(KEY_HASH, "name").agg(F.min(type_rank("vid")).alias("best"))
        .select(KEY_HASH, "name", F.col("best.vid").alias("entity"))
    )
    # Many references are moved by id only if there are chunks at all.
    if fits or not by_id.isEmpty():
        wanted = wanted.join(by_id, "raw", "left")
    else:
        wanted = wanted.withColumn("chunk", F.lit(None).cast("string"))
    found = hashed(wanted, "name").join(best, [KEY_HASH, "name"], "left")
    vid = F.coalesce("chunk", "entity")
    return found.select("ref", vid.alias("vid")).where(F.col("vid").isNotNull())


def references(relations: DataFrame) -> DataFrame:
    """Every endpoint named by some relations, once."""
    return relations.select(F.explode(F.array("source_id", "target_id")).alias("ref")).distinct()


def resolve_relations(graph: PropertyGraph, relations: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Relations with ``src`` and ``dst``; those with a missing endpoint are skipped.

    References are resolved once each (distinct before any join), whatever number
    of relations shares them.
    """
    if known is None:
        known = endpoints(graph, references(relations))
    for end, vid in (("source_id", "src"), ("target_id", "dst")):
        found = hashed(known.select(F.col("ref").alias(end), F.col("vid").alias(vid)), end)
        relations = hashed(relations, end).join(found, [KEY_HASH, end]).drop(KEY_HASH)
    return relations


def fold_relations(relations: DataFrame) -> DataFrame:
    """Relation properties as they are stored: folded, without empty ones."""
    kept = F.map_filter(F.coalesce("props", no_props()), lambda _, v: v.isNotNull())
    return relations.withColumn("props", fold_values(kept))


def upsert_relations(graph: PropertyGraph, batch: DataFrame,
                     labels: DataFrame | Sequence[str] | None = None) -> PropertyGraph:
    """Add relations whose endpoints exist; a stored edge keeps its properties."""
    usable = separate_labels(graph, usable_relations(batch), labels)
    resolved = fold_relations(resolve_relations(graph, usable))
    return graph.with_edges(add_edges(graph.edges, first_edges(resolved)))


def connect_matches(graph: PropertyGraph, requests: DataFrame, column: str = "name") -> PropertyGraph:
    """Edges between everything two selections find: for each request (``label``,
    ``source``, ``target``) every vertex whose ``column`` equals the source is
    linked to every vertex whose ``column`` equals the target."""
    found = graph.vertices.where(F.col(column).isNotNull()).select(F.col(column).alias("ref"), "vid")
    pairs = (
        requests.select("label", "source", "target").distinct()
        .join(found.select(F.col("ref").alias("source"), F.col("vid").alias("src")), "source")
        .join(found.select(F.col("ref").alias("target"), F.col("vid").alias("dst")), "target")
        .select("label", "src", "dst").distinct()
    )
    return graph.with_edges(add_edges(graph.edges, shape_edges(pairs, F.col("label"), F.col("src"), F.col("dst"))))


def link(graph: PropertyGraph, pairs: DataFrame) -> PropertyGraph:
    """Edges between vertices given by record id (``label``, ``src``, ``dst``);
    a pair with an unknown end is left out."""
    known = graph.vertices.select("vid")
    checked = (
        pairs.join(known, pairs["src"] == known["vid"], "left_semi")
        .join(known, F.col("dst") == known["vid"], "left_semi")
        .select("label", "src", "dst").distinct()
    )
    return graph.with_edges(add_edges(graph.edges, shape_edges(checked, F.col("label"), F.col("src"), F.col("dst"))))


# Plain record writes ----------------------------------------------------------


def plain_records(label: str, rows: DataFrame, key: Column, props: Column, extra: list[Column] | None = None,
                  **columns: Column) -> DataFrame:
    """Rows of one type in vertex shape: text folded, empty properties and rows without
    a key left out."""
    if not label.strip() or "/" in label:
        raise ValueError(f"{label!r} cannot be a type")
    shaped = shape_vertices(rows, label, key, extra=extra, props=props, **columns)
    texts = [f.name for f in VERTEX_SCHEMA.fields if isinstance(f.dataType, T.StringType) and f.name not in ("label", "vid")]
    folded = {c: fold_punctuation(F.col(c)) for c in texts}
    kept = F.map_filter(F.coalesce("props", no_props()), lambda _, v: v.isNotNull())
    embedding = F.when(F.size("embedding") > 0, F.col("embedding"))
    shaped = shaped.where(~is_blank(F.col("key"))).withColumns({**folded, "props": fold_values(kept), "embedding": embedding})
    return shaped.withColumn("vid", vertex_id(F.col("label"), F.col("key")))


def bulk_insert(graph: PropertyGraph, label: str, rows: DataFrame, key: Column,
                props: Column, **columns: Column) -> PropertyGraph:
    """Append rows of one type (column ``key`` must be new)."""
    added = plain_records(label, rows, key, props, **columns)
    return graph.with_vertices(graph.vertices.unionByName(added))


def bulk_upsert(graph: PropertyGraph, label: str, rows: DataFrame, key: Column, seq: Column,
                props: Column, property_names: Sequence[str] | None = None,
                **columns: Column) -> PropertyGraph:
    """Insert or update rows of one type by a key column."""
    ordered = plain_records(label, rows, key, props, [seq.alias("seq")], **columns)
    return graph.with_vertices(merge_vertices(graph.vertices, collapse_nodes(ordered, property_names)))


def update_where(graph: PropertyGraph, label: str, where: Column, props: dict[str, Column]) -> PropertyGraph:
    """Set properties on the rows of a type that satisfy a predicate.

    Declared properties go to their columns, the others to the map; NULL clears one.
    """
    if not props:
        return graph
    if "embedding" in props:
        raise ValueError("embeddings are written with nodes")
    hit = F.coalesce((F.col("label") == label) & where, F.lit(False))
    own = {k: v.cast("string") for k, v in props.items() if k not in DECLARED}
    flagged = graph.vertices.withColumn("_hit", hit)
    changed = {}
    for name, value in props.items():
        if name in DECLARED:
            changed[name] = F.when(F.col("_hit"), value.cast("string")).otherwise(F.col(name))
    if own:
        new = F.map_filter(F.create_map(*[x for k, v in own.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
        rest = F.map_filter(F.coalesce("props", no_props()), lambda k, _: ~k.isin(*own))
        changed["props"] = F.when(F.col("_hit"), overlay(rest, new)).otherwise(F.col("props"))
    return graph.with_vertices(flagged.withColumns(changed).drop("_hit"))


# Triples ----------------------------------------------------------------------


def triples_graph(triples: DataFrame, node_label: str) -> PropertyGraph:
    """Vertices and edges of (subject, relation, object) rows; a row with a blank part
    gives neither."""
    triples = triples.where(
        ~is_blank(F.col("subject")) & ~is_blank(F.col("relation")) & ~is_blank(F.col("object")))
    ends = triples.select(F.explode(F.array("subject", "object")).alias("id")).distinct()
    vertices = shape_vertices(ends, node_label, F.col("id"), id=F.col("id"))
    label = F.lit(node_label)
    edges = triples.select(
        relation_name(F.col("relation")).alias("label"),
        vertex_id(label, F.col("subject")).alias("src"),
        vertex_id(label, F.col("object")).alias("dst"),
    ).distinct()
    return PropertyGraph(vertices, shape_edges(edges, F.col("label"), F.col("src"), F.col("dst")))


def upsert_triples(graph: PropertyGraph, triples: DataFrame, node_label: str) -> PropertyGraph:
    """Make sure both ends and the edge of every triple exist."""
    fresh = triples_graph(triples, node_label)
    added = fresh.vertices.join(graph.vertices.select("vid"), "vid", "left_anti")
    return (
        graph.with_vertices(graph.vertices.unionByName(added))
        .with_edges(add_edges(graph.edges, fresh.edges))
    )


# Checks -----------------------------------------------------------------------


def allowed_triples(relations: DataFrame, subjects: DataFrame,
                    allowed: dict[str, Sequence[str]]) -> DataFrame:
    """Keep a relation only if its subject's type may have it.

    ``relations`` carries ``src`` and ``label``; ``subjects`` maps ``vid`` to
    ``subject_type``.  The rule table is a literal predicate, not a join.
    """
    rule = F.lit(False)
    for subject_type, names in allowed.items():
        if names:
            rule = rule | ((F.col("subject_type") == subject_type) & F.col("label").isin(*names))
    typed = relations.join(subjects.select(F.col("vid").alias("src"), "subject_type"), "src")
    return typed.where(rule)


def valid_vectors(vertices: DataFrame, dim: int | None = None) -> DataFrame:
    """Rows with a non-empty embedding, of the configured width if one is given."""
    size = F.size("embedding")
    return vertices.where(F.coalesce(size > 0 if dim is None else size == dim, F.lit(False)))
