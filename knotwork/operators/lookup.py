"""Point and list lookups of nodes and chunks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from knotwork.functions.props import all_equal, prop
from knotwork.functions.text import TEXT_CHUNK, fold_literal, fold_punctuation, normalize_name
from knotwork.model import PropertyGraph
from knotwork.session import cut_lineage

# Longer id lists become a table and a join instead of a literal IN list.
MAX_LITERALS = 1_000


def type_rank(*more: str) -> Column:
    """Text chunks are searched first, the other types in label order."""
    return F.struct((F.col("label") != TEXT_CHUNK).alias("later"), "label", *more)


def settle(limited: DataFrame, bound: int | None) -> DataFrame:
    """A result that is used several times, computed once.

    Up to ``MAX_LITERALS`` rows (guaranteed by a LIMIT or a caller's list) become a
    local table; anything else is checkpointed.
    """
    if bound is not None and bound <= MAX_LITERALS:
        return limited.sparkSession.createDataFrame(limited.collect(), limited.schema)
    return cut_lineage(limited)


def literal_ids(settled: DataFrame, bound: int | None, *columns: str) -> list[str] | None:
    """Distinct ids of a settled result as literals, or None when it is too long."""
    if bound is None or bound * len(columns) > MAX_LITERALS:
        return None
    return sorted({value for row in settled.select(*columns).collect() for value in row if value is not None})


def vertices_of(graph: PropertyGraph, settled: DataFrame, bound: int | None, *columns: str) -> DataFrame:
    """Vertices whose record id stands in one of the columns of a settled result.

    A short list is a predicate on label and record id, which prunes partitions and
    Parquet row groups; a long one is a join.
    """
    ids = literal_ids(settled, bound, *columns)
    if ids is not None:
        labels = sorted({i.split("/", 1)[0] for i in ids})
        return graph.vertices.where(F.col("label").isin(*labels) & F.col("vid").isin(*ids))
    wanted = settled.select(F.explode(F.array(*columns)).alias("vid")).distinct()
    return graph.vertices.join(wanted, "vid", "left_semi")


def nodes_by_properties(graph: PropertyGraph, properties: Mapping[str, object]) -> DataFrame:
    """Vertices of any type that satisfy every property equality."""
    return graph.vertices.where(all_equal(properties))


def ids_table(graph: PropertyGraph, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Requested ids as a table with the single column ``ref``."""
    if isinstance(ids, DataFrame):
        return ids.select(fold_punctuation(F.col(ids.columns[0])).alias("ref"))
    return graph.spark.createDataFrame([(fold_literal(i),) for i in ids], "ref string")


def _logical_ids() -> Column:
    """The ids a vertex answers to: a chunk to its id, others to name or id."""
    return F.when(F.col("label") == TEXT_CHUNK, F.array("id")).otherwise(
        F.array_distinct(F.array("id", "name"))
    )


def _matches_any(ids: Sequence[str]) -> Column:
    named = (F.col("label") != TEXT_CHUNK) & F.col("name").isin(*ids)
    return F.col("id").isin(*ids) | named


def nodes_by_ids(graph: PropertyGraph, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Nodes by logical id; each id stops at the first type that knows it.

    Ids are taken as given, without name normalisation.  A short list is a plain
    predicate that reaches the Parquet scan; a long list or a table is a join.  The
    vertices are read twice: narrow to find the answers, whole for those chosen.
    """
    vertices = graph.vertices
    if not isinstance(ids, DataFrame):
        ids = [fold_literal(i) for i in ids]
        if len(ids) <= MAX_LITERALS:
            vertices = vertices.where(_matches_any(ids))
    refs = ids_table(graph, ids).where(F.col("ref").isNotNull()).distinct()
    answers = vertices.select("vid", "label", F.explode(_logical_ids()).alias("ref")).join(refs, "ref", "left_semi")
    # A reference has few answers, so ranking them by type needs no join.
    first = F.rank().over(Window.partitionBy("ref").orderBy(type_rank()))
    hits = answers.withColumn("_rank", first).where(F.col("_rank") == 1).select("vid").distinct()
    return vertices.join(hits, "vid", "left_semi")


def nodes_in_list(graph: PropertyGraph, column: str, values: Sequence[str] | DataFrame) -> DataFrame:
    """Membership in a list of keys: a predicate when short, a semi join when long."""
    if not isinstance(values, DataFrame) and len(values) <= MAX_LITERALS:
        return graph.vertices.where(prop(column).isin(*[fold_literal(v) for v in values]))
    refs = ids_table(graph, values)
    return graph.vertices.join(refs, prop(column) == F.col("ref"), "left_semi")


def start_vertices(graph: PropertyGraph, refs: DataFrame) -> DataFrame:
    """``ref`` to ``vid`` of the node a caller means: a chunk by id, any other
    node by its raw or normalised name; the first type wins."""
    raw = fold_punctuation(F.col("ref"))
    wanted = refs.select("ref").where(F.col("ref").isNotNull()).distinct().select(
        "ref", raw.alias("raw"),
        F.explode(F.array_distinct(F.array(
            raw, fold_punctuation(normalize_name(F.col("ref")))
        ))).alias("form"),
    )
    chunk = F.col("label") == TEXT_CHUNK
    known = graph.vertices.select("vid", "label", F.when(chunk, F.col("id")).otherwise(
        F.col("name")).alias("form"))
    hits = wanted.join(known, "form").where(~chunk | (F.col("form") == F.col("raw")))
    best = F.min(type_rank("vid")).alias("best")
    return hits.groupBy("ref").agg(best).select("ref", "best.vid")


def chunk_sources(graph: PropertyGraph, requested: DataFrame) -> DataFrame:
    """Text and file fields of requested chunks (columns ``pos`` and ``ref``).

    Request order and repetitions are kept, blank and unknown ids are skipped.
    """
    def filled(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    chunks = graph.vertices.where(F.col("label") == TEXT_CHUNK).select(
        F.col("id").alias("ref"),
        filled(F.col("text")).alias("text"),
        filled(F.col("ref_doc_id")).alias("ref_doc_id"),
        filled(F.coalesce(F.nullif(prop("source"), F.lit("")), prop("file_name"))).alias("source"),
        *[filled(prop(c)).alias(c) for c in ("file_name", "file_type", "file_path")],
    )
    asked = requested.select("pos", fold_punctuation(F.col("ref")).alias("ref"))
    return asked.where(F.coalesce(F.col("ref") != "", F.lit(False))).join(chunks, "ref").select(
        "pos", F.col("ref").alias("id"), "text", "ref_doc_id", "source",
        "file_name", "file_type", "file_path",
    )


def request_list(graph: PropertyGraph, ids: Sequence[str]) -> DataFrame:
    """A caller's id list with its positions."""
    return graph.spark.createDataFrame(
        [(i, None if r is None else str(r)) for i, r in enumerate(ids)], "pos bigint, ref string"
    )
