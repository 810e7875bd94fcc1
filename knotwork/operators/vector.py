"""Similarity search over embeddings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from knotwork.functions.text import BASE_ENTITY, TEXT_CHUNK
from knotwork.functions.vectors import check_vector, cosine, has_width, score_of, similarities, unit, unit_rows
from knotwork.model import PropertyGraph
from knotwork.operators.ranking import first_rows, top_per_group

DEFAULT_TOP_K = 10

# Query vectors sent to every task in one pass; longer lists are scored in blocks.
MAX_QUERY_BYTES = 32 * 1024 * 1024
# Scores held at once by a task.
MAX_SCORES = 1 << 22


def searchable(graph: PropertyGraph, dim: int, label: str | None = None) -> DataFrame:
    """Vertices that take part in vector search: of one type, or every concrete
    entity type (neither text chunks nor the bare base type)."""
    rows = graph.vertices.where(has_width(F.col("embedding"), dim))
    if label is not None:
        return rows.where(graph.in_type(label))
    return rows.where(~F.col("label").isin(TEXT_CHUNK, BASE_ENTITY))


def scored(graph: PropertyGraph, query: Sequence[float], label: str | None = None) -> DataFrame:
    """Score of every searchable vertex; only narrow columns leave the scan."""
    values = check_vector(query)
    rows = searchable(graph, len(values), label).select(
        "vid", "label", "name", cosine(F.col("embedding"), values).alias("similarity")
    )
    return rows.where(F.col("similarity").isNotNull()).select(
        "vid", "label", "name", score_of(F.col("similarity")).alias("score")
    )


def vector_query(graph: PropertyGraph, query: Sequence[float] | None, top_k: int | None = None,
                 label: str | None = None) -> DataFrame:
    """Best matches over all entity types.

    One global top-k equals merging the top-k of every type.  Each task keeps
    ``top_k`` rows and one task merges those.
    """
    if query is None or len(query) == 0:
        return graph.spark.createDataFrame([], "vid string, label string, name string, score double")
    hits = scored(graph, query, label)
    return first_rows(hits, [F.desc("score"), "vid"], top_k or DEFAULT_TOP_K)


def vector_query_per_type(graph: PropertyGraph, query: Sequence[float], top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """Best matches of every type, in one pass over all of them."""
    return top_per_group(scored(graph, query), ["label"], [F.desc("score"), F.col("vid")], top_k)


def batch_vector_search(graph: PropertyGraph, searches: Sequence[dict]) -> DataFrame:
    """Several searches at once; each is a dict with ``type_name``,
    ``query_embedding`` and ``top_k``.

    Every Arrow batch is multiplied with all query vectors of its width and only
    the best rows per search leave the task, so the number of (row, search) pairs
    never shows up in a shuffle.  Query lists too large to ship are cut in blocks, and a
    type stands for the types below it too.
    """
    prepared = [
        (i, s["type_name"], unit(check_vector(s["query_embedding"])), int(s.get("top_k") or DEFAULT_TOP_K))
        for i, s in enumerate(searches)
    ]
    if not prepared:
        raise ValueError("no searches given")
    found = None
    for block in _blocks(prepared):
        part = _search_block(graph, block)
        found = part if found is None else found.unionByName(part)
    assert found is not None
    return found


def _blocks(prepared: list[tuple]) -> Iterator[list[tuple]]:
    by_width: dict[int, list[tuple]] = {}
    for search in prepared:
        by_width.setdefault(len(search[2]), []).append(search)
    for width, group in sorted(by_width.items()):
        size = max(1, MAX_QUERY_BYTES // (8 * width))
        for at in range(0, len(group), size):
            yield group[at:at + size]


def _search_block(graph: PropertyGraph, block: list[tuple]) -> DataFrame:
    width = len(block[0][2])
    limits = {number: k for number, _, _, k in block}
    by_type = {}
    for name in sorted({name for _, name, _, _ in block}):
        mine = [(i, q, k) for i, n, q, k in block if n == name]
        by_type[name] = ([i for i, _, _ in mine], np.stack([q for _, q, _ in mine]), max(k for _, _, k in mine))
    flags = [graph.in_type(name).alias(f"is_{i}") for i, name in enumerate(by_type)]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0, np.int64), np.empty(0, dtype=object), np.empty(0))
        for batch in batches:
            rows = unit_rows(batch.column("embedding"), width)
            names = np.array(batch.column("vid").to_pylist(), dtype=object)
            for at, (numbers, queries, k) in enumerate(by_type.values()):
                mine = np.flatnonzero(batch.column(f"is_{at}").to_numpy(zero_copy_only=False).astype(bool))
                # At most MAX_SCORES scores at a time, whatever the batch and the queries.
                step = max(1, MAX_SCORES // max(1, len(mine)))
                for start in range(0, len(numbers) if len(mine) else 0, step):
                    scores = similarities(rows[mine], queries[start:start + step])
                    open_ = np.where(np.isnan(scores), -np.inf, scores)
                    edge = -np.inf if len(mine) <= k else np.partition(open_, len(mine) - k, axis=0)[len(mine) - k]
                    row, column = np.nonzero((open_ >= edge) & (open_ > -np.inf))
                    more = (np.array(numbers)[start + column], names[mine[row]], scores[row, column])
                    kept = _ranked([np.concatenate(x) for x in zip(kept, more)], limits)
        yield pa.RecordBatch.from_pydict({
            "search": pa.array(kept[0], pa.int64()), "vid": pa.array(kept[1], pa.string()),
            "score": pa.array(np.maximum(0.0, kept[2]), pa.float64()),
        })

    within = F.lit(False)
    for name in by_type:
        within = within | graph.in_type(name)
    rows = graph.vertices.where(within & has_width(F.col("embedding"), width)).select("vid", "embedding", *flags)
    partial = rows.mapInArrow(best, "search bigint, vid string, score double")
    order = [F.desc("score"), F.col("vid")]
    if len(set(limits.values())) == 1:
        return top_per_group(partial, ["search"], order, next(iter(limits.values())))
    # Every task holds at most top_k rows per search, so this group stays small.
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("search"))
    rank = F.row_number().over(Window.partitionBy("search").orderBy(*order))
    best_rows = top_per_group(partial, ["search"], order, max(limits.values()))
    return best_rows.withColumn("_rank", rank).where(F.col("_rank") <= wanted).drop("_rank")


def _ranked(found: list[np.ndarray], limits: dict[int, int]) -> tuple[np.ndarray, ...]:
    """The best rows of every search by score, then record id."""
    search, vid, score = found
    order = np.lexsort((vid.astype(str), -score, search))
    search, vid, score = search[order], vid[order], score[order]
    starts = np.flatnonzero(np.append(True, search[1:] != search[:-1])) if len(search) else np.empty(0, int)
    rank = np.arange(len(search)) - np.repeat(starts, np.diff(starts, append=len(search)))
    keep = rank < np.array([limits[s] for s in search.tolist()], dtype=int)
    return search[keep], vid[keep], score[keep]


def vector_similarity(graph: PropertyGraph, vid: str, query: Sequence[float]) -> DataFrame:
    """Similarity of one stored record to a query."""
    values = check_vector(query)
    # The record id holds the label, which prunes the scan.
    mine = (F.col("label") == vid.split("/", 1)[0]) & (F.col("vid") == vid)
    row = graph.vertices.where(mine & has_width(F.col("embedding"), len(values)))
    return row.select("vid", cosine(F.col("embedding"), values).alias("similarity"))


def hit_types(hits: DataFrame) -> DataFrame:
    """Histogram of the types in a search result."""
    return hits.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
