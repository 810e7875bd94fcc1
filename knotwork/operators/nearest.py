"""Nearest neighbours of a whole table of query vectors.

Query tables that were measured to fit in memory are sent to the tasks, which score their
share of the vectors and pass on the best per query.  Larger ones are dealt in tiles: each
tile of queries meets each tile of vectors in a group of its own, so a task holds two tiles
and a bounded matrix of scores, whatever the size of the tables.  Either way only the best
rows of each query and task reach the final cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from knotwork.functions.text import BASE_ENTITY, TEXT_CHUNK
from knotwork.functions.vectors import similarities, unit_rows
from knotwork.model import PropertyGraph, types_of
from knotwork.operators.ranking import top_per_group
from knotwork.operators.sizes import fits_memory
from knotwork.operators.vector import DEFAULT_TOP_K
from knotwork.session import cut_lineage

# Rows of a tile, and queries that are scored at once against one.
TILE = 8192
BLOCK = 128
FOUND = StructType([
    StructField("number", LongType()), StructField("vid", StringType()), StructField("label", StringType()),
    StructField("score", DoubleType()),
])

ARROW = pa.schema([("number", pa.int64()), ("vid", pa.string()), ("label", pa.string()), ("score", pa.float64())])


class Best:
    """The best ``k`` rows of each query so far, by score, then record id.  Queries come in
    blocks, each with rows of its own, so adding to one does not touch the others."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.blocks: dict[int, tuple] = {}

    def add(self, block: int, number, vid, label, score) -> None:
        if block in self.blocks:
            held = zip(self.blocks[block], (number, vid, label, score))
            number, vid, label, score = (np.concatenate(pair) for pair in held)
        order = np.lexsort((vid.astype(str), -score, number))
        starts = np.flatnonzero(np.append(True, np.diff(number[order]) != 0)) if len(order) else np.empty(0, int)
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
        order = order[rank < self.k]
        self.blocks[block] = number[order], vid[order], label[order], score[order]

    def batches(self) -> Iterator[pa.RecordBatch]:
        for number, vid, label, score in self.blocks.values():
            yield pa.RecordBatch.from_arrays([
                pa.array(number, pa.int64()), pa.array(vid, pa.string()), pa.array(label, pa.string()),
                pa.array(np.maximum(0.0, score), pa.float64())], FOUND.names)


class Queries:
    """Queries of one width, by the type that they ask for."""

    def __init__(self, numbers, types: list, units, parents) -> None:
        kinds = np.array(["" if t is None else t for t in types], object)
        self.groups = []
        for kind in sorted(set(kinds)):
            mine = np.flatnonzero(kinds == kind)
            inside, labels = types_of(parents, kind) if kind else (False, [TEXT_CHUNK, BASE_ENTITY])
            self.groups.append((inside, labels, numbers[mine], units[mine]))

    def meet(self, vids, labels, rows, best: Best) -> None:
        """Score rows for the queries, a tile of rows and a block of queries at a time."""
        for inside, wanted, numbers, units in self.groups:
            own = np.flatnonzero(np.isin(labels, np.array(wanted, object)) == inside)
            for at in range(0, len(own), TILE):
                mine = own[at:at + TILE]
                for start in range(0, len(numbers), BLOCK):
                    scores = similarities(rows[mine], units[start:start + BLOCK])
                    scores[np.isnan(scores)] = -np.inf
                    least = np.full(scores.shape[1], -np.inf)
                    if len(mine) > best.k:
                        least = np.partition(scores, len(mine) - best.k, axis=0)[len(mine) - best.k]
                    row, column = np.nonzero((scores >= least) & (scores > -np.inf))
                    best.add(int(numbers[start]), numbers[start + column], vids[mine[row]], labels[mine[row]], scores[row, column])


def _objects(column: pa.Array):
    return np.array(column.to_pylist(), dtype=object)


def nearest_join(graph: PropertyGraph, queries: DataFrame, top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """query_id, vid, label and score of the ``top_k`` vertices nearest to each query.

    ``queries`` has ``query_id`` (unique), ``embedding`` and, optionally, ``type``: a query
    looks among the vertices of that type and the types below it, or of every entity type where
    there is none.  Queries and vertices of different width never meet; queries without a
    usable vector (null, empty, not finite, zero) find nothing.
    """
    if "type" not in queries.columns:
        queries = queries.withColumn("type", F.lit(None).cast("string"))
    vector = F.col("embedding").cast("array<double>")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "embedding", lambda x: x != 0)
    asked = cut_lineage(queries.select("query_id", "type", vector.alias("embedding")).where(F.coalesce(usable, F.lit(False)))
                        .withColumn("number", F.monotonically_increasing_id()))
    rows = graph.vertices.where((F.size("embedding") > 0)).select("vid", "label", "embedding", F.size("embedding").alias("width"))
    partial = (_broadcast if fits_memory(asked) else _tiled)(graph, asked.select("number", "type", "embedding"), rows, top_k)
    best = top_per_group(partial, ["number"], [F.desc("score"), F.col("vid")], top_k)
    return best.join(asked.select("number", "query_id"), "number").select("query_id", "vid", "label", "score")


def _broadcast(graph: PropertyGraph, asked: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Queries of a measured size, with all vectors where they are."""
    parents = dict(graph.parents)
    by_width: dict[int, list] = {}
    for r in asked.collect():
        by_width.setdefault(len(r.embedding), []).append(r)
    # Made ready once, so that a task holds the vectors once.
    given = {
        width: Queries(np.array([r.number for r in group]), [r.type for r in group],
                       _units(np.array([r.embedding for r in group])), parents)
        for width, group in by_width.items()
    }
    shared = graph.spark.sparkContext.broadcast(given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        known = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, TILE):
                part = batch.slice(start, TILE)
                widths = part.column("width").to_numpy()
                for width in set(widths.tolist()) & set(known):
                    own = part.filter(pa.array(widths == width))
                    known[width].meet(_objects(own.column("vid")), _objects(own.column("label")),
                                      unit_rows(own.column("embedding"), width), best)
        yield from best.batches()

    wanted = rows.where(F.col("width").isin(*given))
    return wanted.mapInArrow(run, FOUND)


def _units(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _tiled(graph: PropertyGraph, asked: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Every tile of queries with every tile of vectors of its width."""
    parents = dict(graph.parents)
    asked = asked.withColumn("width", F.size("embedding"))
    # A width has as many tiles as its rows fill; rows of few widths, so this is a small table.
    tiles = F.ceil(F.count("*") / TILE).cast("int")
    sizes = cut_lineage(asked.groupBy("width").agg(tiles.alias("q_tiles")).join(
        rows.groupBy("width").agg(tiles.alias("v_tiles")), "width"))

    def dealt(side: DataFrame, key: str, own: str, other: str) -> DataFrame:
        placed = side.join(sizes, "width").withColumn(own, F.pmod(F.xxhash64(key), F.col(f"{own}_tiles")).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_tiles") - 1))).drop("q_tiles", "v_tiles")

    def meet(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        best = Best(k)
        if queries.num_rows and vectors.num_rows:
            q, v = queries.combine_chunks().to_batches()[0], vectors.combine_chunks().to_batches()[0]
            width = q.column("width")[0].as_py()
            known = Queries(q.column("number").to_numpy(), q.column("type").to_pylist(),
                            unit_rows(q.column("embedding"), width), parents)
            known.meet(_objects(v.column("vid")), _objects(v.column("label")), unit_rows(v.column("embedding"), width), best)
        return pa.Table.from_batches(list(best.batches()), ARROW)

    keys = ["width", "q", "v"]
    left, right = dealt(asked, "number", "q", "v").groupBy(*keys), dealt(rows, "vid", "v", "q").groupBy(*keys)
    return left.cogroup(right).applyInArrow(meet, FOUND)
