"""Approximate vector search over a stored table of buckets.

Unit vectors are projected on random directions and cut into cells.  Several cells together
form the bucket of a row in one table, and there are several tables.  The index holds record
ids and buckets only; rows that are new or changed are appended to it.  A search reads the
query's bucket of every table, fetches the rows with these ids as they are now, leaves out
those that share no bucket any more, and scores the others exactly.  So entries of rows that
went or changed do no harm; ``rebuild`` drops them.

More tables find more of the true neighbours, more cells per bucket read less.  Exact search
stays the default everywhere else.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from knotwork.functions.vectors import check_vector, has_width, unit, unit_rows
from knotwork.model import PropertyGraph
from knotwork.operators.lookup import MAX_LITERALS
from knotwork.operators.ranking import first_rows
from knotwork.operators.sizes import fits_memory, mark
from knotwork.operators.vector import DEFAULT_TOP_K, scored
from knotwork.session import cut_lineage


@dataclass(frozen=True)
class Projection:
    """Random directions and offsets that follow from the seed.  A cell is as wide as the
    spread of random unit vectors unless given."""

    dim: int
    tables: int = 8
    cells: int = 3
    cell: float | None = None
    seed: int = 7

    def parts(self) -> tuple[np.ndarray, np.ndarray, float]:
        rng = np.random.default_rng(self.seed)
        directions = rng.normal(size=(self.dim, self.tables * self.cells))
        directions /= np.linalg.norm(directions, axis=0)
        return directions, rng.uniform(size=self.tables * self.cells), self.cell or 1.0 / float(np.sqrt(self.dim))

    def numbers(self, rows: np.ndarray) -> np.ndarray:
        """Bucket of every unit row in every table.

        The cells of one bucket are mixed into one number; a clash of two buckets only
        adds rows that are then scored like all others.
        """
        directions, offsets, cell = self.parts()
        cells = np.floor(rows @ directions / cell + offsets).astype("int64").reshape(len(rows), self.tables, -1)
        mixed = np.zeros((len(rows), self.tables), dtype="int64")
        with np.errstate(over="ignore"):
            for column in range(cells.shape[2]):
                mixed = mixed * np.int64(1_000_003) + cells[:, :, column]
        return mixed

    def buckets(self, embedding: Column) -> Column:
        """Buckets of stored embeddings; the rows must satisfy ``has_width``."""

        @F.arrow_udf("array<bigint>")
        def found(batch: pa.Array) -> pa.Array:
            return pa.array(list(self.numbers(np.nan_to_num(unit_rows(batch, self.dim)))), pa.list_(pa.int64()))

        return found(embedding)

    def of_query(self, query: Sequence[float]) -> list[int]:
        values = check_vector(query)
        if len(values) != self.dim:
            raise ValueError(f"the query must have {self.dim} elements")
        return self.numbers(unit(values)[None, :])[0].tolist()


class LshIndex:
    """An index at ``path``, made by ``create``; the constructor opens it.

    ``slots`` folders hold the buckets by hash, so a search opens one folder per table at most.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        row = spark.read.parquet(f"{path}/settings").first()
        self.slots = row.slots
        self.projection = Projection(row.dim, row.tables, row.cells, row.cell, row.seed)

    @staticmethod
    def create(spark: SparkSession, path: str, projection: Projection, slots: int = 16) -> "LshIndex":
        """An empty index."""
        settings = [(*asdict(projection).values(), slots)]
        spark.createDataFrame(settings, "dim int, tables int, cells int, cell double, seed int, slots int").write.parquet(
            f"{path}/settings")
        index = LshIndex(spark, path)
        index.clear()
        return index

    @staticmethod
    def build(graph: PropertyGraph, dim: int, path: str, tables: int = 8, cells: int = 3,
              cell: float | None = None, seed: int = 7) -> "LshIndex":
        """An index of all vertices with vectors of width ``dim``."""
        index = LshIndex.create(graph.spark, path, Projection(dim, tables, cells, cell, seed))
        index.add(graph.vertices)
        return index

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64("table", "bucket"), F.lit(self.slots)).cast("int")

    def _write(self, vertices: DataFrame, mode: str) -> None:
        rows = vertices.where(has_width(F.col("embedding"), self.projection.dim)).select(
            "label", "vid", self.projection.buckets(F.col("embedding")).alias("found"))
        spread = rows.select(F.posexplode("found").alias("table", "bucket"), "label", "vid").withColumn("slot", self._slot())
        # Buckets come together, sorted so that a search skips row groups; a bucket with a
        # third of all rows (copies) is split over several tasks.
        ordered = spread.hint("rebalance", "slot").sortWithinPartitions("slot", "table", "bucket")
        ordered.write.partitionBy("slot").mode(mode).option("partitionOverwriteMode", "static").parquet(f"{self.path}/rows")

    def add(self, vertices: DataFrame) -> None:
        """Enter new and changed vertices."""
        self._write(vertices, "append")

    def rebuild(self, vertices: DataFrame) -> None:
        """Enter these vertices and nothing else."""
        self._write(vertices, "overwrite")

    def clear(self) -> None:
        self.rebuild(PropertyGraph.empty(self.spark).vertices)

    def _same_bucket(self, numbers: list[int]) -> Column:
        hit = F.lit(False)
        for table, number in enumerate(numbers):
            hit = hit | ((F.col("table") == table) & (F.col("bucket") == number))
        return hit

    def candidates(self, query: Sequence[float]) -> DataFrame:
        """(label, vid) of the entries that share a bucket with the query, each once."""
        numbers = self.projection.of_query(query)
        rows = self.spark.read.schema("table int, bucket bigint, label string, vid string, slot int").parquet(f"{self.path}/rows")
        places = self.spark.createDataFrame(list(enumerate(numbers)), "table int, bucket bigint").select(self._slot().alias("slot"))
        slots = sorted({r.slot for r in places.collect()})
        return rows.where(F.col("slot").isin(*slots) & self._same_bucket(numbers)).select("label", "vid").distinct()

    def near(self, graph: PropertyGraph, query: Sequence[float]) -> PropertyGraph:
        """The graph cut to the vertices that share a bucket with the query now.

        Few candidates are a predicate, which leaves most folders and row groups unread; many
        are a join with their ids.
        """
        found = cut_lineage(self.candidates(query))
        few = found.limit(MAX_LITERALS + 1).collect()
        if len(few) <= MAX_LITERALS:
            labels = sorted({r.label for r in few})
            rows = graph.vertices.where(F.col("label").isin(*labels) & F.col("vid").isin(*[r.vid for r in few]))
        else:
            rows = graph.vertices.join(mark(found, fits_memory(found)), ["label", "vid"], "left_semi")
        rows = rows.where(has_width(F.col("embedding"), self.projection.dim))
        asked = F.array(*[F.lit(n).cast("bigint") for n in self.projection.of_query(query)])
        shared = F.exists(F.zip_with(self.projection.buckets(F.col("embedding")), asked, lambda a, b: a == b), lambda x: x)
        return graph.with_vertices(rows.where(shared))

    def search(self, graph: PropertyGraph, query: Sequence[float], top_k: int = DEFAULT_TOP_K,
               label: str | None = None) -> DataFrame:
        """The best candidates, scored exactly; of one type, or of every entity type."""
        return first_rows(scored(self.near(graph, query), query, label), [F.desc("score"), "vid"], top_k)
