"""A graph kept as plain Parquet tables, partitioned by label and hash bucket.

``vertices`` and ``edges`` hold the rows, ``catalogue`` the properties seen per type,
``settings`` the number of buckets and the type hierarchy, and ``index``, if there is one, the
buckets of an approximate vector search, which every write of vertices keeps up to date.  A change rewrites the
(label, bucket) partitions it touches by dynamic partition overwrite; new edges are appended.
Spark replaces the partitions when the job commits, so a job may read what it replaces and
one that fails leaves the old rows.  A partition that loses its last row keeps one marker row;
the column ``live`` tells rows from markers, and packs to next to nothing.

One writer at a time.  A change of vertices and edges is two commits; every call settles what
it will write before the first of them, and repeating a call that broke off gives what one
call would have given.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from knotwork.functions.props import DECLARED
from knotwork.model import EDGE_SCHEMA, VERTEX_SCHEMA, PropertyGraph
from knotwork.operators.delete import Removal
from knotwork.operators.lsh import LshIndex, Projection
from knotwork.operators.scans import property_names
from knotwork.operators.sizes import fits_memory, mark
from knotwork.session import cut_lineage

KINDS = {"vertices": VERTEX_SCHEMA, "edges": EDGE_SCHEMA}
ONE = {"vertices": "vertex", "edges": "edge"}
# The column whose hash gives the bucket of a row; rows of a file are sorted by it.
BUCKET_KEY = {"vertices": "vid", "edges": "src"}
ROW_KEY = {"vertices": ["label", "vid"], "edges": ["label", "src", "dst"]}
# Columns that lookups name: a Bloom filter each lets a scan skip row groups.
LOOKUPS = {"vertices": ("vid", "id", "name"), "edges": ("src", "dst")}
FILES = {"parquet.block.size": str(8 * 1024 * 1024), "parquet.bloom.filter.adaptive.enabled": "true"}
PART = ["label", "bucket"]
CATALOGUE = "kind string, label string, property string"
SETTINGS = "kind string, name string, value string"


class GraphStore:
    """``buckets`` splits every label by the hash of its ids.  It is fixed when the
    store is created; choose it so that one bucket of the largest label is small
    enough to be rewritten for an update."""

    def __init__(self, spark: SparkSession, path: str, create: bool = True,
                 parents: Mapping[str, str | None] | None = None, buckets: int = 1) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.parents: dict[str, str | None] = {}
        self.buckets = buckets
        self.index: LshIndex | None = None
        if not self._open():
            if not create:
                raise FileNotFoundError(f"no graph is stored at {path}")
            self._declare([("buckets", "", str(buckets)), *(("parent", c, p) for c, p in (parents or {}).items())])
            self._open()

    # Settings -----------------------------------------------------------------

    def _table(self, name: str, schema: str | T.StructType) -> DataFrame | None:
        """A stored table as its files are now; None before its first row is written."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _open(self) -> bool:
        """Read the settings: one row per declared type, which callers give by hand."""
        settings = self._table("settings", SETTINGS)
        if settings is None:
            return False
        rows = settings.collect()
        self.parents = {r.name: r.value for r in rows if r.kind == "parent"}
        self.buckets = next(int(r.value) for r in rows if r.kind == "buckets")
        if self.index is None and any(r.kind == "index" for r in rows):
            self.index = LshIndex(self.spark, f"{self.path}/index")
        return True

    def _declare(self, rows: list[tuple[str, str, str | None]]) -> None:
        self.spark.createDataFrame(rows, SETTINGS).coalesce(1).write.mode("append").parquet(
            f"{self.path}/settings")

    def declare(self, parents: Mapping[str, str | None]) -> None:
        """Add types to the hierarchy."""
        self._declare([("parent", child, parent) for child, parent in parents.items()])
        self._open()

    def create_index(self, projection: Projection, slots: int = 16) -> None:
        """An approximate index of what is stored, kept from now on."""
        if self.index is not None:
            raise ValueError("the graph has an index already")
        made = LshIndex.create(self.spark, f"{self.path}/index", projection, slots)
        made.add(self._read("vertices"))
        self._declare([("index", "", None)])
        self.index = made

    def refresh(self) -> None:
        """Types and the index that others declared; rows are always read as they are now."""
        self._open()

    # Reading ------------------------------------------------------------------

    def _stored(self, kind: str) -> DataFrame:
        """All rows with their bucket, as the files are now."""
        fields = [*KINDS[kind].fields, T.StructField("live", T.BooleanType()), T.StructField("bucket", T.IntegerType())]
        schema = T.StructType(fields)
        rows = self._table(kind, schema)
        return (self.spark.createDataFrame([], schema) if rows is None else rows).where("live").drop("live")

    def _read(self, kind: str, labels: Iterable[str] | DataFrame | None = None) -> DataFrame:
        rows = self._stored(kind)
        if isinstance(labels, DataFrame):
            rows = rows.join(mark(_prunes(labels), fits_memory(labels)), "label", "left_semi")
        elif labels is not None:
            rows = rows.where(F.col("label").isin(*labels))
        return rows.select(*KINDS[kind].fieldNames())

    def bucket(self, kind: str) -> Column:
        return F.pmod(F.xxhash64(BUCKET_KEY[kind]), F.lit(self.buckets)).cast("int")

    def graph(self, vertex_labels: Iterable[str] | DataFrame | None = None,
              edge_labels: Iterable[str] | DataFrame | None = None) -> PropertyGraph:
        """The stored graph, or the part under the given labels (a list, or a settled table)."""
        return PropertyGraph(self._read("vertices", vertex_labels), self._read("edges", edge_labels), self.parents)

    def catalogue(self) -> DataFrame:
        """(kind, label, property) of all that was ever written since the store was emptied;
        one row without a property stands for the type itself."""
        rows = self._table("catalogue", CATALOGUE)
        return self.spark.createDataFrame([], CATALOGUE) if rows is None else rows.distinct()

    def labels(self, kind: str) -> DataFrame:
        """The types of a kind, as (label)."""
        return self.catalogue().where((F.col("kind") == ONE[kind]) & F.col("property").isNull()).select("label")

    def parts_of(self, kind: str, rows: DataFrame) -> DataFrame:
        """(label, bucket) parts of some rows, settled."""
        return cut_lineage(rows.select("label", self.bucket(kind).alias("bucket")).distinct())

    def part(self, kind: str, parts: DataFrame) -> DataFrame:
        """Rows of some settled (label, bucket) parts.  Small tables of parts are broadcast, and
        with them Spark leaves the folders of all other parts alone."""
        wanted = mark(_prunes(parts), fits_memory(parts))
        return self._stored(kind).join(wanted, PART, "left_semi").select(*KINDS[kind].fieldNames())

    # Writing ------------------------------------------------------------------

    def _write(self, kind: str, rows: DataFrame, parts: DataFrame | None = None, in_place: bool = False):
        """A writer of rows; ``parts`` get a marker row each.  Rows that come as they are stored
        may stay in their tasks (``in_place``): their order is left to restore, which is little."""
        placed = rows.select(*KINDS[kind].fieldNames(), F.lit(True).alias("live"), self.bucket(kind).alias("bucket"))
        if parts is not None:
            placed = placed.unionByName(parts.withColumn("live", F.lit(False)), allowMissingColumns=True)
        # Rebalancing keeps the rows of a part together and splits a part that holds most of
        # the rows over several tasks.
        spread = placed if in_place else placed.hint("rebalance", *PART)
        ordered = spread.sortWithinPartitions(*PART, BUCKET_KEY[kind])
        writer = ordered.write.format("parquet").partitionBy(*PART).options(**FILES)
        for column in LOOKUPS[kind]:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        return writer

    def append(self, kind: str, rows: DataFrame) -> None:
        """Add settled rows to what is stored."""
        self.enter(kind, rows)
        self._write(kind, rows).mode("append").save(f"{self.path}/{kind}")
        self.note(kind, rows)

    def enter(self, kind: str, rows: DataFrame) -> None:
        """Enter settled rows into the index.  Entries come before rows, because an entry
        without its row does no harm."""
        if kind == "vertices" and self.index is not None:
            vectors = rows.where(F.size("embedding") > 0)
            if not vectors.isEmpty():
                self.index.add(vectors)

    def replace(self, kind: str, rows: DataFrame, emptied: DataFrame | None = None, in_place: bool = False) -> None:
        """Let the parts that ``rows`` lie in hold these rows, which may come from there, and
        nothing else; ``emptied`` are settled parts that may have none left."""
        writer = self._write(kind, rows, emptied, in_place).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").save(f"{self.path}/{kind}")

    def note(self, kind: str, rows: DataFrame) -> None:
        """Add the types and properties of settled rows to the catalogue."""
        names = property_names(rows, [*DECLARED, "embedding"])
        # Most rows of a type have the same names: sets of names are made distinct before they are opened.
        sets = rows.select("label", names.alias("names")).distinct()
        seen = sets.select(F.lit(ONE[kind]).alias("kind"), "label", F.explode("names").alias("property")).distinct()
        key = ["kind", "label", "property"]
        known = self.catalogue().select(*[F.col(c).alias(f"_{c}") for c in key])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
        added = cut_lineage(seen.join(known, same, "left_anti"))
        if not added.isEmpty():
            added.write.mode("append").parquet(f"{self.path}/catalogue")

    def remove(self, removal: Removal) -> None:
        """Write a deletion: only parts that lose rows are rewritten.  Edges go first, so that
        repeating a deletion that broke off still finds the vertices."""
        gone, lost = self.doomed(removal)
        for kind, doomed in (("edges", lost), ("vertices", gone)):
            self.without(kind, doomed)

    def without(self, kind: str, doomed: DataFrame) -> None:
        """Rewrite the parts of settled keys without these rows.  Keys that fit are sent to the
        rows, which are then written by the tasks that read them."""
        parts = self.parts_of(kind, doomed)
        if not parts.isEmpty():
            fits = fits_memory(doomed)
            kept = self.part(kind, parts).join(mark(doomed, fits), ROW_KEY[kind], "left_anti")
            self.replace(kind, kept, parts, in_place=fits)

    def doomed(self, removal: Removal) -> tuple[DataFrame, DataFrame]:
        """Keys of the vertices and edges that a deletion takes, settled."""
        graph = self.graph()
        gone = cut_lineage(removal.doomed_vertices(graph))
        return gone, cut_lineage(removal.doomed_edges(graph, gone, fits_memory(gone), gone.count()))

    def overwrite(self, graph: PropertyGraph) -> None:
        """Replace everything by another graph, which may come from this store."""
        fresh = self._table("vertices", CATALOGUE) is None and self._table("edges", CATALOGUE) is None
        # Edges may come from vertices that are about to be replaced.
        new = {"vertices": graph.vertices, "edges": graph.edges if fresh else cut_lineage(graph.edges)}
        held = {kind: None if fresh else cut_lineage(self._stored(kind).select(*PART).distinct()) for kind in KINDS}
        for kind, rows in new.items():
            self.replace(kind, rows, held[kind])
        self.spark.createDataFrame([], CATALOGUE).write.mode("overwrite").parquet(f"{self.path}/catalogue")
        for kind in KINDS:
            self.note(kind, self._read(kind))
        if self.index is not None:
            self.index.rebuild(self._read("vertices"))

    def truncate(self) -> None:
        """Remove all vertices and edges; the type hierarchy stays."""
        for kind in KINDS:
            nothing = self.spark.createDataFrame([], KINDS[kind])
            self._write(kind, nothing).mode("overwrite").option("partitionOverwriteMode", "static").save(f"{self.path}/{kind}")
        self.spark.createDataFrame([], CATALOGUE).write.mode("overwrite").parquet(f"{self.path}/catalogue")
        if self.index is not None:
            self.index.clear()

    def compact(self) -> None:
        """Rewrite all parts, so that what many appends left is in few files, and the index."""
        for kind in KINDS:
            self.replace(kind, self._read(kind))
        if self.index is not None:
            self.index.rebuild(self._read("vertices"))


def _prunes(parts: DataFrame) -> DataFrame:
    """Parts in a form that Spark uses to prune folders: it looks for a filter on this side."""
    return parts.where(F.length("label") >= 0)
