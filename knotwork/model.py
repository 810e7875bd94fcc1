"""The property graph: two DataFrames and the label hierarchy."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from knotwork.functions.props import PROPS_TYPE, no_props
from knotwork.functions.text import BASE_ENTITY, TEXT_CHUNK

VERTEX_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("vid", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("ref_doc_id", T.StringType()),
    T.StructField("doc_id", T.StringType()),
    T.StructField("triplet_source_id", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("props", PROPS_TYPE),
])
EDGE_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("src", T.StringType()),
    T.StructField("dst", T.StringType()),
    T.StructField("props", PROPS_TYPE),
])

# Vertex types present in every graph, and the optional basic ones.
CORE_TYPES = [BASE_ENTITY, TEXT_CHUNK]
BASIC_TYPES = ["PERSON", "ORGANIZATION", "LOCATION", "PLACE"]
CORE_RELATIONS = ["MENTIONS"]


def vertex_id(label: Column, key: Column) -> Column:
    """Deterministic record id.  Labels hold no slash, so it is unambiguous."""
    return F.concat(label, F.lit("/"), key)


def edge_id(label: str = "label", src: str = "src", dst: str = "dst") -> Column:
    """Deterministic edge id; computed only where a query asks for it.

    Every part goes in with its length, so no two edges share an id whatever their
    names hold.
    """
    parts = [x for c in (label, src, dst) for x in (F.length(c).cast("string"), F.lit(":"), F.col(c))]
    return F.sha2(F.concat(*parts), 256)


def shape_vertices(df: DataFrame, label: Column | str, key: Column,
                   extra: list[Column] | None = None, **columns: Column) -> DataFrame:
    """Project any table onto the vertex schema; columns not given are NULL."""
    label_col = F.lit(label) if isinstance(label, str) else label
    given = {
        "label": label_col,
        "key": key,
        "vid": vertex_id(label_col, key),
        "props": no_props(),
        **columns,
    }
    return df.select(*(extra or []), *[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in VERTEX_SCHEMA.fields
    ])


def shape_edges(df: DataFrame, label: Column | str, src: Column, dst: Column,
                props: Column | None = None) -> DataFrame:
    label_col = F.lit(label) if isinstance(label, str) else label
    return df.select(
        label_col.alias("label"), src.alias("src"), dst.alias("dst"),
        (no_props() if props is None else props).alias("props"),
    )


@dataclass(frozen=True)
class PropertyGraph:
    """``parents`` maps a label to its parent type.  Vertex labels without an
    entry belong to the base entity type; ``TextChunk`` stands outside it."""

    vertices: DataFrame
    edges: DataFrame
    parents: Mapping[str, str | None] = field(default_factory=dict)

    @property
    def spark(self) -> SparkSession:
        return self.vertices.sparkSession

    @staticmethod
    def empty(spark: SparkSession) -> "PropertyGraph":
        return PropertyGraph(
            spark.createDataFrame([], VERTEX_SCHEMA), spark.createDataFrame([], EDGE_SCHEMA)
        )

    def with_vertices(self, vertices: DataFrame) -> "PropertyGraph":
        return replace(self, vertices=vertices)

    def with_edges(self, edges: DataFrame) -> "PropertyGraph":
        return replace(self, edges=edges)

    def in_type(self, base: str) -> Column:
        """Rows of a type or of any type below it, as a predicate on ``label``
        (so partitions of other labels are never read)."""
        inside, labels = types_of(self.parents, base)
        held = F.col("label").isin(*labels)
        return held if inside else ~held

    def declared(self) -> list[str]:
        """Vertex types that exist without any row: the core types and the hierarchy."""
        return sorted({*CORE_TYPES, *self.parents, *(p for p in self.parents.values() if p)})


def is_entity(parents: Mapping[str, str | None], label: str) -> bool:
    """Whether a label is the base entity type or lies below it."""
    seen: set[str] = set()
    while label != BASE_ENTITY:
        if label == TEXT_CHUNK or label in seen:
            return False
        seen.add(label)
        parent = parents.get(label, BASE_ENTITY)
        if parent is None:
            return False
        label = parent
    return True


def types_of(parents: Mapping[str, str | None], base: str) -> tuple[bool, list[str]]:
    """The labels of a type and of those below it: the listed ones (True), or all but them."""
    if base == BASE_ENTITY:
        named = {TEXT_CHUNK} | set(parents) | {p for p in parents.values() if p}
        return False, sorted(t for t in named if not is_entity(parents, t))
    below = {base}
    while more := {t for t, p in parents.items() if p in below} - below:
        below |= more
    return True, sorted(below)
