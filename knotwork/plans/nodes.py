"""Python-side nodes and relations for small, literal batches.

Large batches come as DataFrames in the batch schemas of ``operators.merge``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from knotwork.operators.merge import NODE_BATCH, RELATION_BATCH


@dataclass
class EntityNode:
    name: str
    label: str | None = "entity"
    properties: dict = field(default_factory=dict)
    embedding: Sequence[float] | None = None


@dataclass
class ChunkNode:
    text: str
    id: str | None = None
    properties: dict = field(default_factory=dict)
    embedding: Sequence[float] | None = None


@dataclass
class LabelledNode:
    id: str
    label: str
    properties: dict = field(default_factory=dict)


@dataclass
class Relation:
    label: str | None
    source_id: str
    target_id: str
    properties: dict = field(default_factory=dict)


def reference(node: object) -> str:
    """The id a caller's node goes by: its name, else its id, or the string itself."""
    return node if isinstance(node, str) else getattr(node, "name", None) or node.id


def as_text(value: object) -> str:
    """Property text: nested values as JSON, everything else as its string."""
    return json.dumps(value) if isinstance(value, (list, dict)) else str(value)


def _texts(properties: dict | None) -> dict[str, str]:
    return {k: as_text(v) for k, v in (properties or {}).items() if v is not None}


def node_batch(spark: SparkSession, nodes: Sequence[object]) -> DataFrame:
    rows = []
    for seq, node in enumerate(nodes):
        vector = getattr(node, "embedding", None)
        vector = None if vector is None else [float(x) for x in vector]
        props = _texts(node.properties)
        if isinstance(node, EntityNode):
            rows.append(("entity", node.label, node.name, None, None, vector, props, seq))
        elif isinstance(node, ChunkNode):
            rows.append(("chunk", None, None, node.id, node.text, vector, props, seq))
        else:
            rows.append(("generic", node.label, None, node.id, None, vector, props, seq))
    return spark.createDataFrame(rows, NODE_BATCH)


def relation_batch(spark: SparkSession, relations: Sequence[Relation]) -> DataFrame:
    rows = [
        (r.label, r.source_id, r.target_id, _texts(r.properties), seq) for seq, r in enumerate(relations)
    ]
    return spark.createDataFrame(rows, RELATION_BATCH)
