"""Registration, and the shared SQL for the graph over the tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from knotwork.model import PropertyGraph
from knotwork.session import tune
from knotwork.sources.tables import table, tables_graph

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}

Build = Callable[["Tables"], DataFrame]


class Tables:
    """The tables of one folder and the graph over them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = tune(spark)
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @property
    def graph(self) -> PropertyGraph:
        return tables_graph(self.spark, self.folder)


def query(covers: str, sql: str | None) -> Callable[[Build], Build]:
    """Register a query under its function name with the operators it covers."""
    def register(build: Build) -> Build:
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


# The graph of knotwork.sources.tables in SQL.
V = """v AS (
  SELECT label, key, label || '/' || key AS vid, name, id, text, ref_doc_id, triplet_source_id FROM (
    SELECT 'REGION' AS label, r_name AS key, r_name AS name, CAST(NULL AS VARCHAR) AS id,
           CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS ref_doc_id,
           CAST(NULL AS VARCHAR) AS triplet_source_id FROM region
    UNION ALL SELECT 'NATION', n_name, n_name, NULL, NULL, NULL, NULL FROM nation
    UNION ALL SELECT 'CUSTOMER', c_name, c_name, NULL, NULL, NULL, NULL FROM customer
    UNION ALL SELECT 'SUPPLIER', s_name, s_name, NULL, NULL, NULL, NULL FROM supplier
    UNION ALL SELECT 'PART', 'Part#' || p_partkey, 'Part#' || p_partkey, NULL, NULL, NULL, NULL FROM part
    UNION ALL SELECT 'ORDERS', 'Order#' || o_orderkey, 'Order#' || o_orderkey, NULL, NULL, NULL, NULL FROM orders
    UNION ALL SELECT 'TextChunk', CAST(doc_id AS VARCHAR), NULL, CAST(doc_id AS VARCHAR), text, source, NULL
      FROM documents
    UNION ALL SELECT 'TOPIC_' || label, 'vec_' || vec_id, 'vec_' || vec_id, NULL, NULL, NULL,
      CAST(vec_id AS VARCHAR) FROM embeddings
  ))"""
E = """e AS (
  SELECT 'IN_REGION' AS label, 'NATION/' || n_name AS src, 'REGION/' || r_name AS dst
    FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'FROM_NATION', 'CUSTOMER/' || c_name, 'NATION/' || n_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'FROM_NATION', 'SUPPLIER/' || s_name, 'NATION/' || n_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'PLACED', 'CUSTOMER/' || c_name, 'ORDERS/Order#' || o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT DISTINCT 'CONTAINS', 'ORDERS/Order#' || l_orderkey, 'PART/Part#' || l_partkey FROM lineitem
  UNION ALL SELECT DISTINCT 'SUPPLIED_BY', 'PART/Part#' || l_partkey, 'SUPPLIER/' || s_name
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  UNION ALL SELECT 'MENTIONS', 'TextChunk/' || vec_id, 'TOPIC_' || label || '/vec_' || vec_id
    FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)
  )"""
# Property map entries, one row each.
P = """p AS (
  SELECT 'REGION' AS label, 'REGION/' || r_name AS vid, 'r_regionkey' AS property,
         CAST(r_regionkey AS VARCHAR) AS value FROM region
  UNION ALL SELECT 'NATION', 'NATION/' || n_name, 'n_nationkey', CAST(n_nationkey AS VARCHAR) FROM nation
  UNION ALL SELECT 'CUSTOMER', 'CUSTOMER/' || c_name, unnest(['c_custkey', 'c_nationkey', 'c_acctbal', 'c_mktsegment']),
    unnest([CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS VARCHAR), c_mktsegment])
    FROM customer
  UNION ALL SELECT 'SUPPLIER', 'SUPPLIER/' || s_name, unnest(['s_suppkey', 's_nationkey', 's_acctbal']),
    unnest([CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), CAST(s_acctbal AS VARCHAR)]) FROM supplier
  UNION ALL SELECT 'PART', 'PART/Part#' || p_partkey, unnest(['p_name', 'p_brand', 'p_type', 'p_size']),
    unnest([p_name, p_brand, p_type, CAST(p_size AS VARCHAR)]) FROM part
  UNION ALL SELECT 'ORDERS', 'ORDERS/Order#' || o_orderkey,
    unnest(['o_orderkey', 'o_orderstatus', 'o_totalprice', 'o_orderpriority']),
    unnest([CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(o_totalprice AS VARCHAR), o_orderpriority]) FROM orders
  UNION ALL SELECT 'TextChunk', 'TextChunk/' || doc_id, unnest(['lang', 'n_chars']),
    unnest([lang, CAST(n_chars AS VARCHAR)]) FROM documents
  )"""
# Topics with their vectors.
TOPIC = """topic AS (
  SELECT 'TOPIC_' || label AS label, 'TOPIC_' || label || '/vec_' || vec_id AS vid, 'vec_' || vec_id AS name,
         CAST(vec_id AS VARCHAR) AS triplet_source_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings
  )"""

VECTOR = [round(math.sin(i + 1), 6) for i in range(64)]


def vector_literal(values: list[float] = VECTOR) -> str:
    return "CAST([" + ", ".join(repr(x) for x in values) + "] AS DOUBLE[])"


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def words(*values: str) -> str:
    """An SQL list of strings."""
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def literals(*values: str):
    """A Spark array of strings."""
    return F.array(*[F.lit(v) for v in values])


def content(graph: PropertyGraph) -> DataFrame:
    """All vertices and edges as plain rows."""
    vertices = graph.vertices.select(F.lit("vertex").alias("kind"), "label", F.col("vid").alias("item"))
    edges = graph.edges.select(
        F.lit("edge").alias("kind"), "label", F.concat_ws(" -> ", "src", "dst").alias("item")
    )
    return vertices.union(edges)


def content_sql(vertices: str, edges: str) -> str:
    """``content`` in SQL, given row filters on ``v`` and ``e``."""
    return (
        f"SELECT 'vertex' AS kind, label, vid AS item FROM v WHERE {vertices}\n"
        f"UNION ALL SELECT 'edge', label, src || ' -> ' || dst FROM e WHERE {edges}"
    )


def props_rows(df: DataFrame) -> DataFrame:
    """Property maps as (vid, property, value) rows."""
    return df.select("vid", F.explode("props").alias("property", "value"))
