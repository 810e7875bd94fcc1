"""A property graph over the sales, document and embedding tables.

Every part is a plain projection, so a query that filters on a label only reads
the tables behind that label.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from knotwork.functions.props import props_from
from knotwork.functions.text import TEXT_CHUNK
from knotwork.model import PropertyGraph, shape_edges, shape_vertices, vertex_id
from knotwork.operators.merge import mentions


@lru_cache(maxsize=64)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _entities(rows: DataFrame, label: str, name: Column, props: list[str]) -> DataFrame:
    return shape_vertices(rows, label, name, name=name, props=props_from(rows, props))


def order_name(key: Column | str) -> Column:
    return F.concat(F.lit("Order#"), key)


def part_name(key: Column | str) -> Column:
    return F.concat(F.lit("Part#"), key)


def topic_vertices(embeddings: DataFrame) -> DataFrame:
    name = F.concat(F.lit("vec_"), "vec_id")
    return shape_vertices(
        embeddings, F.concat(F.lit("TOPIC_"), "label"), name, name=name, embedding=F.col("embedding"),
        triplet_source_id=F.col("vec_id").cast("string"),
    )


def chunk_vertices(documents: DataFrame) -> DataFrame:
    chunk_id = F.col("doc_id").cast("string")
    return shape_vertices(
        documents, TEXT_CHUNK, chunk_id, id=chunk_id, text=F.col("text"), ref_doc_id=F.col("source"),
        props=props_from(documents, ["lang", "n_chars"]),
    )


@lru_cache(maxsize=8)
def tables_graph(spark: SparkSession, folder: str) -> PropertyGraph:
    """The graph as a lazy plan; the plan, not the data, is kept per session."""
    t = {
        n: table(spark, folder, n)
        for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                  "documents", "embeddings")
    }
    topics = topic_vertices(t["embeddings"])
    vertices = [
        _entities(t["region"], "REGION", F.col("r_name"), ["r_regionkey"]),
        _entities(t["nation"], "NATION", F.col("n_name"), ["n_nationkey"]),
        _entities(t["customer"], "CUSTOMER", F.col("c_name"),
                  ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]),
        _entities(t["supplier"], "SUPPLIER", F.col("s_name"), ["s_suppkey", "s_nationkey", "s_acctbal"]),
        _entities(t["part"], "PART", part_name("p_partkey"), ["p_name", "p_brand", "p_type", "p_size"]),
        _entities(t["orders"], "ORDERS", order_name("o_orderkey"),
                  ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]),
        chunk_vertices(t["documents"]),
        topics,
    ]

    def edges(rows: DataFrame, label: str, src_label: str, src: Column, dst_label: str, dst: Column,
              distinct: bool = False) -> DataFrame:
        pairs = rows.select(
            vertex_id(F.lit(src_label), src).alias("src"), vertex_id(F.lit(dst_label), dst).alias("dst")
        )
        return shape_edges(pairs, label, F.col("src"), F.col("dst"))

    nation_of = t["nation"].select(F.col("n_nationkey").alias("nationkey"), "n_name")
    region_of = t["region"].select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    customer_of = t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_name")
    supplier_of = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    named_items = t["lineitem"].select("l_partkey", "l_suppkey").distinct().join(supplier_of, "l_suppkey")
    edge_parts = [
        edges(t["nation"].join(region_of, "n_regionkey"), "IN_REGION", "NATION", F.col("n_name"),
              "REGION", F.col("r_name")),
        edges(t["customer"].withColumnRenamed("c_nationkey", "nationkey").join(nation_of, "nationkey"),
              "FROM_NATION", "CUSTOMER", F.col("c_name"), "NATION", F.col("n_name")),
        edges(t["supplier"].withColumnRenamed("s_nationkey", "nationkey").join(nation_of, "nationkey"),
              "FROM_NATION", "SUPPLIER", F.col("s_name"), "NATION", F.col("n_name")),
        edges(t["orders"].join(customer_of, "o_custkey"), "PLACED", "CUSTOMER", F.col("c_name"),
              "ORDERS", order_name("o_orderkey")),
        edges(t["lineitem"].select("l_orderkey", "l_partkey").distinct(), "CONTAINS", "ORDERS",
              order_name("l_orderkey"), "PART", part_name("l_partkey")),
        edges(named_items, "SUPPLIED_BY", "PART", part_name("l_partkey"), "SUPPLIER", F.col("s_name")),
        mentions(topics, t["documents"].select(F.col("doc_id").cast("string").alias("id"))),
    ]
    return PropertyGraph(reduce(DataFrame.union, vertices), reduce(DataFrame.union, edge_parts))
