"""Joins over the graph, neighbourhoods, paths and degrees."""

from pyspark.sql import functions as F

from knotwork.model import PropertyGraph, shape_vertices
from knotwork.operators import lookup, merge, traverse
from knotwork.plans.sql import query_views, register_views, run_sql
from workload.registry import E, P, V, Tables, query, with_
from workload.rules import normal_sql
from workload.writes import TRIPLES, stored_triples, triples

T_ = f"""t AS (SELECT coalesce(nullif(a.name, ''), a.id) AS subject, e.label AS relation,
  coalesce(nullif(b.name, ''), b.id) AS object, e.src, e.dst, a.label AS sl, b.label AS ol
  FROM e JOIN v a ON e.src = a.vid JOIN v b ON e.dst = b.vid)"""


@query("J1 L3", with_(V) + f""", refs AS (
  SELECT c_name || ' Inc.' AS ref FROM customer UNION SELECT CAST(doc_id AS VARCHAR) FROM documents
  UNION SELECT '  vec_' || vec_id FROM embeddings UNION SELECT 'none ' || p_name FROM part
  UNION SELECT ' ' || doc_id FROM documents)
SELECT ref, coalesce(c.vid, n.vid) AS vid FROM refs
LEFT JOIN v c ON c.label = 'TextChunk' AND c.id = ref
LEFT JOIN v n ON n.label <> 'TextChunk' AND n.name = {normal_sql('ref')}
WHERE coalesce(c.vid, n.vid) IS NOT NULL""")
def endpoint_resolution(t: Tables):
    refs = (
        t("customer").select(F.concat("c_name", F.lit(" Inc.")).alias("ref"))
        .union(t("documents").select(F.col("doc_id").cast("string")))
        .union(t("embeddings").select(F.concat(F.lit("  vec_"), "vec_id")))
        .union(t("part").select(F.concat(F.lit("none "), "p_name")))
        .union(t("documents").select(F.concat(F.lit(" "), "doc_id")))
    )
    return merge.endpoints(t.graph, refs)


def shared_names(t: Tables) -> PropertyGraph:
    """One name under several types: products by type, and chunks with such ids."""
    parts = t("part").select("p_name", "p_type").distinct()
    typed = shape_vertices(parts, F.upper("p_type"), F.col("p_name"), name=F.col("p_name"))
    named = t("part").where(F.col("p_size") > 40).select("p_name").distinct()
    chunks = shape_vertices(named, "TextChunk", F.col("p_name"), id=F.col("p_name"), text=F.lit("about"))
    return PropertyGraph(typed.union(chunks), PropertyGraph.empty(t.spark).edges)


SHARED = """s AS (SELECT DISTINCT upper(p_type) AS label, p_name AS name FROM part
  UNION ALL SELECT DISTINCT 'TextChunk', p_name FROM part WHERE p_size > 40),
  best AS (SELECT name, arg_min(label, CASE WHEN label = 'TextChunk' THEN '' ELSE label END) AS label
    FROM s GROUP BY name)"""


@query("J1 F2 L3", with_(SHARED) + "SELECT name AS ref, label || '/' || name AS vid FROM best")
def first_type_wins(t: Tables):
    return merge.endpoints(shared_names(t), t("part").select(F.col("p_name").alias("ref")))


@query("F2 L3", with_(SHARED) + "SELECT label || '/' || name AS vid FROM best")
def first_type_by_id(t: Tables):
    return lookup.nodes_by_ids(shared_names(t), t("part").select("p_name")).select("vid")


@query("J4", with_(SHARED) + """SELECT name || ' Ltd' AS ref, label || '/' || name AS vid FROM
  (SELECT name, min(label) AS label FROM s WHERE label <> 'TextChunk' GROUP BY name)""")
def start_nodes(t: Tables):
    return lookup.start_vertices(
        shared_names(t), t("part").select(F.concat("p_name", F.lit(" Ltd")).alias("ref"))
    )


@query("J2 F15", with_(V, E, T_) + "SELECT subject, relation, object, src, dst FROM t")
def triplets(t: Tables):
    return traverse.triplets(t.graph)


@query("R2 L1", with_(V, E, T_) + """SELECT subject, relation, object FROM (
  SELECT *, row_number() OVER (PARTITION BY relation ORDER BY src, dst) AS r FROM t) WHERE r <= 100""")
def triplet_listing(t: Tables):
    return traverse.triplet_listing(t.graph).select("subject", "relation", "object")


@query("R2", with_(V, E, P, T_) + """SELECT subject, relation, object FROM t WHERE relation = 'FROM_NATION'
  AND (subject IN ('NATION_3', 'NATION_9') OR object IN ('NATION_3', 'NATION_9'))
  AND (src IN (SELECT vid FROM p WHERE property = 'c_mktsegment' AND value = 'BUILDING'))""")
def triplet_listing_filtered(t: Tables):
    return traverse.triplet_listing(
        t.graph, ["NATION_3", "NATION_9"], ["FROM_NATION"], {"c_mktsegment": "BUILDING"}, per_type=None
    ).select("subject", "relation", "object")


@query("J3", with_(TRIPLES) + "SELECT s AS subject, r AS relation, o AS object FROM triples WHERE s = 'Customer#000000007'")
def subject_adjacency(t: Tables):
    g = merge.upsert_triples(stored_triples(t), triples(t), "Entity")
    return traverse.subject_triplets(g, "Entity", "Customer#000000007")


@query("J5", with_(V, E) + """SELECT e.label AS relation, a.vid AS source, a.label AS source_type, a.name AS source_name,
  b.vid AS target, b.label AS target_type, b.name AS target_name FROM e JOIN v a ON e.src = a.vid JOIN v b ON e.dst = b.vid""")
def rich_triplets(t: Tables):
    g = t.graph
    return traverse.rich_triplets(g, g.edges).select(
        F.col("relation.label").alias("relation"),
        F.col("source.vid").alias("source"), F.col("source.label").alias("source_type"),
        F.col("source.name").alias("source_name"), F.col("target.vid").alias("target"),
        F.col("target.label").alias("target_type"), F.col("target.name").alias("target_name"),
    )


@query("J6", with_(V) + """SELECT a.vid, c.text AS source_text, c.ref_doc_id AS source_doc FROM v a
JOIN v c ON c.label = 'TextChunk' AND c.id = a.triplet_source_id""")
def entity_sources(t: Tables):
    g = t.graph
    entities = g.vertices.where(F.col("triplet_source_id").isNotNull()).select("vid", "triplet_source_id")
    return traverse.source_chunks(g, entities).drop("triplet_source_id")


@query("J7", """SELECT c_name AS person, n_name AS company, c_mktsegment AS segment FROM customer
JOIN nation ON c_nationkey = n_nationkey""")
def implicit_join(t: Tables):
    register_views(
        t.graph, {"CUSTOMER": ["c_mktsegment"]}, {"CUSTOMER": "vertex", "NATION": "vertex", "FROM_NATION": "edge"}
    )
    return run_sql(t.spark, """
        SELECT person.name AS person, company.name AS company, person.c_mktsegment AS segment
        FROM CUSTOMER person, NATION company, FROM_NATION rel
        WHERE rel.src = person.vid AND rel.dst = company.vid""")


@query("J10", with_(V, E) + "SELECT vid, label FROM v WHERE vid NOT IN (SELECT src FROM e UNION SELECT dst FROM e)")
def orphan_vertices(t: Tables):
    return traverse.orphans(t.graph).select("vid", "label")


@query("J11 T7 Q3", with_(V, E, T_) + """SELECT subject, relation, object FROM t
WHERE sl IN ('CUSTOMER', 'NATION') AND relation IN ('FROM_NATION', 'PLACED', 'IN_REGION') AND ol IN ('ORDERS', 'REGION')""")
def triplets_by_type(t: Tables):
    return traverse.triplets_by_type(
        t.graph, ["CUSTOMER", "NATION"], ["FROM_NATION", "PLACED", "IN_REGION"], ["ORDERS", "REGION"]
    ).select("subject", "relation", "object")


@query("T1", with_(V, E) + "SELECT src AS vid, label, dst AS neighbor FROM e WHERE label = 'PLACED' AND src IN (SELECT vid FROM v WHERE label = 'CUSTOMER')")
def out_neighbors(t: Tables):
    g = t.graph
    return traverse.out_neighbors(g, g.vertices.where(F.col("label") == "CUSTOMER"), "PLACED")


@query("T1", with_(V, E) + "SELECT dst AS vid, label, src AS neighbor FROM e WHERE label = 'FROM_NATION' AND dst IN (SELECT vid FROM v WHERE label = 'NATION')")
def in_neighbors(t: Tables):
    g = t.graph
    return traverse.in_neighbors(g, g.vertices.where(F.col("label") == "NATION"), "FROM_NATION")


@query("T2 Q2", with_(V, E) + """SELECT src AS vid, label, dst AS neighbor FROM e WHERE src IN (SELECT vid FROM v WHERE label = 'NATION')
UNION ALL SELECT dst, label, src FROM e WHERE dst IN (SELECT vid FROM v WHERE label = 'NATION')""")
def both_neighbors(t: Tables):
    g = t.graph
    return traverse.both_neighbors(g, g.vertices.where(F.col("label") == "NATION"))


@query("T3", with_(V, E) + """SELECT label, src, dst FROM e WHERE src IN (SELECT vid FROM v WHERE label IN ('NATION', 'REGION'))
OR dst IN (SELECT vid FROM v WHERE label IN ('NATION', 'REGION'))""")
def incident_edges(t: Tables):
    g = t.graph
    starts = g.vertices.where(F.col("label").isin("NATION", "REGION"))
    return traverse.incident_edges(g, starts).select("label", "src", "dst")


FROM_ORDERS = """refs AS (SELECT 'CUSTOMER/' || c_name AS vid FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
  UNION SELECT 'TextChunk/' || vec_id FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)),
cut AS (SELECT * FROM e WHERE src IN (SELECT vid FROM refs) OR dst IN (SELECT vid FROM refs)
  ORDER BY label, src, dst LIMIT {limit})"""
MAP_COLUMNS = "SELECT src AS source, label AS relation, dst AS target FROM cut"


def map_refs(t: Tables):
    """Every customer that ordered (raw name with a suffix) and every source chunk."""
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(" LLC"))
    return t("orders").select(name.alias("ref")).union(t("embeddings").select(F.col("vec_id").cast("string")))


def map_rows(found):
    return found.select(
        F.col("source.vid").alias("source"), F.col("relation.label").alias("relation"),
        F.col("target.vid").alias("target"),
    )


@query("T4 F16", with_(V, E, FROM_ORDERS.format(limit=3000)) + MAP_COLUMNS + " WHERE label <> 'MENTIONS'")
def rel_map_one_hop(t: Tables):
    """The limit counts ignored relations, as it applies before them."""
    return map_rows(traverse.rel_map(t.graph, map_refs(t), 2, 3000, ["MENTIONS"], one_hop=True))


@query("T4 F16", with_(V, E.replace("e AS (", "e0 AS ("), "e AS (SELECT * FROM e0 WHERE label <> 'FROM_NATION')",
                       FROM_ORDERS.format(limit=30)) + MAP_COLUMNS)
def rel_map_ignore_first(t: Tables):
    return map_rows(traverse.rel_map(t.graph, map_refs(t), 2, 30, ["FROM_NATION"], limit_first=False, one_hop=True))


UNDIRECTED = "u AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e)"
HOPS = """hops AS (SELECT vid, 0 AS depth FROM v WHERE label = 'REGION' AND name = 'ASIA'
  UNION SELECT u.b, depth + 1 FROM hops JOIN u ON u.a = hops.vid WHERE depth < {depth})"""


@query("T4 T6", with_(V, E, UNDIRECTED, HOPS.format(depth=1), "reach AS (SELECT DISTINCT vid FROM hops)", recursive=True) + """
SELECT src AS source, label AS relation, dst AS target FROM (SELECT * FROM e WHERE src IN (SELECT vid FROM reach)
  OR dst IN (SELECT vid FROM reach) ORDER BY label, src, dst LIMIT 200)""")
def rel_map_two_hops(t: Tables):
    refs = t("region").where(F.col("r_name") == "ASIA").select(F.col("r_name").alias("ref"))
    return map_rows(traverse.rel_map(t.graph, refs, 2, 200))


@query("T6", with_(V, E, UNDIRECTED, HOPS.format(depth=3), recursive=True) + "SELECT vid, CAST(min(depth) AS INT) AS depth FROM hops GROUP BY vid")
def khop_neighborhood(t: Tables):
    g = t.graph
    starts = g.vertices.where((F.col("label") == "REGION") & (F.col("name") == "ASIA"))
    return traverse.k_hop(g, starts, 3)


@query("T6 T2", with_(V, E, UNDIRECTED, HOPS.format(depth=1), recursive=True) + "SELECT DISTINCT u.b AS vid FROM hops JOIN u ON u.a = hops.vid")
def khop_expansion(t: Tables):
    g = t.graph
    starts = g.vertices.where((F.col("label") == "REGION") & (F.col("name") == "ASIA"))
    return traverse.k_hop_neighbors(g, starts, 1)


@query("T5 Q3", with_(V, E) + """, walks AS (
  SELECT src AS start, 1 AS length, [label, dst] AS steps, dst AS fin FROM e
    WHERE src IN (SELECT vid FROM v WHERE label IN ('CUSTOMER', 'NATION'))
  UNION ALL SELECT a.src, 2, [a.label, a.dst, b.label, b.dst], b.dst FROM e a JOIN e b ON a.dst = b.src
    WHERE a.src IN (SELECT vid FROM v WHERE label IN ('CUSTOMER', 'NATION')))
SELECT start, CAST(length AS INT) AS length, array_to_string(steps, ' > ') AS path FROM walks
ORDER BY length, start, steps LIMIT 5000""")
def paths_with_limit(t: Tables):
    g = t.graph
    starts = g.vertices.where(F.col("label").isin("CUSTOMER", "NATION"))
    return _shown(traverse.paths(g, starts, 2, 5000, final_target=False))


def _shown(found):
    return found.select("start", "length", F.concat_ws(" > ", "path").alias("path"))


@query("T5", with_(V, E) + """, walks AS (
  SELECT src AS start, 1 AS length, [label, dst] AS steps FROM e WHERE src LIKE 'PART/%'
  UNION ALL SELECT a.src, 2, [a.label, b.dst, b.label, b.dst] FROM e a JOIN e b ON a.dst = b.src WHERE a.src LIKE 'PART/%')
SELECT start, CAST(length AS INT) AS length, array_to_string(steps, ' > ') AS path FROM walks""")
def paths_upto_depth(t: Tables):
    g = t.graph
    return _shown(traverse.paths(g, g.vertices.where(F.col("label") == "PART"), 2, None))


@query("T8 A8", with_(E) + "SELECT vid, CAST(count(*) AS BIGINT) AS degree FROM (SELECT src AS vid FROM e UNION ALL SELECT dst FROM e) GROUP BY vid")
def degree(t: Tables):
    return traverse.degree(t.graph)


def known(t: Tables, **types: str):
    """A catalogue of some types."""
    return t.spark.createDataFrame([(kind, label, None) for label, kind in types.items()], "kind string, label string, property string")


@query("Q2 T1 J7", with_(V, E) + """SELECT c.name AS customer, n.name AS nation, r.name AS region FROM e f
JOIN v c ON c.vid = f.src AND c.label = 'CUSTOMER' JOIN v n ON n.vid = f.dst JOIN e i ON i.src = n.vid AND i.label = 'IN_REGION'
JOIN v r ON r.vid = i.dst WHERE f.label = 'FROM_NATION'""")
def sql_neighbours(t: Tables):
    """Two steps along named relations in one statement."""
    return query_views(t.graph, """
        SELECT c.name AS customer, n.name AS nation, r.name AS region
        FROM CUSTOMER c, LATERAL out_v(c.vid, 'FROM_NATION') f JOIN NATION n ON n.vid = f.vid,
             LATERAL out_v(n.vid, 'IN_REGION') i JOIN REGION r ON r.vid = i.vid
        """, catalogue=known(t, CUSTOMER="vertex", NATION="vertex", REGION="vertex"))


@query("Q2 T3 T8", with_(V, E) + """SELECT n.vid, x.label, count(*) AS edges, count(DISTINCT x.src) AS sources FROM v n
JOIN e x ON x.src = n.vid OR x.dst = n.vid WHERE n.label = 'NATION' GROUP BY n.vid, x.label""")
def sql_incident_edges(t: Tables):
    """Edges at every nation, counted by type; parameters are bound."""
    return query_views(t.graph, """
        SELECT n.vid, x.label, count(*) AS edges, count(DISTINCT x.src) AS sources
        FROM V n, LATERAL both_e(n.vid) x WHERE n.label = :label GROUP BY n.vid, x.label""", {"label": "NATION"}, catalogue=known(t, NONE="edge"))


@query("Q2 T2 T6", with_(V, E, UNDIRECTED, HOPS.format(depth=2), recursive=True) + "SELECT DISTINCT u.b AS vid FROM hops JOIN u ON u.a = hops.vid")
def sql_traverse(t: Tables):
    """Neighbours of all that is within two hops, by a recursive statement."""
    return query_views(t.graph, """
        WITH RECURSIVE reach(vid, depth) AS (
          SELECT vid, 0 FROM REGION WHERE name = 'ASIA'
          UNION ALL SELECT n.vid, depth + 1 FROM reach, LATERAL both_v(reach.vid) n WHERE depth < 2)
        SELECT DISTINCT n.vid FROM (SELECT DISTINCT vid FROM reach) r, LATERAL both_v(r.vid) n""", catalogue=known(t, REGION="vertex"))


@query("Q2 T6", with_(V, E, UNDIRECTED, HOPS.format(depth=2), recursive=True) + "SELECT vid, min(depth) AS depth FROM hops GROUP BY vid")
def sql_hops(t: Tables):
    """The hop at which a vertex is first reached, as ``k_hop`` gives it."""
    return query_views(t.graph, """
        WITH RECURSIVE reach(vid, depth) AS (
          SELECT vid, 0 FROM REGION WHERE name = 'ASIA'
          UNION ALL SELECT n.vid, depth + 1 FROM reach, LATERAL both_v(reach.vid) n WHERE depth < 2)
        SELECT vid, min(depth) AS depth FROM reach GROUP BY vid""", catalogue=known(t, REGION="vertex"))
