"""Entity rules, property encoding and batch checks."""

from pyspark.sql import functions as F

from knotwork.functions import props as P_, text
from knotwork.operators import merge
from workload.registry import E, TOPIC, V, Tables, literals, query, with_, words

# Endings and words put behind table values, so every branch of the rules is hit.
ENDINGS = [
    "", " Software", " Inc", " Inc.", " Corp", " Corp.", " Ltd", " Ltd.", " LLC", " Company", " Co.", " Co",
    " Corporation", " Ltd LLC", "   ", " ({'k': 'v'})", " Inc ({'k': 1})", " software",
]
HINTS = [
    "", " corp", " Systems", " group", " Agency", " university", " Alliance", " Specification", " API",
    " system", " Platform", " language suite", " Service", " Project", " program", " initiative",
    " City", " state", " Region", " district", " County", " Prince", " plain",
]
SHORT = ["IBM", "A", "ab Inc", "abc Inc", "X1", "x Ltd.", "project", "NASA HQ", "", " "]

STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


def strip_sql(c: str) -> str:
    return STRIP.format(c)


def normal_sql(c: str) -> str:
    """Name normalisation in SQL."""
    plain = strip_sql(f"regexp_replace({strip_sql(c)}, '\\s*\\(\\{{[^}}]+\\}}\\)$', '')")
    base = strip_sql(
        f"regexp_replace({plain}, ' (Software|Inc\\.?|Corp\\.?|Ltd\\.?|LLC|Company|Co\\.)$', '')"
    )
    return f"CASE WHEN length({base}) > 2 THEN {base} ELSE {plain} END"


def class_sql(c: str) -> str:
    """Pattern classification in SQL; words that contain an earlier one are left out."""
    low = f"lower({c})"
    org = (
        "co|inc|ltd|llc|software|systems|technologies|solutions|group|agency|administration|foundation"
        "|institute|university|organization|association|alliance"
    )
    tech = "specification|standard|protocol|api|system|platform|framework|language|suite|service"
    return (
        f"CASE WHEN regexp_matches({low}, '{org}') THEN 'ORGANIZATION' "
        f"WHEN upper({c}) = {c} AND {low} <> {c} AND NOT regexp_matches({strip_sql(c)}, '\\s') "
        f"AND length({c}) >= 2 THEN 'ORGANIZATION' "
        f"WHEN regexp_matches({low}, '{tech}') THEN 'TECHNOLOGY' "
        f"WHEN regexp_matches({strip_sql(c)}, '\\S\\s+\\S') AND regexp_matches({low}, 'project|program|initiative') "
        f"THEN 'PROJECT' WHEN regexp_matches({low}, 'city|state|country|region|district|county') THEN 'LOCATION' "
        f"ELSE 'Entity' END"
    )


def label_sql(c: str) -> str:
    upper = f"replace(replace(upper({strip_sql(c)}), ' ', '_'), '-', '_')"
    return f"CASE WHEN regexp_matches(replace({upper}, '_', ''), '^[\\p{{L}}\\p{{N}}]+$') THEN {upper} END"


NAMES_SQL = f"""names AS (
  SELECT base || ending AS raw FROM (
    SELECT p_name AS base FROM part UNION ALL SELECT c_name FROM customer UNION ALL SELECT n_name FROM nation
    UNION ALL SELECT '  ' || s_name FROM supplier), unnest({{endings}}) AS u(ending)
  UNION ALL SELECT unnest({words(*SHORT)}))"""


@query("N3 N5", with_(NAMES_SQL.format(endings=words(*ENDINGS))) + f"SELECT raw, {normal_sql('raw')} AS name FROM names")
def normalize_names(t: Tables):
    return _with_endings(t, ENDINGS).select("raw", text.normalize_name(F.col("raw")).alias("name"))


def spread(rows):
    """Rows of a small file over all cores, because every one of them becomes many."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def _with_endings(t: Tables, endings: list[str]):
    base = (
        t("part").select("p_name").union(t("customer").select("c_name")).union(t("nation").select("n_name"))
        .union(t("supplier").select(F.concat(F.lit("  "), "s_name"))).toDF("base")
    )
    forms = spread(base).select("base", F.explode(literals(*endings)).alias("ending"))
    short = t.spark.createDataFrame([(s,) for s in SHORT], "raw string")
    return forms.select(F.concat("base", "ending").alias("raw")).union(short)


@query("N2", with_(NAMES_SQL.format(endings=words(*HINTS))) + f"SELECT raw, {class_sql('raw')} AS type FROM names")
def classify_names(t: Tables):
    return _with_endings(t, HINTS).select("raw", text.classify_name(F.col("raw")).alias("type"))


LABELS = ["person", " Tech-Nology ", "works at", "a/b", "", "__", "café 1", "x.y", "ENTITY", "Entity"]


@query("N1", f"""SELECT raw, {label_sql('raw')} AS label FROM (
  SELECT c_mktsegment || ending AS raw FROM customer, unnest({words(' Group', '-' , ' (a)', '_1', ' & co')}) AS u(ending)
  UNION ALL SELECT o_orderpriority FROM orders UNION ALL SELECT unnest({words(*LABELS)}))""")
def canonical_labels(t: Tables):
    endings = literals(" Group", "-", " (a)", "_1", " & co")
    forms = spread(t("customer").select("c_mktsegment")).select("c_mktsegment", F.explode(endings).alias("ending"))
    raw = forms.select(F.concat("c_mktsegment", "ending").alias("raw")).union(t("orders").select("o_orderpriority"))
    given = t.spark.createDataFrame([(x,) for x in LABELS], "raw string")
    return raw.union(given).select("raw", text.canonical_label(F.col("raw")).alias("label"))


@query("N1 N2 N4", f"""SELECT label, name, coalesce({label_sql('label')}, {class_sql('name')}) AS type FROM (
  SELECT CASE WHEN p_size > 25 THEN p_type WHEN p_size > 10 THEN p_type || '/' || p_brand ELSE '' END AS label,
    p_name || hint AS name FROM part, unnest({words(*HINTS)}) AS u(hint)) WHERE trim(name) <> ''""")
def entity_types(t: Tables):
    size = F.col("p_size")
    forms = spread(t("part").select("p_size", "p_type", "p_brand", "p_name")).select(
        F.when(size > 25, F.col("p_type")).when(size > 10, F.concat_ws("/", "p_type", "p_brand"))
        .otherwise("").alias("label"),
        "p_name", F.explode(literals(*HINTS)).alias("hint"),
    ).select("label", F.concat("p_name", "hint").alias("name"))
    return forms.where(~text.is_blank(F.col("name"))).select(
        "label", "name", text.entity_label(F.col("label"), F.col("name")).alias("type")
    )


@query("N6", """SELECT doc_id, replace(translate(text || ' ‘a’ “b” c–d e—f',
  '–‘’“”', '-''''""'), '—', '--') AS text FROM documents""")
def fold_punctuation(t: Tables):
    marked = F.concat("text", F.lit(" ‘a’ “b” c–d e—f"))
    return t("documents").select("doc_id", text.fold_punctuation(marked).alias("text"))


@query("N7", """SELECT conv_id, turn, unnest(['role', 'turn', 'origin', 'first']) AS property,
  unnest([role, CAST(turn AS VARCHAR), CAST(to_json({'conv': conv_id, 'turn': turn}) AS VARCHAR),
    CASE WHEN turn = 0 THEN 'True' ELSE 'False' END]) AS value FROM conversations""")
def encode_properties(t: Tables):
    rows = t("conversations").select(
        "conv_id", "turn", "role", F.struct(F.col("conv_id").alias("conv"), "turn").alias("origin"),
        (F.col("turn") == 0).alias("first"),
    )
    encoded = P_.props_from(rows, ["role", "turn", "origin", "first"])
    return rows.select("conv_id", "turn", F.explode(encoded).alias("property", "value"))


@query("N8", """SELECT doc_id, property, CAST(length(value) AS INT) AS length FROM (
  SELECT doc_id, unnest(['text', 'lang', 'source']) AS property, unnest([text, lang, source]) AS value FROM documents)
  WHERE length(value) <= 1000""")
def drop_large_properties(t: Tables):
    documents = t("documents")
    props = P_.drop_large(P_.props_from(documents, ["text", "lang", "source"]))
    return documents.select("doc_id", F.explode(props).alias("property", "value")).select(
        "doc_id", "property", F.length("value").alias("length")
    )


@query("N9", """SELECT 'TextChunk/' || doc_id AS vid, source AS ref_doc_id, CAST(doc_id AS VARCHAR) AS doc_id,
  'lang' AS rest, lang AS value FROM documents""")
def reserved_properties(t: Tables):
    documents = t("documents")
    batch = merge.batch_of(
        documents, merge.NODE_BATCH, kind=F.lit("chunk"), id=F.col("doc_id").cast("string"), text=F.col("text"),
        seq=F.col("doc_id"),
        props=F.create_map(
            F.lit("ref_doc_id"), F.col("source"), F.lit("lang"), F.col("lang"), F.lit("embedding"), F.lit("x"),
            F.lit("doc_id"), F.col("doc_id").cast("string"), F.lit("name"), F.lit(""),
        ),
    )
    prepared = merge.prepare_nodes(batch)
    return prepared.select("vid", "ref_doc_id", "doc_id", F.explode("props").alias("rest", "value"))


@query("N10", """SELECT o_orderkey, upper(replace('has priority ' || o_orderpriority, ' ', '_')) AS relation FROM orders""")
def relation_names(t: Tables):
    given = F.concat(F.lit("has priority "), "o_orderpriority")
    return t("orders").select("o_orderkey", text.relation_name(given).alias("relation"))


@query("N11 N12", """SELECT o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'NATION_REL' ELSE 'follows' END AS label
FROM orders WHERE o_orderstatus <> 'P'""")
def relation_collision(t: Tables):
    status = F.col("o_orderstatus")
    batch = merge.batch_of(
        t("orders"), merge.RELATION_BATCH, seq=F.col("o_orderkey"),
        label=F.when(status == "F", "NATION").when(status == "P", "  ").otherwise("follows"),
    )
    return merge.separate_labels(t.graph, merge.usable_relations(batch)).select("seq", "label")


ALLOWED = {"CUSTOMER": ["PLACED"], "ORDERS": ["CONTAINS", "PLACED"], "NATION": ["IN_REGION"], "PART": []}


@query("N14", with_(V, E) + """SELECT e.src, e.label, e.dst FROM e JOIN v ON e.src = v.vid WHERE
  (v.label = 'CUSTOMER' AND e.label = 'PLACED') OR (v.label = 'ORDERS' AND e.label IN ('CONTAINS', 'PLACED'))
  OR (v.label = 'NATION' AND e.label = 'IN_REGION')""")
def ontology_filter(t: Tables):
    g = t.graph
    subjects = g.vertices.select("vid", F.col("label").alias("subject_type"))
    return merge.allowed_triples(g.edges, subjects, ALLOWED).select("src", "label", "dst")


@query("N15 V6", with_(TOPIC) + """SELECT vid FROM topic WHERE len(embedding[1:30 + CAST(right(label, 1) AS INT)]) = 35""")
def valid_vectors(t: Tables):
    topics = t.graph.vertices.where(F.col("label").startswith("TOPIC"))
    width = F.lit(30) + F.substr("label", F.lit(7)).cast("int")
    cut = topics.withColumn("embedding", F.slice("embedding", F.lit(1), width))
    return merge.valid_vectors(cut, 35).select("vid")
