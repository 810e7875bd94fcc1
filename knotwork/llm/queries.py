"""One query for each operator over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from knotwork.llm import (
    bpe, jaccard, langid, mixing, pii, quality, runs, secrets, toxicity, vptree, warc, whitening,
    windows,
)
from knotwork.llm.common import WORD, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def rank_file() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_digests(spark: SparkSession, docs: DataFrame, ids: bool = False) -> DataFrame:
    """Per document the number of ids, their digest and that of the decoded bytes, and the ids."""
    _, _, round_trip = bpe.coder(spark, *rank_file())
    coded = docs.select("doc_id", round_trip(F.coalesce("text", F.lit(""))).alias("coded"))
    return coded.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        bpe.digest(F.col("coded.ids")).alias("ids_sha256"),
        F.sha2("coded.raw", 256).alias("decoded_sha256"), *([F.col("coded.ids").alias("ids")] if ids else []),
    )


@query
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(spark, read(spark, folder, "documents"))


@query
def op6_entropy_balancing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken", "rate", "copies")


ORACLES["op5_line_frequency"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text IS NULL AS missing, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
grams AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
inside AS (SELECT rid, unnest(range(i, i + 5)) AS pos
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
again AS (SELECT rid, count(DISTINCT pos) AS n FROM inside GROUP BY rid),
lines AS (SELECT rid, source, text, missing, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT rid, sum(c - 1) AS n FROM (SELECT rid, line, count(*) AS c FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line) GROUP BY rid),
norm AS (SELECT rid, source, text, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
  len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines WHERE NOT missing),
held AS (SELECT source, line, count(DISTINCT text) AS c FROM norm WHERE line <> '' GROUP BY source, line),
hosts AS (SELECT source, count(DISTINCT text) AS c FROM d WHERE NOT missing GROUP BY source),
common AS (SELECT held.source, line FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
  WHERE held.c > 20 AND held.c > 0.1 * hosts.c),
lost AS (SELECT rid, sum(words) AS n FROM norm JOIN common
  ON norm.line = common.line AND norm.source IS NOT DISTINCT FROM common.source GROUP BY rid),
base AS (SELECT d.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(w) - coalesce(lost.n, 0) AS BIGINT) AS n_words_left
  FROM d JOIN w ON w.rid = d.rid LEFT JOIN dup ON dup.rid = d.rid LEFT JOIN again ON again.rid = d.rid LEFT JOIN lost ON lost.rid = d.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words_left,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words_left >= 10 AS kept
FROM base"""


@query
def op5_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rules(read(spark, folder, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_words_left",
    )


@query
def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(read(spark, folder, "documents"))


@query
def op1_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.detect(read(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    everything = F.when(F.size("added") > 0, pii.in_order(F.concat("base", "added"))).otherwise(F.col("base"))
    return found.select(
        "row.doc_id", *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.as_text(everything).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


@query
def op10_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = F.coalesce(langid.fold(F.col("doc_id")) == 0, F.lit(False))
    languages, model = langid.train(docs.filter(~held_out).select("lang", "text"))
    found = langid.predict(docs, languages, model)
    return found.select(
        "row.doc_id", F.coalesce(langid.fold(F.col("row.doc_id")) == 0, F.lit(False)).alias("held_out"),
        F.col("mixture.lang").alias("lang_pred"), "mixture.score", F.array_join("mixture.langs", ",").alias("langs"),
    )


@query
def op9_vantage_points(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
    found = vptree.search(vectors, vectors.filter(F.col("id") % 100 == 0), k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op3_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    made = warc.page_records(read(spark, folder, "pages"))
    return made.select("row.page_id", *[f.name for f in warc.RECORD])


@query
def op4_compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    return windows.repeated(read(spark, folder, "documents"))


@query
def op8_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(read(spark, folder, "documents"), secrets.vocabulary(spark, rank_file()[0]))
    return found.select("row.doc_id", "start", "end", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
                        "label", "score", "secret")


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in texts whose id hashes to a multiple of 10, the words from some place
    on repeat a stretch of that text.  No lambda: the words are found once, not for each word."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    seed = F.floor(hashed / 10)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    picked = docs.select("doc_id", "text", F.when(hashed % 10 == 0, words).alias("words"), seed.alias("g"))
    picked = picked.withColumn("n", F.size("words")).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    picked = picked.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    left = F.col("n") - F.col("a")
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.flatten(F.array_repeat(period, F.ceil(left / F.col("p")).cast("int")))
    changed = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), left))
    return picked.select(
        "doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.collapse(planted_periods(read(spark, folder, "documents")))
    # Exponents are compared as exact fractions: length * other's period.
    best = F.expr("""aggregate(found.runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),
        (b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))""")
    lines = F.transform("found.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    joined = F.concat(F.array_join(lines, "\n"), F.when(F.size(lines) > 0, "\n").otherwise(""))
    return found.select("row.doc_id", "found", best.alias("best"), joined.alias("listed")).select(
        "doc_id", F.size("found.runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, components=8).select(
        "row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


@query
def op11_toxic_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")

    def held_out(doc_id: str):
        return F.coalesce(langid.fold(F.col(doc_id)) == 0, F.lit(False))

    lexicon = toxicity.train(docs.filter(~held_out("doc_id")), read(spark, folder, "labels"))
    return toxicity.score(docs, lexicon).select(
        "row.doc_id", held_out("row.doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("hits").cast("long").alias("n_hits"), F.round("weight", 6).alias("weight"))
