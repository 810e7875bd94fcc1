"""Secret scan: candidate strings, and a random forest that removes false positives.

Candidates are long runs of the characters that keys and tokens are made of, and values of
SHORTEST characters or more that are assigned to a secret's name.  Each gets
features: length, shares and transitions of character classes, the share that dictionary words
cover, and hashed words of its path and of the text to its left, without the names that its label
was read from.  A random forest is trained
on labelled findings (a bounded sample: at most MAX_TRAINING of each label, the ones with the
smallest hash) and scores every candidate.

Findings are labelled by ``rule_labels`` where the text itself says so (assigned to a name
such as "token", or plainly words or numbers); any column of 0, 1 and null can be given instead.

Defined cases: a null text has no candidates; a null path has no words; positions are code
points, ends exclusive; texts of any length are scanned whole; findings with equal values train
once, with the smallest of their contexts; without findings of both labels there is no forest: labelled findings keep their label and others score 0; an empty
table gives an empty result; the columns named in ``keep`` may have any names (they come back
inside ``row``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from knotwork.llm.pii import located
from knotwork.session import cut_lineage

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
# Names that a secret is assigned to.
NAME = r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|private[_-]?key|credential)[\"']?\s*+[:=]\s*+"
NAMED = NAME + r"[\"']?$"
NAME_WORDS = ["token", "secret", "password", "passwd", "api", "apikey", "access", "accesskey", "private", "privatekey", "key", "credential"]
SHORTEST = 6
# A value in quotes goes up to the closing one; others end at white space, quotes and separators.
VALUE = rf"(?:\"[^\"\r\n]{{{SHORTEST},}}+(?=\")|'[^'\r\n]{{{SHORTEST},}}+(?=')|[\"']?+[^\s\"'&,;]{{{SHORTEST},}}+)"
# Not a second name ("token: secret: x"); that one has the value.
ASSIGNED = rf"{NAME}(?![\"']?{NAME}){VALUE}"
PLAIN = r"^(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+|[A-Za-z]?[a-z]+(?:[-_/+][A-Za-z]?[a-z]*)+|(.)\1+)$"
MAX_TRAINING = 10_000
TREES, DEPTH, SEED = 24, 6, 7
WORD_BINS, PATH_BINS = 64, 16
SHORTEST_WORD = 4
NUMBERS = ["length", "digits", "uppers", "marks", "distinct", "changes", "clusters", "coverage"]


def candidates(docs: DataFrame, text: str = "text", path: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the ``keep`` columns), path, start, end, value and the text before each candidate."""
    content = F.col(f"`{text}`")
    found = docs.filter(F.rlike(content, F.lit(CANDIDATE)) | F.rlike(content, F.lit(ASSIGNED))).select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{path}`").cast("string").alias("path"),
        F.array_sort(F.concat(_ordered(located(content, CANDIDATE)), _ordered(assigned(content)))).alias("found"))
    # A value found both ways is one candidate.
    return found.select("row", "path", F.explode(F.filter("found", lambda m, i: (i == 0) | (
        F.struct(m["start"], m["end"]) != F.struct(*[F.get("found", i - 1)[c] for c in ("start", "end")])))).alias("m")
    ).select("row", "path", "m.start", "m.end", "m.value", "m.before")


def _ordered(matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(*[m[c].alias(c) for c in ("start", "end", "value", "before")]))


def assigned(text: Column) -> Column:
    """The values assigned to a secret's name, like ``located``; ``before`` ends with the name."""

    def place(m: Column) -> Column:
        front = F.regexp_extract(m["value"], rf"^{NAME}[\"']?", 0)
        value = F.substring(m["value"], F.length(front) + 1, F.length(m["value"]))
        value = F.when(F.rlike(front, F.lit("[\"']$")), value).otherwise(F.rtrim(value, F.lit(".:)]}>")))
        start = m["start"] + F.length(front)
        return F.struct(value.alias("value"), F.concat(m["before"], front).alias("before"), start.alias("start"),
                        (start + F.length(value)).alias("end"))

    return F.filter(F.transform(located(text, ASSIGNED), place), lambda m: F.length(m["value"]) >= SHORTEST)


def rule_labels(value: Column, before: Column) -> Column:
    """1 for a value assigned to a secret's name, 0 for plain words and numbers, else null."""
    mixed = F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))
    return F.when(F.rlike(value, F.lit(PLAIN)), 0).when(F.rlike(before, F.lit(NAMED)) & mixed, 1).cast("int")


def coverage(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(value, covered): the share of each distinct value's characters inside dictionary words.

    Words are looked up by their first letters, so each place of a value is one row whatever
    lengths the dictionary has; a row carries no more of the value than its longest word.
    """
    words = dictionary.select(F.lower("word").alias("word")).filter(F.length("word") >= SHORTEST_WORD).distinct()
    longest = words.agg(F.max(F.length("word"))).first()[0] or SHORTEST_WORD
    lookup = words.groupBy(F.left("word", F.lit(SHORTEST_WORD)).alias("stem")).agg(F.collect_list("word").alias("words"))
    distinct = values.select("value").distinct().withColumn("key", F.unhex(F.md5("value")))
    places = F.sequence(F.lit(1), F.length("value") - SHORTEST_WORD + 1)
    spots = distinct.filter(F.length("value") >= SHORTEST_WORD).select("key", F.explode(F.transform(places, lambda at: F.struct(
        at.alias("at"), F.lower(F.substring(F.col("value"), at, F.lit(longest))).alias("piece")))).alias("s")).select("key", "s.*")
    held = spots.withColumn("stem", F.left("piece", F.lit(SHORTEST_WORD))).join(lookup, "stem")
    size = F.array_max(F.transform("words", lambda w: F.when(F.startswith(F.col("piece"), w), F.length(w))))
    inside = held.withColumn("size", size).filter("size IS NOT NULL").select(
        "key", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("at")).distinct()
    covered = inside.groupBy("key").agg(F.count("*").alias("n"))
    return distinct.join(covered, "key", "left").select(
        "value", (F.coalesce("n", F.lit(0)) / F.length("value")).alias("coverage"))


def features(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``found`` with the columns that the forest reads."""
    value, size = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    changes = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])|(?<=[A-Za-z0-9])(?=[+/_=-])"
    # The name that a label is read from is no feature, or the forest would learn the rule.
    front = F.lower(F.regexp_replace("before", NAMED, ""))
    words = F.slice(F.filter(F.split(front, "[^a-z]+"), lambda w: (w != "") & ~w.isin(NAME_WORDS)), -3, 3)
    names = F.filter(F.split(F.lower(F.coalesce("path", F.lit(""))), "[^a-z]+"), lambda w: w != "")
    return found.join(coverage(found, dictionary), "value").withColumns({
        "length": size.cast("double"), "digits": share("[0-9]"), "uppers": share("[A-Z]"), "marks": share("[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size, "changes": share(changes),
        "clusters": share(r"(?i)(?=[bcdfghjklmnpqrstvwxz]{3})"), "words": words, "names": names,
    })


def train(labelled: DataFrame) -> PipelineModel | None:
    """A forest for features with ``label``; None without findings of both labels."""
    ordered = labelled.filter(F.col("label").isNotNull()).groupBy("value", "label").agg(
        F.min(F.struct("words", "names", *NUMBERS)).alias("least")).select("value", "label", "least.*", F.xxhash64("value").alias("order"))
    samples = [ordered.filter(F.col("label") == x).orderBy("order", "value").limit(MAX_TRAINING) for x in (0, 1)]
    # Bounded and in one order, so that the same findings always give the same forest.
    sample = cut_lineage(samples[0].union(samples[1]).coalesce(1).sortWithinPartitions("order", "label").select(
        *NUMBERS, "words", "names", F.col("label").cast("double").alias("label")))
    if sample.select("label").distinct().count() < 2:
        return None
    return Pipeline(stages=[
        HashingTF(inputCol="words", outputCol="word_bins", numFeatures=WORD_BINS, binary=True),
        HashingTF(inputCol="names", outputCol="name_bins", numFeatures=PATH_BINS, binary=True),
        VectorAssembler(inputCols=[*NUMBERS, "word_bins", "name_bins"], outputCol="features"),
        RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED),
    ]).fit(sample)


def classify(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    """``found`` with ``score``, the forest's probability of a secret."""
    if model is None:
        return found.withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(0.0)))
    return model.transform(found).withColumn("score", vector_to_array("probability")[1])


def scan(
    docs: DataFrame, dictionary: DataFrame, text: str = "text", path: str = "source", keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """row, start, end, value, label, score and secret of every candidate."""
    found = cut_lineage(candidates(docs, text, path, keep))
    found = cut_lineage(features(found.withColumn("label", rule_labels(F.col("value"), F.col("before"))), dictionary))
    return classify(found, train(found)).select(
        "row", "start", "end", "value", "label", F.round("score", 6).alias("score"), (F.col("score") >= 0.5).alias("secret"))


def vocabulary(spark: SparkSession, rank_file: str) -> DataFrame:
    """The plain words of a local rank file as a dictionary: one row per word, as many as the
    vocabulary has at most."""
    import base64

    with open(rank_file, "rb") as file:
        tokens = (base64.b64decode(line.split()[0]).strip() for line in file if line.strip())
        words = sorted({t.decode().lower() for t in tokens if t.isalpha() and t.isascii() and len(t) >= SHORTEST_WORD})
    return spark.createDataFrame([(w,) for w in words], "word string")
