"""Toxicity scores from a weighted lexicon.

Text is folded character by character: lower case, compatibility forms (full-width, styled
letters), look-alike letters of other scripts, and digits or signs that stand for letters
inside a word.  ``i`` and ``l`` are one letter, because ``1``, ``|`` and ``!`` stand for both.
Folding keeps the length, so places in the folded text are places in the text.

The lexicon holds words and stems (the first letters of a word).  Their weights are smoothed
logarithms of how much more often toxic training texts hold them than clean ones; a term
stays when the likelihood ratio is beyond what the best of so many terms would reach by
chance.  One Aho-Corasick automaton finds all terms and all exception phrases in one pass; a
term counts at the start of a word (a whole word also has to end there), once for each word
with its largest weight, and not at all inside an exception phrase.  Exceptions are given, or
learned: a term with the word before or after it that clean texts hold and toxic ones do not.

The weights that a text's words add up to are divided by its length, and a logistic curve over
both, fitted on the training texts, gives the score; it never falls as weight is added.

Bounds: MAX_TERMS and MAX_PHRASES, by significance, so that lexicon and automaton can be sent
to every task; counts and the curve are over all training texts.

Defined cases: a null, empty or blank text has no hit and the score of no hits; a training
text counts once however many copies of it there are, with its most frequent label (toxic if
even), and several labels of one id count as their mean; rows without a text, id or label are
not learned from; without a toxic or a clean training
text every score is the smoothed share of toxic ones; texts of any length are used whole;
repeated rows get equal results; an empty table gives an empty result; input columns may have
any names, because rows come back inside ``row``.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from knotwork.llm.common import whole_row
from knotwork.operators.sizes import fits_memory, mark
from knotwork.session import cut_lineage

# Letters of other scripts that look like Latin ones, and what they look like.
LOOK_ALIKES = dict(zip(
    "авсԁеһіјкӏмнопрԛѕтухѵѡАВСЕНІЈКМОРЅТУХαβεηικνορτυχωɑɡıℓօսո",
    "abcdehijkimhonpqstyxvwabcehijkmopstyxabenikvoptuxwagiioun",
))
# Digits and signs that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
               "!": "i", "|": "i"}
# Harmless phrases with words that are often insults.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "pond scum", "soap scum", "clown fish", "class clown", "sore loser")

STEMS = range(4, 9)
LONGEST_TERM = 32
MIN_TEXTS, MAX_TERMS, MAX_PHRASES = 4, 20_000, 1_000
SMOOTHING = 0.5
# Terms that a task counts before it passes the counts on.
HELD_TERMS = 1 << 18

_WORD = re.compile(r"[^\W_]+")
_SUBSTITUTE = re.compile("[" + re.escape("".join(SUBSTITUTES)) + "]")
_SIGNS = "@$!|"
_RUN = re.compile(rf"(?:[^\W_]|[{_SIGNS}])+")

HIT = StructType([
    StructField("start", LongType()), StructField("end", LongType()), StructField("term", StringType()),
    StructField("weight", DoubleType()), StructField("before", StringType()), StructField("after", StringType()),
])
MATCHED = StructType([StructField("n_words", LongType()), StructField("hits", ArrayType(HIT))])


class _Letters(dict):
    """Folded form of a character, found when it is first met."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = LOOK_ALIKES.get(char)
        if plain is None:
            plain = unicodedata.normalize("NFKC", char).lower()
            plain = LOOK_ALIKES.get(plain, plain)
            plain = plain if len(plain) == 1 else char
        plain = "i" if plain == "l" else plain
        self[code] = plain
        return plain


_LETTERS = _Letters()


def _undisguised(run: str) -> str:
    """A run of letters, digits and signs, its digits and signs replaced if it has a letter.
    Signs around it stay, but for a dollar sign, which no sentence ends with."""
    core = run.lstrip("@!|").rstrip("@!|")
    if not any(c.isalpha() for c in core):
        return run
    at = run.index(core)
    return run[:at] + "".join([SUBSTITUTES.get(c, c) for c in core]) + run[at + len(core):]


def fold_text(text: str) -> str:
    """Folded text, character for character."""
    folded = text.translate(_LETTERS)
    parts, done = [], 0
    for found in _SUBSTITUTE.finditer(folded):
        begin = found.start()
        if begin < done:
            continue
        # Back to the start of the run, which reaches no further than the last one.
        while begin > done and (folded[begin - 1].isalnum() or folded[begin - 1] in _SIGNS):
            begin -= 1
        run = _RUN.match(folded, begin)
        parts += [folded[done:begin], _undisguised(run.group())]
        done = run.end()
    return "".join([*parts, folded[done:]]) if parts else folded


def terms_of(text: str) -> set[str]:
    """The words of a text as ``=word`` and their stems, as far as they may be terms."""
    words = {w for w in _WORD.findall(fold_text(text)) if 2 < len(w)}
    found = {w[:size] for w in words for size in STEMS if len(w) >= size}
    return found.union("=" + w for w in words if len(w) <= LONGEST_TERM)


@dataclass
class Lexicon:
    """Weights of words (``=word``) and stems, exception phrases, and the curve of the score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: Sequence[str] = EXCEPTIONS
    intercept: float = 0.0
    slopes: tuple[float, float] = (0.0, 0.0)


def automaton(lexicon: Lexicon):
    """The terms and exception phrases as one Aho-Corasick automaton."""
    import ahocorasick

    found: dict[str, list] = {}
    for term, weight in lexicon.weights.items():
        whole = term.startswith("=")
        # A key may be a whole word and a stem: (weight as a whole word, weight as a stem, exception).
        entry = found.setdefault(fold_text(term.removeprefix("=")), [0.0, 0.0, False])
        entry[0 if whole else 1] = max(entry[0 if whole else 1], weight)
    for phrase in lexicon.exceptions:
        key = " ".join(_WORD.findall(fold_text(phrase)))
        if key:
            found.setdefault(key, [0.0, 0.0, False])[2] = True
    built = ahocorasick.Automaton()
    for key, (whole, stem, exception) in found.items():
        built.add_word(key, (len(key), whole, stem, exception, key))
    built.make_automaton()
    return built


def hits_of(text: str, built) -> tuple[int, list[tuple]]:
    """(number of words, hits) of a text: the heaviest term of each word, outside exceptions."""
    folded = fold_text(text)
    spans = [m.span() for m in _WORD.finditer(folded)]
    if not spans or not len(built):
        return len(spans), []
    ends = dict(spans)
    # The words with one space between, so that phrases match over any white space or marks.
    places, at = [], 0
    for begin, end in spans:
        places.append(at)
        at += end - begin + 1
    joined = " ".join([folded[a:b] for a, b in spans])
    order = {place: i for i, place in enumerate(places)}
    best: dict[int, tuple[float, str]] = {}
    excepted: set[int] = set()
    size = len(joined)
    for last, (length, whole, stem, exception, key) in built.iter(joined):
        i = order.get(last - length + 1)
        if i is None:
            continue
        ended = last + 1 == size or joined[last + 1] == " "
        weight = max(whole, stem) if ended else stem
        if weight and weight > best.get(i, (0.0, ""))[0]:
            best[i] = (weight, key)
        if exception and ended:
            excepted.update(range(i, i + key.count(" ") + 1))
    out = []
    for i in sorted(best):
        if i not in excepted:
            begin, end = spans[i]
            word = folded[begin:end]
            before = f"{folded[slice(*spans[i - 1])]} {word}" if i else None
            after = f"{word} {folded[slice(*spans[i + 1])]}" if i + 1 < len(spans) else None
            out.append((begin, ends[begin], best[i][1], best[i][0], before, after))
    return len(spans), out


def matched(rows: DataFrame, lexicon: Lexicon, text: str, around: bool = False) -> Column:
    """Words and hits of a text as a column; ``around`` keeps the phrases around a hit."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        built = automaton(shared.value)
        for batch in batches:
            for start in range(0, len(batch), 256):
                counts, offsets, hits = [], [0], []
                for value in batch.slice(start, 256):
                    n, found = hits_of(value.as_py() or "", built)
                    counts.append(n)
                    hits += found if around else [(*h[:4], None, None) for h in found]
                    offsets.append(len(hits))
                columns = list(zip(*hits)) if hits else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string(), pa.string()]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds)], HIT.names))
                yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), lists], MATCHED.names)
        pa.default_memory_pool().release_unused()

    # Marked so that Catalyst runs it once for all of its fields.
    return F.arrow_udf(run, MATCHED).asNondeterministic()(F.col(text))


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, toxic, clean): training texts of each kind that hold a term.  A task passes on
    counts, not texts, whenever it holds HELD_TERMS of them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            toxic, clean = zip(*counts.values())
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts)), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())], ["term", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                for term in terms_of(text.as_py()):
                    entry = counts.get(term)
                    if entry is None:
                        entry = counts[term] = [0, 0]
                    entry[not toxic] += 1
                if len(counts) > HELD_TERMS:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    parts = texts.select("text", "toxic").mapInArrow(partial, "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def weights(texts: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """The significant terms and their weights, MAX_TERMS at most."""
    tried = cut_lineage(term_counts(texts).filter(F.col("toxic") >= MIN_TEXTS))
    number = tried.count()
    share_toxic = (F.col("toxic") + SMOOTHING) / (n_toxic + 2 * SMOOTHING)
    share_clean = (F.col("clean") + SMOOTHING) / (n_clean + 2 * SMOOTHING)
    both = (F.col("toxic") + F.col("clean") + 2 * SMOOTHING) / (n_toxic + n_clean + 4 * SMOOTHING)

    def part(k: Column, n: int, share: Column) -> Column:
        return k * F.log(share / both) + (n - k) * F.log((1 - share) / (1 - both))

    gain = part(F.col("toxic"), n_toxic, share_toxic) + part(F.col("clean"), n_clean, share_clean)
    # Half a chi-square value: beyond log(number of terms) only by one chance in a hundred.
    judged = tried.select("term", F.log(share_toxic / share_clean).alias("weight"), gain.alias("gain"))
    kept = judged.filter((F.col("weight") > 1) & (F.col("gain") > F.log(F.lit(100.0 * number + 1))))
    return {r.term: r.weight for r in kept.orderBy(F.desc("gain"), "term").limit(MAX_TERMS).collect()}


def learned_exceptions(found: DataFrame) -> list[str]:
    """Phrases around hits that clean training texts hold and toxic ones do not."""
    phrases = found.select("toxic", F.explode(F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.array(h["before"], h["after"]))))).alias("phrase")).filter("phrase IS NOT NULL")
    counts = phrases.groupBy("phrase").agg(F.sum(F.col("toxic").cast("int")).alias("toxic"), F.count("*").alias("texts"))
    safe = counts.filter((F.col("toxic") == 0) & (F.col("texts") >= MIN_TEXTS))
    return [r.phrase for r in safe.orderBy(F.desc("texts"), "phrase").limit(MAX_PHRASES).collect()]


def features(weight: Column, n_words: Column) -> list[Column]:
    """Weight per hundred words, and in all, both on a logarithmic scale."""
    return [F.log1p(100 * weight / (n_words + 20)), F.log1p(weight)]


def _weight(hits: str, exceptions: Sequence[str] = ()) -> Column:
    safe = F.array(*[F.lit(p) for p in exceptions]).cast("array<string>")

    def add(total: Column, h: Column) -> Column:
        inside = F.array_contains(safe, h["before"]) | F.array_contains(safe, h["after"])
        return total + F.when(F.coalesce(inside, F.lit(False)), 0.0).otherwise(h["weight"])

    return F.aggregate(hits, F.lit(0.0), add if exceptions else (lambda total, h: total + h["weight"]))


def distinct_texts(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str) -> tuple[DataFrame, int, int]:
    """The labelled texts as (text, toxic), each once, and how many are toxic and clean.

    Labels, hashes and ids decide which row stands for a text; texts join what was chosen where
    they are, without a shuffle, when that was measured to fit in memory.
    """
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("double").alias("toxic")).filter(
        "id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.avg("toxic").alias("toxic"))
    content = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(content).alias("key"), F.length(content).alias("size"),
                       content.alias("text")).filter(F.col("text").isNotNull())
    held = rows.drop("text").join(known, "id").groupBy("key", "size", "id").agg(F.count("*").alias("n"), F.first("toxic").alias("toxic"))
    chosen = cut_lineage(held.groupBy("key", "size").agg(
        F.min("id").alias("id"), F.min_by("n", "id").alias("n"), (F.sum(F.col("toxic") * F.col("n")) >= 0.5 * F.sum("n")).alias("toxic")))
    counts = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    fits = fits_memory(chosen)
    texts = rows.join(mark(chosen, fits), ["id", "key", "size"])
    again = texts.filter("n > 1").dropDuplicates(["key", "size"])  # rows repeated with their id
    texts = texts.filter("n = 1").unionByName(again).select("text", "toxic")
    return texts if fits else cut_lineage(texts), counts.get(True, 0), counts.get(False, 0)


def train(docs: DataFrame, labels: DataFrame, exceptions: Sequence[str] = EXCEPTIONS, text: str = "text",
          doc_id: str = "doc_id", label: str = "toxic") -> Lexicon:
    """A lexicon from the documents whose id has a label: a number, 1 for toxic."""
    texts, n_toxic, n_clean = distinct_texts(docs, labels, text, doc_id, label)
    if not n_toxic or not n_clean:
        share = (n_toxic + SMOOTHING) / (n_toxic + n_clean + 2 * SMOOTHING)
        return Lexicon({}, tuple(exceptions), _logit(share))
    lexicon = Lexicon(weights(texts, n_toxic, n_clean), tuple(exceptions))
    found = texts.select("toxic", matched(texts, lexicon, "text", around=True).alias("m")).select("toxic", "m.n_words", "m.hits")
    found = cut_lineage(found)
    learned = learned_exceptions(found)
    lexicon.exceptions = (*lexicon.exceptions, *learned)
    total = _weight("hits", learned)
    # A grid over both features with the mean of its cells: its size does not grow with the texts.
    x = features(F.col("w"), F.col("n_words"))
    cells = [F.round(32 * c).cast("int") for c in x]
    points = found.select(F.col("toxic").cast("double").alias("label"), total.alias("w"), "n_words").groupBy(
        "label", *cells).agg(F.count("*").cast("double").alias("times"), F.avg(x[0]).alias("x0"), F.avg(x[1]).alias("x1"))
    points = cut_lineage(points.select("label", "times", array_to_vector(F.array("x0", "x1")).alias("x")).coalesce(4))
    fitted = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="times", regParam=1e-3, maxIter=50, standardization=False,
        lowerBoundsOnCoefficients=Matrices.dense(1, 2, [0.0, 0.0]),
    ).fit(points)
    lexicon.intercept, lexicon.slopes = float(fitted.intercept), tuple(float(c) for c in fitted.coefficients)
    return lexicon


def _logit(share: float) -> float:
    import math

    return math.log(share / (1 - share))


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Each input row as ``row`` with n_words, hits (start, end in characters, term, weight),
    weight and score."""
    found = docs.select(whole_row(docs), matched(docs, lexicon, f"`{text}`").alias("m")).select(
        "row", "m.n_words", F.transform("m.hits", lambda h: F.struct(
            h["start"].alias("start"), h["end"].alias("end"), h["term"].alias("term"), h["weight"].alias("weight"))
        ).alias("hits"), _weight("m.hits").alias("weight"))
    curve = F.lit(lexicon.intercept)
    for slope, x in zip(lexicon.slopes, features(F.col("weight"), F.col("n_words"))):
        curve = curve + F.lit(slope) * x
    return found.select("row", "n_words", "hits", "weight", (1 / (1 + F.exp(-curve))).alias("score"))
