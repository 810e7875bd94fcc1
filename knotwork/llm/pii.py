"""Personal data in texts: base patterns, and contextual extraction bootstrapped from them.

Base entities (e-mail, IP, card, phone) are the seeds.  The words to the left of every
identifier-like token, seed or unknown, are lexical patterns.  Patterns and instances form a
graph that is scored in rounds: a pattern's confidence in a kind is the believed share of its
distinct instances, an unknown instance's belief is the confidence of its best accepted
pattern.  Accepted patterns then mark unknown tokens of the right shape as further spans.

Everything is column expressions and joins.  The expressions of the base patterns never
recurse and never rescan a run of characters, so long texts cost time in proportion.

Defined cases: a null text counts as empty; positions are code points, ends exclusive; base
spans always stay, added ones never overlap them; copies of a text count once as evidence,
because edges of the graph are distinct; an empty table gives an empty result; input columns
may have any names (they come back inside ``row``).
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from knotwork.llm.common import hinted, whole_row
from knotwork.session import cut_lineage

# Classes of characters name each one.  Those with ranges become chains of interface calls in Java,
# whose type checks threads of one JVM wait for, so that more cores would not shorten a scan.
DIGIT = "0123456789"
HOST = f"{string.ascii_letters}{DIGIT}-"
NAME = rf"._%+{HOST}"
SPACE = r"\x20\x09\x0A\x0B\x0C\x0D"
# The base patterns.  Possessive quantifiers match what greedy ones would,
# because what follows a run is never part of it; a run is entered only at its start or
# where the last match ended.
KINDS = {
    "email": rf"(?:\G|(?<![{NAME}]))[{NAME}]++@[{HOST}]++(?:\.[{HOST}]++)++",
    "ip": rf"(?<![{DIGIT}])[{DIGIT}]++\.[{DIGIT}]++\.[{DIGIT}]++\.[{DIGIT}]++",
    "card": rf"[{DIGIT}](?:[\x20-]?[{DIGIT}])++",
    "phone": rf"\+[{DIGIT}][\x20().{DIGIT}-]+[{DIGIT}]",
}
# A kind cannot occur in a text without this.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# Every valid card holds this.
CARD = rf"[{DIGIT}](?:[\x20-]?[{DIGIT}]){{15}}"
# A text without these has neither a seed nor a token.
ANY = rf"[{DIGIT}@]"
# A token that may be an identifier: it holds a digit, an at sign or a masked seed.
TOKEN = rf"(?<![^{SPACE}])[^{SPACE}{DIGIT}@\x01]*+[{DIGIT}@\x01][^{SPACE}]*+"
# Digit groups joined by one space, dot, dash or bracket, of tokens that are too short to be a
# number or address alone.  Where there is no such run, a token stands for itself.
SHORT = rf"(?!(?:[^{SPACE}{DIGIT}]*+[{DIGIT}]){{7}})(?!(?:[^{SPACE}.]*+\.){{3}}[{DIGIT}])"
# What follows a bracketed area code, and a token that is no full number.
LOCAL = SHORT.replace("{7}", "{10}")
RUN = (rf"(?<![^{SPACE}])(?=[(\[{{<\"'+]*+[{DIGIT}]){SHORT}[(\[{{<\"'+]*+[{DIGIT}]++"
       rf"(?:(?:[)\]]\x20{LOCAL}|[)\]]?+(?:\x20{SHORT}|[.-])?+)[(\[]?+[{DIGIT}]++)++"
       rf"[)\]}}>\"'.,;:!?]*+(?![^{SPACE}])")
UNKNOWN = rf"{RUN}|{TOKEN}"
# A bracket that closes inside the number is a part of it.
OPENING, CLOSING = r"^[(\[{<\"']+(?![0-9]++[)\]][\x20.-]?+[0-9])", r"[)\]}>\"'.,;:!?]+$"
CONTEXT = 80
STEP = 256

ROUNDS, MIN_SEEDS, MIN_CONFIDENCE = 3, 5, 0.8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; what a lambda or several places name is
    otherwise worked out for each of them."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return F.rlike(value, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        return _let(digits, lambda d: F.length(d).between(16, 19) & F.call_function("luhn_check", d))
    if kind == "phone":
        return _let(F.length(digits), lambda n: n.between(8, 15))
    return F.lit(True)


def _shape(kind: Column, value: Column) -> Column:
    """Whether an unknown token can be of the kind that its context says."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (
        F.when(kind == "email", F.contains(value, F.lit("@")) & (F.length(value) > 2))
        .when(kind == "ip", F.rlike(value, F.lit(r"^[0-9A-Fa-f]+(?:[.:]+[0-9A-Fa-f]+){3,}$")))
        .when(kind == "card", digits.between(12, 19) & ~F.rlike(value, F.lit("[A-Za-z]")))
        .otherwise(digits.between(7, 15) & ~F.rlike(value, F.lit("[A-Za-z]")))
    )


def _starts(lengths: Column) -> Column:
    """Sums of all lengths before each one.  Two levels keep the copying of arrays short."""

    def running(values: Column, start: Column) -> Column:
        first = F.struct(start.cast("long").alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(values, first, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    def summed(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda acc, x: acc + x))
        return _let(running(sums, F.lit(0)), lambda s: F.flatten(F.transform(blocks, lambda b, i: running(b, F.get(s, i)))))

    def cut(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / STEP).cast("int")
        return _let(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * STEP + 1, F.lit(STEP))), summed)

    return _let(lengths, lambda n: F.when(F.size(n) > 0, cut(n)).otherwise(F.array().cast("array<long>")))


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _pieces(text: Column, pattern: str, body: Callable[[Column, Column], Column], none: Column) -> Column:
    """``body`` of the matches and of the gaps around them; ``none`` for a text without a match."""
    return _let(_matches(text, pattern), lambda values: F.when(
        F.size(values) > 0, _let(F.split(text, pattern, -1), lambda gaps: body(values, gaps))).otherwise(none))


def _front(gap: Column) -> Column:
    return F.substring(gap, -CONTEXT, CONTEXT)


def located(text: Column, pattern: str) -> Column:
    """array<struct<value, before, start, end>> of all matches; ``before`` ends where the match
    starts, begins after the match before it and is cut to its last CONTEXT characters."""

    def placed(values: Column, gaps: Column) -> Column:
        lengths = F.transform(values, lambda v, i: (F.length(v) + F.length(F.get(gaps, i))).cast("long"))

        def place(v: Column, gap: Column, at: Column) -> Column:
            start = at + F.length(gap)
            return F.struct(v.alias("value"), _front(gap).alias("before"), start.alias("start"), (start + F.length(v)).alias("end"))

        return _let(_starts(lengths), lambda at: F.transform(values, lambda v, i: place(v, F.get(gaps, i), F.get(at, i))))

    return _pieces(text, pattern, placed, F.array().cast("array<struct<value:string,before:string,start:bigint,end:bigint>>"))


def preceded(text: Column, pattern: str) -> Column:
    """array<struct<value, before>> of all matches, as ``located`` gives them."""
    return _pieces(text, pattern, lambda values, gaps: F.transform(values, lambda v, i: F.struct(
        v.alias("value"), _front(F.get(gaps, i)).alias("before"))), F.array().cast("array<struct<value:string,before:string>>"))


def _may_hold(text: Column, kind: str) -> Column:
    return F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else F.rlike(text, F.lit(CARD))


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end>>: valid matches by kind in the order of KINDS, then start."""
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    found = []
    for kind, pattern in KINDS.items():
        spans = F.transform(
            F.filter(located(text, pattern), lambda m: _valid(kind, m["value"])),
            lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
        found.append(F.when(_may_hold(text, kind), spans).otherwise(none))
    return F.concat(*found)


def _mask(text: Column, kind: str) -> Column:
    """``text`` with valid matches of a kind as one token of letters each, in which no other
    kind can match."""
    mark = "\x01" + kind[0]

    def seal(v: Column) -> Column:
        name = F.translate(F.md5(v.cast("binary")), "0123456789", "ghijklmnop")
        return F.when(_valid(kind, v), F.concat(F.lit(mark), name, F.lit("\x01"))).otherwise(v)

    def sealed(values: Column, gaps: Column) -> Column:
        return F.array_join(F.transform(gaps, lambda g, i: F.concat(
            g, F.when(i < F.size(values), seal(F.get(values, i))).otherwise(F.lit("")))), "")

    return F.when(_may_hold(text, kind), _pieces(text, KINDS[kind], sealed, text)).otherwise(text)


def _tidy(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, OPENING, ""), CLOSING, "")


def _patterns(before: Column) -> Column:
    """The last word before a token and the last two, in lower case, digits masked."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(before), r"\x01(.)[^\x01]*\x01", "<$1>"), "[0-9]+", "#")

    def ends(words: Column) -> Column:
        last, two = F.element_at(words, -1), F.array_join(F.slice(words, -2, 2), " ")
        return F.when(F.size(words) == 1, F.array(last)).when(F.size(words) > 1, F.array(last, two)).otherwise(
            F.array().cast("array<string>"))

    return _let(F.filter(F.split(plain, rf"[{SPACE}]+"), lambda w: w != ""), ends)


def _extended(matches: Column, *names: str) -> Column:
    """Matches, with the fields ``names``, whose ``before`` is extended by the match in front of it."""
    return F.transform(matches, lambda m, i: F.struct(
        *[m[n].alias(n) for n in names],
        F.concat(F.when(i > 0, F.element_at(matches, F.greatest(i, F.lit(1)))["value"]).otherwise(F.lit("")), m["before"]).alias("before")))


def edges(texts: DataFrame) -> DataFrame:
    """Distinct (pattern, instance, kind) of a table with ``text``; kind is null where unknown.
    Only patterns with MIN_SEEDS instances or more can matter; the others are left out."""
    masked = texts.filter(F.rlike("text", F.lit(ANY)))
    for kind in KINDS:
        masked = masked.select(_mask(F.col("text"), kind).alias("text"))
    tokens = masked.select(preceded(F.col("text"), UNKNOWN).alias("found")).select(
        F.explode(_extended(F.col("found"), "value")).alias("m"))
    seed = F.regexp_extract(F.col("m.value"), r"\x01([a-z])[a-p]{32}\x01", 1)
    kind = F.element_at(F.create_map(*[x for k in KINDS for x in (F.lit(k[0]), F.lit(k))]), seed)
    graph = cut_lineage(
        tokens.select(F.explode(_patterns(F.col("m.before"))).alias("pattern"), kind.alias("kind"),
                      F.lower(_tidy(F.col("m.value"))).alias("instance")).distinct()
    )
    rich = cut_lineage(graph.groupBy("pattern").agg(F.count("*").alias("held")).filter(F.col("held") >= MIN_SEEDS).select("pattern"))
    return graph.join(hinted(rich, rich.count()), "pattern", "left_semi")


def learn(texts: DataFrame) -> DataFrame:
    """Accepted (pattern, kind, confidence), scored in ROUNDS rounds over the graph.  In each a
    pattern needs MIN_SEEDS seeds and believed instances."""
    graph = cut_lineage(edges(texts))
    total = cut_lineage(graph.groupBy("pattern").agg(F.count("*").alias("total")))
    known = graph.filter(F.col("kind").isNotNull())
    seeds = cut_lineage(known.groupBy("pattern", "kind").agg(F.count("*").alias("seeds")))
    unknown = graph.filter(F.col("kind").isNull()).select("pattern", "instance")
    beliefs, accepted = None, None
    for _ in range(ROUNDS):
        scored = seeds
        if beliefs is not None:
            gained = unknown.join(hinted(beliefs, beliefs.count()), "instance").groupBy("pattern", "kind").agg(
                F.sum("belief").alias("gained"), F.count("*").alias("believed"))
            scored = scored.join(gained, ["pattern", "kind"], "full").fillna(0)
        else:
            scored = scored.withColumns({"gained": F.lit(0.0), "believed": F.lit(0)})
        scored = scored.filter(F.col("seeds") + F.col("believed") >= MIN_SEEDS).join(total, "pattern")
        confidence = (F.col("seeds") + F.col("gained")) / (F.col("total") + 1)
        accepted = cut_lineage(scored.select("pattern", "kind", F.round(confidence, 9).alias("confidence")).filter(
            F.col("confidence") >= MIN_CONFIDENCE))
        beliefs = cut_lineage(
            unknown.join(hinted(accepted, accepted.count()), "pattern")
            .filter(_shape(F.col("kind"), F.col("instance")))
            .groupBy("instance", "kind").agg(F.max("confidence").alias("belief")))
    return accepted


def discovered(texts: DataFrame, accepted: DataFrame) -> DataFrame:
    """(key, added): spans that accepted patterns find in the texts of (key, text)."""
    candidates = texts.filter(F.rlike("text", F.lit(ANY))).select(
        "key", base_spans(F.col("text")).alias("base"), located(F.col("text"), UNKNOWN).alias("found"))
    tokens = candidates.select("key", "base", F.explode(_extended(F.col("found"), "value", "start", "end")).alias("m")).select(
        "key", "base", "m", F.explode(_patterns(F.col("m.before"))).alias("pattern"))
    hits = tokens.join(hinted(accepted, accepted.count()), "pattern")
    value = F.col("m.value")
    front = F.length(value) - F.length(F.regexp_replace(value, OPENING, ""))
    placed = hits.withColumn("value", _tidy(value)).withColumn("start", F.col("m.start") + front).withColumn(
        "end", F.col("start") + F.length("value"))
    free = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    best = placed.filter(_shape(F.col("kind"), F.col("value")) & free).groupBy("key", "start", "end").agg(
        F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    return best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("added"))


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each input row as ``row`` with ``text`` and the arrays ``base`` and ``added`` of
    struct<kind, start, end>, each by kind, then start."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(content.alias("text"))
    accepted = learn(texts)
    rows = docs.select(whole_row(docs), content.alias("text"), F.md5(content.cast("binary")).alias("key"))
    if accepted.isEmpty():
        found = rows.withColumn("added", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"))
    else:
        added = cut_lineage(discovered(rows.select("key", "text"), accepted))
        found = rows.join(hinted(added, added.count()), "key", "left")
    by_kind = [
        F.transform(F.filter(F.coalesce("added", F.array()), lambda s: s["kind"] == kind), lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        for kind in KINDS
    ]
    return found.select("row", "text", base_spans(F.col("text")).alias("base"), F.concat(*by_kind).alias("added"))


def in_order(spans: Column) -> Column:
    """Spans by kind in the order of KINDS, then start."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(spans, lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("k"), s["start"], s["end"], s["kind"]))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def as_text(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat(
        s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first
    gives the name and the rest of the others goes with it."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # The furthest end so far, and the piece between it and the next span.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        new = F.concat(gap, F.when(s["start"] >= acc["at"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(new)).alias("out"))

    joined = F.aggregate(ordered, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, joined).otherwise(text)
