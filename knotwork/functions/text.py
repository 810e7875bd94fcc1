"""Entity-name and label rules as Column expressions (no Python per row)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values ---------------------------------------------------------------

# Characters removed from both ends of names and labels.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Name endings that are dropped when more than two characters remain.
COMPANY_SUFFIXES = [
    "Software", "Inc", "Inc.", "Corp", "Corp.", "Ltd", "Ltd.", "LLC", "Company", "Co.",
]

# Substrings that decide the type of an unlabelled entity, in order of precedence.
ORGANIZATION_SUFFIXES = [
    "corp", "inc", "ltd", "llc", "company", "co", "corporation",
    "software", "systems", "technologies", "solutions", "group",
]
ORGANIZATION_WORDS = [
    "agency", "administration", "foundation", "institute", "university",
    "organization", "association", "consortium", "alliance",
]
TECHNOLOGY_WORDS = [
    "specification", "standard", "protocol", "api", "system",
    "platform", "framework", "language", "suite", "service",
]
PROJECT_WORDS = ["project", "program", "initiative"]
LOCATION_WORDS = ["city", "state", "country", "region", "district", "county"]

# Typographic characters stored as plain ones; the em dash becomes two hyphens.
FOLDED_FROM = "\u2013\u2018\u2019\u201c\u201d"
FOLDED_TO = "-''\"\""
EM_DASH = "\u2014"

BASE_ENTITY = "Entity"
TEXT_CHUNK = "TextChunk"
MENTIONS = "MENTIONS"

# -----------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (plain ``trim`` keeps tabs and newlines)."""
    return F.trim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def fold_punctuation(c: Column) -> Column:
    """Store curly quotes and long dashes as their plain forms."""
    return F.replace(F.translate(c, FOLDED_FROM, FOLDED_TO), F.lit(EM_DASH), F.lit("--"))


def fold_literal(value: str) -> str:
    """``fold_punctuation`` for a value that is compared with stored text."""
    return str(value).translate(str.maketrans(FOLDED_FROM, FOLDED_TO)).replace(EM_DASH, "--")


def _ending() -> str:
    """At least three characters, then one company suffix at the very end."""
    blank, solid = r"[\s\x1c-\x1f]", r"[^\s\x1c-\x1f]"
    suffix = "|".join(x.replace(".", r"\.") for x in COMPANY_SUFFIXES)
    return rf"(?Us)\A({solid}.+{solid}){blank}* (?:{suffix})\z"


def without_metadata(name: Column) -> Column:
    """The trimmed name without a trailing ``({...})``."""
    return strip(F.regexp_replace(strip(name), r"(?U)\s*\(\{[^}]+\}\)\z", ""))


def normalize_name(name: Column) -> Column:
    """Entity identity: trimmed, without metadata, and without one company suffix if
    more than two characters remain."""
    return F.regexp_replace(without_metadata(name), _ending(), "$1")


def has_any(text: Column, words: list[str]) -> Column:
    """Whether a text contains one of several words.

    Plain substring tests are several times faster here than one regular expression
    of alternatives; words that contain another word of the list need no test.
    """
    needed = [w for w in words if not any(v != w and v in w for v in words)]
    return reduce(Column.__or__, [text.contains(w) for w in needed])


def classify_name(name: Column) -> Column:
    """Type of an entity that carries no usable label, by substrings of its name."""
    lowered = F.lower(name)
    shouted = (F.upper(name) == name) & (lowered != name) & (F.length(name) >= 2)
    one_word = (strip(name) != "") & ~strip(name).rlike(r"(?U)\s")
    several_words = strip(name).rlike(r"(?U)\S\s+\S")
    return (
        F.when(has_any(lowered, ORGANIZATION_SUFFIXES + ORGANIZATION_WORDS), "ORGANIZATION")
        .when(shouted & one_word, "ORGANIZATION")
        .when(has_any(lowered, TECHNOLOGY_WORDS), "TECHNOLOGY")
        .when(has_any(lowered, PROJECT_WORDS) & several_words, "PROJECT")
        .when(has_any(lowered, LOCATION_WORDS), "LOCATION")
        .otherwise(BASE_ENTITY)
    )


def canonical_label(label: Column) -> Column:
    """Upper-cased label with underscores, or NULL when it is not alphanumeric."""
    upper = F.translate(F.upper(strip(label)), " -", "__")
    letters = F.replace(upper, F.lit("_"), F.lit(""))
    return F.when(letters.rlike(r"\A[\p{L}\p{N}]+\z"), upper)


def entity_label(label: Column, name: Column) -> Column:
    """Given label first, name pattern second, the base type last."""
    return F.coalesce(canonical_label(label), classify_name(name))


def relation_name(relation: Column) -> Column:
    """Relation spelling of the triple store."""
    return F.upper(F.replace(relation, F.lit(" "), F.lit("_")))
