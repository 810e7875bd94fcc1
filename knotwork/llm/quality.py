"""Quality rules: base statistics of a text, and cross-document line frequency per host.

A document's lines are normalised (lower case, white space collapsed) and hashed.  For each
host the distinct documents (copies of a text count once) that hold a line are counted; a
line is boilerplate when it is in more than ``max(min_documents, max_share * documents of
the host)`` of them.  Boilerplate lines are removed, and a document that is left with fewer
than ``min_words`` words is depleted and rejected, as is one that fails the base rules.

Defined cases: a null or empty text has no words and fails the base rules; a null host is a
host of its own; repeated rows get equal verdicts; lines without a word are ignored; an
empty table gives an empty result; input columns may have any names (they come back inside
``row``).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from knotwork.llm.common import WORD, hinted, in_slices, whole_row
from knotwork.session import cut_lineage

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


def _repeat_words(words: list[bytes]) -> int:
    """Words inside the windows of five that are in the text twice or more."""
    import numpy as np

    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    size = len(number)
    if size ** WINDOW < 2**63:
        keys = ids[:n].copy()
        for i in range(1, WINDOW):
            keys = keys * size + ids[i:i + n]
    else:
        # Number the pairs and the triples first, so that keys stay exact.
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        triples = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True)[1]
        keys = triples[:n] * (int(pairs.max()) + 1) + pairs[3:3 + n]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    repeated = np.zeros(n, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    starts = np.flatnonzero(repeated)
    if not len(starts):
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(covered)[:-1]))


def _duplicate_lines(text: bytes) -> int:
    seen, repeats = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeats += 1
        elif line.strip(SPACES):
            seen.add(line)
    return repeats


def _base_statistics(texts: pa.Array) -> pa.Array:
    """Words, their code points, symbols, duplicate lines and repeated words of each text."""
    import numpy as np

    kinds = np.zeros(256, np.uint8)  # 1 a code point of a word, 2 one that is a symbol too
    kinds[[b for b in range(256) if b & 0xC0 != 0x80 and b not in SPACES]] = 1
    kinds[list(SYMBOLS)] = 2
    rows = []
    for text in texts.cast(pa.binary()):
        text = text.as_py() or b""
        found = np.bincount(kinds[np.frombuffer(text, np.uint8)], minlength=3)
        words = text.split()
        rows.append((len(words), int(found[1] + found[2]), int(found[2]), _duplicate_lines(text), _repeat_words(words)))
    columns = zip(*rows) if rows else [[]] * len(BASE)
    return pa.StructArray.from_arrays([pa.array(list(c), pa.int64()) for c in columns], list(BASE))


# Marked so that Catalyst runs it once: a deterministic one would be copied into filters on
# the verdict.
base_statistics = F.arrow_udf(
    in_slices(_base_statistics), StructType([StructField(name, LongType()) for name in BASE])).asNondeterministic()


def normal_lines(text: Column) -> Column:
    """The lines of a text in lower case, white space collapsed and trimmed."""
    plain = F.translate(F.lower(text), "\t\x0b\x0c\r", "    ")

    def tidy(line: Column) -> Column:
        line = F.trim(line)
        return F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line)

    return F.transform(F.split(plain, "\n"), tidy)


def _host(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("h"), column.cast("string")), F.lit(""))


def boilerplate(docs: DataFrame, text: str, host: str, min_documents: int, max_share: float) -> DataFrame:
    """(host, lines): hashes of the lines above the limits, one row per host that has some.

    Equal (host, line, text) rows are reduced first, so a line held by a third of all
    documents is counted in many tasks.  A host's list is bounded: each of its lines is in
    more than ``max_share`` of the documents, so the list is no longer than ``1 / max_share``
    documents of mean length.
    """
    texts = docs.select(
        _host(F.col(f"`{host}`")).alias("host"), F.xxhash64(f"`{text}`").alias("doc"), F.col(f"`{text}`").alias("text")
    ).filter(F.col("text").isNotNull())
    lines = texts.select("host", "doc", F.explode(normal_lines(F.col("text"))).alias("line")).filter("line != ''")
    found = (
        lines.select("host", F.xxhash64("line").alias("line"), "doc").distinct()
        .groupBy("host", "line").agg(F.count("*").alias("found")).filter(F.col("found") > min_documents)
    )
    documents = texts.select("host", "doc").distinct().groupBy("host").agg(F.count("*").alias("documents"))
    return (
        found.join(documents, "host").filter(F.col("found") > F.col("documents") * max_share)
        .groupBy("host").agg(F.collect_list("line").alias("lines"))
    )


def rules(
    docs: DataFrame, text: str = "text", host: str = "source", min_documents: int = 20, max_share: float = 0.1,
    min_words: int = 10, max_repeat_percent: int = 20,
) -> DataFrame:
    """Each input row as ``row`` with the base statistics, base_failed, n_words_left (words of
    the lines that stay), clean_text (the text without boilerplate lines) and kept."""
    common = cut_lineage(boilerplate(docs, text, host, min_documents, max_share))
    content = F.col(f"`{text}`")
    judged = docs.select(
        whole_row(docs), content.alias("text"), _host(F.col(f"`{host}`")).alias("host"), base_statistics(content).alias("base")
    ).join(hinted(common, common.count()), "host", "left")
    original = F.split("text", "\n")
    stays = F.when(F.col("lines").isNull(), original).otherwise(F.filter(
        F.transform(F.arrays_zip(original.alias("o"), normal_lines(F.col("text")).alias("n")),
                    lambda x: F.when(~F.array_contains(F.col("lines"), F.xxhash64(x["n"])), x["o"])),
        lambda line: line.isNotNull(),
    ))
    failed = (F.col("base.n_words") < min_words) | (
        100 * F.col("base.n_repeat_words") > max_repeat_percent * F.col("base.n_words"))
    clean = F.array_join(stays, "\n")
    left = F.when(F.col("lines").isNull(), F.col("base.n_words")).otherwise(
        F.coalesce(F.regexp_count(clean, F.lit(WORD)), F.lit(0)).cast("long"))
    return judged.select(
        "row", "base.*", failed.alias("base_failed"), left.alias("n_words_left"), clean.alias("clean_text"),
        (~failed & (left >= min_words)).alias("kept"),
    )
