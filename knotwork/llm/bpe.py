"""Byte-level BPE with a local rank file: encode texts to ids, decode ids to bytes.

Nulls: a null text has null ids and a null id list decodes to null (the query turns
null texts into empty ones first).  Empty texts have no ids.  Repeated rows are encoded
each for itself.  Texts of any length are encoded whole; long runs of white space, on which
the library's pattern gives up, are encoded as the piece that the pattern would match.  An
empty table gives an empty result, and columns may have any names: these are column functions.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

from knotwork.llm.common import in_slices

# A non-space followed by a space or a line feed: no match of a pattern that takes white
# space only at the front of a piece, or alone, can span this place, so the parts on both
# sides are split alike together and apart.
SAFE_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n])")
# White space as the pattern knows it; a run of this many goes past the pattern.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = re.compile(f"(?<![{WHITE}])[{WHITE}]{{1024,}}")
# Characters given to the library at once, at least; parts end at the next safe boundary.
PART_CHARS = 1 << 18


@lru_cache(maxsize=4)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=4)
def _one_piece(ranks: bytes):
    """An encoding that takes its text as one piece."""
    return _encoding(ranks, r"(?s:.+)")


def segments(text: str) -> Iterator[tuple[bool, str]]:
    """``text`` in order, as (is a piece of white space, segment).  Of a long run the pattern
    matches all at the end of a text, and all but the last character before a word."""
    start = 0
    for run in LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield False, text[start:run.start()]
        yield True, text[run.start():end]
        start = end
    yield False, text[start:]


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` in order, cut only at safe boundaries, each part at least ``size`` long."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def coder(spark: SparkSession, rank_file: str, pattern: str) -> tuple[Callable[[Column], Column], ...]:
    """``(encode, decode, round_trip)`` for the ranks of a local file (one "base64 rank" a line).

    ``round_trip`` gives the ids of a text and the bytes that these ids decode to, where both
    are wanted.  The file is read once on the driver; its size is that of the vocabulary, not
    of the data, and it travels to the executors as a broadcast value.
    """
    with open(rank_file, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())

    def to_ids(texts: pa.Array) -> pa.Array:
        import numpy as np

        encoding = _encoding(ranks.value, pattern)
        ids, offsets, valid = [], np.zeros(len(texts) + 1, np.int32), np.ones(len(texts), bool)
        for row, text in enumerate(texts):
            text = text.as_py()
            count = 0
            if text is None:
                valid[row] = False
            elif text:
                for white, segment in segments(text):
                    coding = _one_piece(ranks.value) if white else encoding
                    for part in [segment] if white else parts(segment):
                        ids.append(coding.encode_to_numpy(part, disallowed_special=()))
                        count += len(ids[-1])
            offsets[row + 1] = offsets[row] + count
        values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(~valid))

    def to_bytes(lists: pa.Array) -> pa.Array:
        encoding = _encoding(ranks.value, pattern)
        return pa.array(
            [None if ids is None else encoding.decode_bytes(ids) for ids in (x.as_py() for x in lists)], pa.binary())

    def both(texts: pa.Array) -> pa.Array:
        ids = to_ids(texts)
        return pa.StructArray.from_arrays([ids, to_bytes(ids)], ["ids", "raw"])

    return (
        F.arrow_udf(in_slices(to_ids), "array<int>"), F.arrow_udf(in_slices(to_bytes), "binary"),
        F.arrow_udf(in_slices(both), "struct<ids:array<int>,raw:binary>"),
    )


def digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256)
