"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q, at least ``min_exponent``
periods and ``min_length`` words long, that no neighbouring word extends.  Every run ends in
one square of its period that cannot be moved right (a branching square).  Two suffixes that
are a period apart there part after exactly q words, so both lie in one LCP interval of depth
q and in different children of it.  For each interval, every suffix i of all children but the
largest looks up whether suffix i + q or i - q lies in the interval, which takes one look into
the inverse suffix array; with small children only, that is O(n log n) look-ups for a text.
The squares found are then moved left as far as they go and merged: those that cover the same
stretch are one run, with the smallest of their periods.  Intervals are pairs of array
positions on a stack; no tree is built.

Suffixes are sorted by doubling.  The ranks of every doubling step are kept: they compare two
places of a text in logarithmic time, forwards for the LCP values and backwards for moving
squares left.  Memory is O(n log r) numbers for a text of n words whose longest repeat has r.

A run of these lengths repeats a window of ``min_length - min_length // min_exponent`` words,
so texts without such a repeat (by a 64-bit hash, which can only say yes too often) have no
run and are not sorted.

Defined cases: words are runs of characters other than space and U+0009 to U+000D; a null,
empty or blank text has no words and no runs, and collapses to an empty text; texts of any
length are used whole; runs may overlap, and a word goes if any run says so; every repeated
row gets its own equal result; an empty table gives an empty result; input columns may have
any names, because the rows come back inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from knotwork.llm.common import whole_row

MIN_LENGTH, MIN_EXPONENT = 24, 3
# Words of the texts that are looked at together, and look-ups made at once.
GROUP_WORDS, LOOKUPS = 1 << 17, 1 << 20

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
FOUND = StructType([
    StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType()),
])


def numbered(words: list[bytes]):
    """A number for each word; equal words have equal numbers."""
    import numpy as np

    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def repeating(texts: list, width: int):
    """Which of some numbered texts may hold a window of ``width`` words twice."""
    import numpy as np

    ids = np.concatenate(texts)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    out = np.zeros(len(texts), bool)
    last = len(ids) - width + 1
    if last < 2:
        return out
    codes = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    codes = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    hashed = np.zeros(last, np.uint64)
    for i in range(width):
        hashed = hashed * np.uint64(0xD1342543DE82EF95) + codes[i:i + last]
    inside = owner[:last] == owner[width - 1:]
    owner = owner[:last][inside]
    hashed = (hashed[inside] ^ (owner.astype(np.uint64) << np.uint64(7))) * np.uint64(0x9FB21C651E98DF25)
    order = np.argsort(hashed, kind="stable")
    same = (hashed[order[1:]] == hashed[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    out[owner[order[1:][same]]] = True
    return out


def sorted_suffixes(ids):
    """(suffix array, ranks): ranks[k] orders all suffixes by their first 2**k words, equal
    ones alike; in the last, no two are alike."""
    import numpy as np

    n = len(ids)
    order = np.argsort(ids, kind="stable")
    slots, keys = np.arange(n), ids[order]
    rank, ranks, width = np.zeros(n, np.int64), [], 1
    while True:
        # A group of equal suffixes has the rank of its first slot.
        first = np.append(True, keys[1:] != keys[:-1])
        rank = rank.copy()
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        ranks.append(rank)
        alone = first & np.append(first[1:], True)
        slots = slots[~alone]
        if not len(slots):
            return order, ranks
        suffixes = order[slots]
        ahead = suffixes + width
        keys = rank[suffixes] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by_key = np.argsort(keys, kind="stable")
        order[slots], keys = suffixes[by_key], keys[by_key]
        width *= 2


def common_prefix(ranks, left, right):
    """Length of the common prefix of the suffixes at ``left`` and ``right``."""
    import numpy as np

    n = len(ranks[0])
    length = np.zeros(len(left), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        a, b = left + length, right + length
        same = (a < n) & (b < n) & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])
        length += same.astype(np.int64) << k
    return length


def moved_left(ranks, at, period):
    """How far the stretch from ``at`` on keeps its period to the left."""
    import numpy as np

    length = np.zeros(len(at), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        a = at - length - (1 << k)
        place = np.maximum(a, 0)
        same = (a >= 0) & (ranks[k][place] == ranks[k][place + period])
        length += same.astype(np.int64) << k
    return length


def small_children(lcp: list[int], deepest: int) -> tuple[list, list, list, list]:
    """(first, last, interval) of all children but the largest of the LCP intervals of depth 1
    to ``deepest``, and (depth, first, last) of the intervals.

    ``lcp[k]`` belongs to the suffixes k - 1 and k.
    """
    firsts, lasts, owners = [], [], []
    intervals: list[list[int]] = []
    # An open interval: depth, first, start of its open child, its largest child, its number.
    stack = [[0, 0, 0, 0, -1, -1]]

    def close(top: list[int], end: int) -> None:
        begin = top[2]
        top[2] = end + 1
        if end - begin > top[4] - top[3]:
            begin, end, top[3], top[4] = top[3], top[4], begin, end
        if top[5] >= 0 and end >= begin:
            firsts.append(begin)
            lasts.append(end)
            owners.append(top[5])

    n = len(lcp)
    for k in range(1, n + 1):
        depth = lcp[k] if k < n else 0
        start = k - 1
        top = stack[-1]
        while depth < top[0]:
            close(top, k - 1)
            if top[5] >= 0:
                intervals[top[5]][2] = k - 1
            start = top[1]
            stack.pop()
            top = stack[-1]
        if depth > top[0]:
            number = -1
            if depth <= deepest:
                number = len(intervals)
                intervals.append([depth, start, start])
            top = [depth, start, start, 0, -1, number]
            stack.append(top)
        close(top, k - 1)
    return firsts, lasts, owners, intervals


def branching_squares(ids, order, ranks, deepest: int):
    """(start, period) of all squares of period up to ``deepest`` that cannot be moved right."""
    import numpy as np

    n, place = len(ids), ranks[-1]
    lcp = np.append(0, common_prefix(ranks, order[:-1], order[1:]))
    firsts, lasts, owners, intervals = (np.array(x, np.int64) for x in small_children(lcp.tolist(), deepest))
    if not len(firsts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = lasts - firsts + 1
    ends = np.cumsum(sizes)
    starts, periods = [], []
    for at in range(0, int(ends[-1]), LOOKUPS):
        item = np.arange(at, min(at + LOOKUPS, int(ends[-1])))
        child = np.searchsorted(ends, item, side="right")
        suffix = order[firsts[child] + item - (ends[child] - sizes[child])]
        depth, low, high = intervals[owners[child]].T
        for begin, other in ((suffix, suffix + depth), (suffix - depth, suffix - depth)):
            held = (other >= 0) & (other < n)
            seen = place[np.where(held, other, 0)]
            held &= (seen >= low) & (seen <= high)
            begin, period = begin[held], depth[held]
            after = begin + 2 * period
            stops = (after == n) | (ids[np.minimum(after, n - 1)] != ids[begin + period])
            starts.append(begin[stops])
            periods.append(period[stops])
    return np.concatenate(starts), np.concatenate(periods)


def find(ids, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
    """(start, length, period) of the runs of a numbered text, by start, then period."""
    import numpy as np

    n = len(ids)
    if n < min_length:
        return np.zeros((0, 3), np.int64)
    order, ranks = sorted_suffixes(ids)
    at, period = branching_squares(ids, order, ranks, n // min_exponent)
    moved = moved_left(ranks, at, period)
    start, length = at - moved, 2 * period + moved
    long = length >= np.maximum(min_length, min_exponent * period)
    found = np.unique(np.stack([start[long], length[long], period[long]], axis=1), axis=0)
    # Squares over the same stretch are one run; its smallest period comes first.
    new = np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1)) if len(found) else np.zeros(0, bool)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, runs):
    """Which words stay: not those after the first period of a run."""
    import numpy as np

    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def _group(texts: list[bytes], numbers: list, min_length: int, min_exponent: int) -> pa.Array:
    """Results of some texts; ``texts`` have one space between words already."""
    import numpy as np

    sizes = [len(ids) for ids in numbers]
    runs = [np.zeros((0, 3), np.int64)] * len(texts)
    for i in np.flatnonzero(repeating(numbers, max(1, min_length - min_length // min_exponent))):
        runs[i] = find(numbers[i], min_length, min_exponent)
        if len(runs[i]):
            stays = kept_words(sizes[i], runs[i])
            texts[i] = b" ".join(w for w, stay in zip(texts[i].split(), stays.tolist()) if stay)
    flat = np.concatenate(runs)
    offsets = np.append(0, np.cumsum([len(r) for r in runs]))
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(flat[:, i]) for i in range(3)], RUN.names))
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())], FOUND.names)


def collapse(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH,
             min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Each input row as ``row`` with ``found``: n_words, runs (start, length, period in words, by
    start, then period) and the collapsed text, in which every run is left with one period."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts, numbers, words = [], [], 0
            for value in batch.cast(pa.binary()):
                found = (value.as_py() or b"").split()
                texts.append(b" ".join(found))
                numbers.append(numbered(found))
                words += len(found)
                if words >= GROUP_WORDS:
                    yield _group(texts, numbers, min_length, min_exponent)
                    texts, numbers, words = [], [], 0
            if texts:
                yield _group(texts, numbers, min_length, min_exponent)
        pa.default_memory_pool().release_unused()

    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has two periods and one word at least")
    # Marked so that Catalyst runs it once for all of its fields.
    found = F.arrow_udf(run, FOUND).asNondeterministic()
    return docs.select(whole_row(docs), found(F.col(f"`{text}`")).alias("found"))
