"""Runs, collapsed texts and the query against a brute-force search."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from knotwork.llm import runs
from knotwork.llm.queries import QUERIES, planted_periods


def brute(words, least=24, times=3):
    """Try every period; the first to cover a stretch is its smallest."""
    n, found, stretches = len(words), [], set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q) and (i, j + q) not in stretches:
                stretches.add((i, j + q))
                found.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.mark.parametrize("least,times", [(24, 3), (4, 2), (1, 2), (6, 3), (5, 4)])
def test_runs_of_random_words(least, times):
    rng = random.Random(least * 10 + times)
    for case in range(150):
        words = []
        while len(words) < rng.randrange(2, 120):
            block = [rng.randrange(rng.choice((1, 2, 3, 30))) for _ in range(rng.randrange(1, 12))]
            words += block * rng.choice((1, 1, 2, 3, 9))
        got = runs.find(np.array(words, np.int64), least, times).tolist()
        assert [tuple(r) for r in got] == brute(words, least, times), words


def test_suffixes_and_common_prefixes():
    rng = random.Random(5)
    for case in range(60):
        ids = np.array([rng.randrange(rng.choice((1, 2, 5))) for _ in range(rng.randrange(1, 60))], np.int64)
        order, ranks = runs.sorted_suffixes(ids)
        assert order.tolist() == sorted(range(len(ids)), key=lambda i: ids[i:].tolist())
        assert np.array_equal(ranks[-1][order], np.arange(len(ids)))


def test_children_leave_out_the_largest():
    # Suffixes of "abab$"-like words: every suffix is in all but one child at most log n times.
    ids = np.array([0, 1] * 32, np.int64)
    order, ranks = runs.sorted_suffixes(ids)
    lcp = [0] + runs.common_prefix(ranks, order[:-1], order[1:]).tolist()
    firsts, lasts, owners, intervals = runs.small_children(lcp, len(ids))
    assert sum(b - a + 1 for a, b in zip(firsts, lasts)) <= len(ids) * 6
    for a, b, owner in zip(firsts, lasts, owners):
        depth, low, high = intervals[owner]
        assert low <= a <= b <= high and min(lcp[low + 1:high + 1]) == depth


def test_defined_cases(spark):
    block = "one two three four five six seven eight"
    texts = [None, "", " \t\n", "word", " ".join(["x"] * 23), " ".join(["x"] * 24), f"a  b\n{' '.join([block] * 3)}\tz",
             " ".join([block] * 3), " ".join([block] * 2), "é é " * 30, "same", "same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "found long, text string").withColumn("row", F.lit("clash"))
    got = {r["row"].found: r.found for r in runs.collapse(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = split(text)
        found = brute(words)
        assert (got[i].n_words, [tuple(r) for r in got[i].runs]) == (len(words), found)
        assert got[i].collapsed == collapsed(words, found)
    assert [len(got[i].runs) for i in range(10)] == [0, 0, 0, 0, 0, 1, 1, 1, 0, 1]
    assert got[6].collapsed == f"a b {block} z"
    assert runs.collapse(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.collapse(docs, min_exponent=1)


def test_very_long_texts(spark):
    rng = random.Random(3)
    texts = ["a " * 400_000, "a b c d e f g " * 60_000, " ".join(str(rng.randrange(2)) for _ in range(200_000)),
             " ".join(str(i) for i in range(300_000))]
    began = time.time()
    got = [r.found for r in runs.collapse(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]
    assert time.time() - began < 90
    by_words = sorted(got, key=lambda r: r.n_words)
    assert [r.n_words for r in by_words] == [200_000, 300_000, 400_000, 420_000]
    assert [tuple(r) for r in by_words[2].runs] == [(0, 400_000, 1)] and by_words[2].collapsed == "a"
    assert [tuple(r) for r in by_words[3].runs] == [(0, 420_000, 7)] and by_words[3].collapsed == "a b c d e f g"
    assert not by_words[1].runs and not any(r.period > 40 for r in by_words[0].runs)


def rewritten(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planted_periods(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 37))) for i in range(300)] + [(None, "a b"), (-7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in planted_periods(docs).collect():
        text = dict(rows)[r.doc_id]
        assert split(r.text) == (split(text) if r.doc_id is None else rewritten(r.doc_id, split(text)))


def test_query_against_brute_force(spark):
    folder = str(TESTDATA)
    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words = rewritten(r.doc_id, split(r.text))
        found = brute(words)
        top = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if found else (None, None, None)
        digest = [hashlib.sha256(t.encode()).hexdigest() for t in (
            "".join(f"{s},{length},{q}\n" for s, length, q in found), collapsed(words, found))]
        milli = 1000 * top[1] // top[2] if found else None
        want[r.doc_id] = (len(found), *top, milli, *digest)
    got = QUERIES["op12_periodic_runs"](spark, folder).collect()
    assert len(got) == len(want) and sum(r.n_runs > 0 for r in got) > 10
    for r in got:
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want[r.doc_id]
