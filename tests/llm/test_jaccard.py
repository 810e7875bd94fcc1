"""The similarity join against all pairs."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from knotwork.llm import jaccard
from knotwork.llm.components import components
from knotwork.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, key int, id int"


def shingle_set(text):
    words = (text or "").encode().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """links per row, and class roots, of (id, text) rows."""
    sets = [shingle_set(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    pairs = Counter(p for held in holders.values() for p in itertools.combinations(held, 2))
    for (a, b), common in pairs.items():
        if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        names.setdefault(find(i), []).append(doc_id)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in names.items()}
    return [(doc_id, least[find(i)], links[i]) for i, (doc_id, _) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], SCHEMA).repartition(6)


def near(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] += "x"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out = [" ".join(text(rng.randint(1, 200))) for _ in range(150)]
    base = text(150)
    out += [near(rng, base, rng.randint(0, 6)) for _ in range(150)]  # a large group of near copies
    for n in (5, 12, 60, 400):
        words = text(n)
        out += [near(rng, words, k) for k in range(min(n, 8))]
    out += ["the same hot text of nine words in all"] * 120
    out += [None, "", " \n\t", "one", "one", "a b c", "a b c", "a b d", "é é é é é é", "long " * 40_000, " ".join(text(30_000))]
    out.append(out[-1] + " tail")
    out = list(enumerate(out, 1_000))
    out += [(None, out[0][1]), (None, "no id here at all but words"), (out[3]), (out[3])]
    return out


def test_same_links_as_all_pairs(spark, rows):
    got = jaccard.join(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute(rows))


def test_large_buckets_and_blocks(spark, rows, monkeypatch):
    for name, value in (("BUCKET", 4), ("BLOCK", 16), ("BLOCK_SHINGLES", 3_000)):
        monkeypatch.setattr(jaccard, name, value)
    got = jaccard.join(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute(rows))


def test_empty_blocks_count_no_pair_again(spark, monkeypatch):
    """Pairs whose two texts fall into one of several blocks or into two."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 100)
    pairs = []
    for n in range(16):
        words = [f"w{n}x{i}" for i in range(150)]
        pairs += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(words + ["end"]))]
    got = {r.doc_id: (r.class_id, r.links) for r in jaccard.join(frame(spark, pairs)).collect()}
    assert got == {i: (i - i % 2, 1) for i, _ in pairs}


def test_shuffle_joins_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "hinted", lambda df, n: df)
    got = jaccard.join(frame(spark, rows[100:])).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute(rows[100:]))


def test_one_document_of_each_class_stays(spark, rows):
    kept = jaccard.representatives(frame(spark, rows)).collect()
    worded = [r for r in brute(rows)]
    texts = dict((i, t) for i, t in rows)
    wanted = Counter(c for d, c, n in set(worded) if shingle_set(texts[d]) and c is not None and d == c)
    got = Counter(r.doc_id for r in kept if r.doc_id is not None and shingle_set(r.text))
    assert got == wanted
    assert sum(not shingle_set(r.text) for r in kept) == 3
    assert kept[0].key == 1 and kept[0].id == 2


def test_empty_table(spark):
    assert jaccard.join(spark.createDataFrame([], SCHEMA)).collect() == []
    assert jaccard.representatives(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 500)] + [(1000, 1001), (1001, 1000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(500)}, 1000: 1000, 1001: 1000}


@pytest.mark.skipif(not TESTDATA.exists(), reason="no test tables")
def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    got = QUERIES["op2_ngram_jaccard"](spark, str(TESTDATA)).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute(docs))


def test_links_of_large_buckets_are_linear(spark, monkeypatch):
    """Edges of one group of near copies: a few for each, whatever the size of the group."""
    made = []
    monkeypatch.setattr(jaccard, "BLOCK", 64)
    rng = random.Random(2)
    for size in (300, 600, 1200):
        words = [f"w{rng.randrange(400)}" for _ in range(150)]
        texts = list({near(rng, words, rng.randint(0, 5)) for _ in range(size)})
        docs = frame(spark, list(enumerate(texts)))
        classes = docs.select(F.monotonically_increasing_id().alias("cid"), jaccard.signature("text").alias("sig"))
        classes = jaccard.cut_lineage(classes)
        found = jaccard.buckets(classes).filter(F.col("held") > jaccard.BUCKET).select("path", "cid")
        edges = jaccard.large_links(jaccard.cut_lineage(found), classes.select("cid", "sig.n", "sig.sketch"))
        made.append(edges.count() / len(texts))
    assert max(made) < 12, made
