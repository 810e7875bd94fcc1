"""Folding, matching against a plain search, learning, and held-out accuracy."""

import math
import random
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from knotwork.llm import toxicity
from knotwork.llm.queries import QUERIES

SF = TESTDATA.parent / "sf0.01"
fold = toxicity.fold_text


def test_folding():
    assert fold("IdIoT") == "idiot" and fold("l1|!x") == "iiiix"
    assert fold("іdіоt") == "idiot" and fold("ｉｄｉｏｔ") == "idiot" and fold("𝐢𝐝𝐢𝐨𝐭") == "idiot"
    assert fold("1d10t") == "idiot" and fold("$tup1d") == "stupid" and fold("tr@$h") == "trash" and fold("a$$!") == "ass!"
    assert fold("in 2019, 455 of 77!") == "in 2019, 455 of 77!"
    assert fold("idiot! stop@ @home !x|") == "idiot! stop@ @home !x|"
    assert fold("é ö ñ ﬁ İ") == "é ö ñ ﬁ İ"
    for text in ("", "ﬁ 1l İ x5 ퟿ ① ٣a", "\U0001d7ce1", "a" * 50 + "1" * 50):
        assert len(fold(text)) == len(text) and fold(fold(text)) == fold(text)


def plain_hits(text, lexicon):
    """Word by word, without the automaton."""
    words = [(m.start(), m.end()) for m in toxicity._WORD.finditer(fold(text))]
    folded = [fold(text)[a:b] for a, b in words]
    safe = set()
    for phrase in lexicon.exceptions:
        parts = fold(phrase).split()
        for i in range(len(folded) - len(parts) + 1):
            if folded[i:i + len(parts)] == parts:
                safe.update(range(i, i + len(parts)))
    out = []
    for i, word in enumerate(folded):
        weights = [w for t, w in lexicon.weights.items() if (word == fold(t[1:]) if t[0] == "=" else word.startswith(fold(t)))]
        if weights and i not in safe:
            out.append((*words[i], max(weights)))
    return out


def test_matches_against_a_plain_search():
    rng = random.Random(6)
    pieces = ["ab", "abc", "b", "bcd", "abcd", "c", "1", "0", "é", "l"]
    for case in range(200):
        terms = {("=" if rng.random() < 0.5 else "") + "".join(rng.choices(pieces[:6], k=rng.randrange(1, 3))): rng.random() + 0.1
                 for _ in range(8)}
        lexicon = toxicity.Lexicon(terms, [" ".join(rng.choices(pieces[:6], k=2)) for _ in range(3)])
        text = "".join(rng.choice(pieces) + rng.choice(["", "", " ", ", ", "\n", "_", "!"]) for _ in range(80))
        n, hits = toxicity.hits_of(text, toxicity.automaton(lexicon))
        assert [(h[0], h[1], h[3]) for h in hits] == plain_hits(text, lexicon)
        assert n == len(toxicity._WORD.findall(fold(text)))


def learn(spark, rows):
    """From (text, label) rows: ids as places; the row of a text in many copies is repeated too."""
    docs = [(i, text) for i, (text, _) in enumerate(rows)]
    docs = spark.createDataFrame(docs + docs[:2], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i, (_, toxic) in enumerate(rows)] + [(None, 1.0), (-1, 1.0)], "doc_id long, toxic double")
    return toxicity.train(docs, labels)


def test_learning_and_exceptions(spark):
    rng = random.Random(1)
    filler = [f"word{c}{d}" for c in "abcdefgh" for d in "jkmnpqrs"]

    def text(*extra):
        words = rng.choices(filler, k=40) + list(extra)
        rng.shuffle(words)
        return " ".join(words)

    clean = [text() for _ in range(200)] + [text("bin nastyword") for _ in range(12)]
    toxic = [text("nastyword", "nastyword") for _ in range(30)] + [text(f"vile{e}", f"vile{e}") for e in "abcdefghijkmnopqrstu"]
    rows = [(t, 0.0) for t in clean] + [(t, 1.0) for t in toxic] + [(toxic[0], 1.0)] * 50 + [(None, 1.0), ("x", None), ("", 0.0)]
    lexicon = learn(spark, rows)
    assert lexicon.weights["=nastyword"] > 1 and lexicon.weights["viie"] > 1
    assert not any(t.lstrip("=").startswith("word") for t in lexicon.weights)
    assert "bin nastyword" in lexicon.exceptions and min(lexicon.slopes) >= 0 and max(lexicon.slopes) > 0
    texts = [text("nastyword", "nastyword", "nastyword"), text("n4$tyw0rd", "nаstyword", "NASTYWORD"), text("vilexyz", "vilexyz"),
             text(), text("bin nastyword"), text("unvile"), None, "", " \n", "nastyword " * 300_000, "a" * 1_000_000 + "1" * 100_000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "score int, text string, row int")
    began = time.time()
    got = {r.row.score: r for r in toxicity.score(docs, lexicon).collect()}
    assert time.time() - began < 60 and len(got) == len(texts)
    assert [got[i].score >= 0.5 for i in range(11)] == [True] * 3 + [False] * 6 + [True, False]
    assert got[0].n_words == 43 and len(got[1].hits) == 3 and got[6].score == got[7].score == got[3].score
    hit = got[2].hits[0]
    assert texts[2][hit.start:hit.end] == "vilexyz" and hit.term == "viie"
    assert toxicity.score(docs.limit(0), lexicon).count() == 0


def test_training_without_both_kinds(spark):
    docs = spark.createDataFrame([("some text",), (None,)], "text string")
    for rows, least in (([], 0.5), ([("a", 0.0)] * 3 + [("b c", 0.0)], 1 / 6), ([("a", 1.0)], 0.75), ([(None, 1.0)], 0.5)):
        got = toxicity.score(docs, learn(spark, rows)).collect()
        assert all(math.isclose(r.score, least) for r in got) and len(got) == 2


def test_term_counts(spark):
    rows = [(r.text, r.doc_id % 3 == 0) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    want = {True: Counter(), False: Counter()}
    for text, toxic in rows:
        want[toxic].update(toxicity.terms_of(text))
    got = toxicity.term_counts(spark.createDataFrame(rows, "text string, toxic boolean")).collect()
    assert {r.term: (r.toxic, r.clean) for r in got} == {t: (want[True][t], want[False][t]) for t in want[True] | want[False]}


def test_held_out_accuracy(spark):
    folder = str(SF)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = QUERIES["op11_toxic_lexicon"](spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    out = [(labels[r.doc_id], r.score, r.predicted) for r in got if r.held_out and r.doc_id in labels]
    toxic, clean = [s for y, s, _ in out if y], [s for y, s, _ in out if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert pairs >= 0.75 and sum(p for y, _, p in out if not y) == 0, (pairs, len(toxic))
    assert sorted(map(str, QUERIES["op11_toxic_lexicon"](spark, folder).collect())) == sorted(map(str, got))


def test_texts_count_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, "b"), (3, "b"), (4, "c"), (5, None), (6, "d"), (None, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1), (4, 0), (4, 0), (5, 1), (6, None), (None, 1)], "doc_id long, toxic int")
    for limit in (1 << 20, 0):
        monkeypatch.setattr("knotwork.operators.sizes.MAX_BROADCAST_BYTES", limit)
        texts, toxic, clean = toxicity.distinct_texts(docs, labels, "text", "doc_id", "toxic")
        assert sorted(map(tuple, texts.collect())) == [("a", True), ("b", True), ("c", False)] and (toxic, clean) == (2, 1)
