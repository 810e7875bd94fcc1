"""Held-out accuracy, mixtures, and counts against brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import TESTDATA
from knotwork.llm import langid
from knotwork.llm.queries import QUERIES

SF = TESTDATA.parent / "sf0.01"
EN = "the quick brown fox jumps over the lazy dog and the cat that was with them when they were there".split()
DE = "der schnelle braune fuchs springt über den faulen hund und die katze die bei ihnen war als sie dort waren".split()


@pytest.fixture(scope="module")
def model(spark):
    rows = [("en", " ".join(EN)), ("de", " ".join(DE)), ("xx", None), (None, "ignored words"), ("zz", "123 456"), ("en", "")]
    return langid.train(spark.createDataFrame(rows, "lang string, text string"))


def predict(spark, model, texts):
    docs = spark.createDataFrame([(i, t, "lang") for i, t in enumerate(texts)], "doc_id long, text string, mixture string")
    return {r.row.doc_id: r.mixture for r in langid.predict(docs, *model).collect()}


def test_only_languages_with_letters_are_learned(model):
    assert model[0] == ["de", "en"]
    assert np.allclose(np.exp(model[1].astype(float)).sum(axis=0), 1, atol=1e-3)


def test_mixtures_and_edge_cases(spark, model):
    mixed = " ".join(EN * 20 + DE * 10)
    texts = [" ".join(EN * 3), " ".join(DE * 3), mixed, None, "", "12 34 !?", " ".join(EN * 20_000), "a" * 600_000, "same", "same"]
    got = predict(spark, model, texts)
    assert (got[0].lang, got[1].lang, got[6].lang) == ("en", "de", "en")
    assert got[2].langs == ["en", "de"] and abs(got[2].shares[0] - 2 / 3) < 0.1 and got[2].score == got[2].shares[0]
    assert got[0].langs == ["en"] and got[0].score == 1.0
    assert [got[i].lang for i in (3, 4, 5)] == ["und"] * 3 and got[4].score == 0.0
    assert got[7].lang in ("de", "en") and got[8] == got[9]


def test_counts_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(EN * 50)
    whole = Counter(langid.trigrams(text, 1 << 12)[0].tolist())
    monkeypatch.setattr(langid, "PIECE", 64)
    assert "".join(langid.pieces(text)) == text
    assert sum((Counter(langid.trigrams(p, 1 << 12)[0].tolist()) for p in langid.pieces(text)), Counter()) == whole


def test_em_reaches_the_best_proportions():
    """Against a fine grid over two languages."""
    rng = np.random.default_rng(2)
    words = rng.normal(0, 2, (40, 2))
    likelihood = np.exp(words)
    grid = np.linspace(0.001, 0.999, 999)
    best = max(grid, key=lambda p: np.log(likelihood @ [p, 1 - p]).sum())
    share, _ = langid._proportions(likelihood, [0, 1])
    assert abs(share[0] - best) < 0.05


def test_as_many_languages_as_the_penalty_allows():
    words = np.full((600, 7), -20.0)
    for lang in range(6):
        words[100 * lang:100 * (lang + 1), lang] = 0.0
    found, shares = langid.infer(words)
    assert sorted(found) == list(range(6)) and np.allclose(shares, 1 / 6, atol=0.01)


def test_no_labels_and_empty_table(spark):
    languages, table = langid.train(spark.createDataFrame([], "lang string, text string"))
    assert languages == []
    assert predict(spark, (languages, table), ["some words"])[0].lang == "und"
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert langid.predict(empty, languages, table).collect() == []


def test_bounded_model(spark):
    rows = spark.createDataFrame([("en", "a b"), ("de", "c d")], "lang string, text string")
    assert langid.train(rows, max_cells=1 << 12)[1].shape == (1 << 11, 2)
    with pytest.raises(ValueError):
        langid.train(rows, max_cells=256)


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_language_mixture"](spark, str(SF)).collect()
    assert len(rows) == len(docs)
    right = held = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if r.held_out:
            held += 1
            right += r.lang_pred == docs[r.doc_id].lang
    assert held > 100 and right / held > 0.97
