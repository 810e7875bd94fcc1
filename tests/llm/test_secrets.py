"""The secret scan: candidates against Python, held-out accuracy, and edge cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from knotwork.llm import secrets
from knotwork.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, source string, value int, score int"
WORDS = ["configuration", "deployment", "service", "internal", "identifier", "example", "documentation", "background"]


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame([(w,) for w in WORDS + ["config", "service"]], "word string")


def rows_(seed, count):
    rng = random.Random(seed)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    random_ = lambda: "".join(rng.choice("ABCDEFabcdefghijkl0123456789+/") for _ in range(32))
    out = []
    for i in range(count):
        out.append((f'see token = "{key()}" here', "src/app.py"))
        out.append((f"api_key: {random_()} end", "src/settings.py"))
        out.append((f"the {rng.choice(WORDS)}{rng.choice(WORDS)}{rng.choice(WORDS)} is here", "docs/readme.md"))
        out.append((f"a {rng.choice(WORDS)}-{rng.choice(WORDS)}_{rng.choice(WORDS)} of it", "docs/guide.md"))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2) for i, (t, s) in enumerate(rows)], SCHEMA).repartition(4)


def test_candidates(spark):
    texts = [None, "", "short", "é " + "a1" * 10 + "== x", "-" * 30, "x" * 100_000 + " " + "y" * 19, "a/b+c_d-" * 4 + "=" * 5]
    texts += ["k" * 25 + " " + "k" * 25] * 2
    got = secrets.candidates(frame(spark, [(t, None) for t in texts])).collect()
    want = sorted((i, m.start(), m.end(), m[0]) for i, t in enumerate(texts)
                  for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}", t or ""))
    assert sorted((r.row.doc_id, r.start, r.end, r.value) for r in got) == want


def scan_by_hand(text):
    """Long runs of key characters, each with at most two '=' behind it, character by character."""
    letters = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
    out, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in letters:
            end += 1
        if end - at >= 20:
            marks = 0
            while marks < 2 and text[end + marks:end + marks + 1] == "=":
                marks += 1
            out.append((at, end + marks, text[at:end + marks]))
        at = max(end, at + 1)
    return out


def test_candidates_by_hand(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("aZ09+/_-aaaaaaaaaaaaaaaaaaaaaaaa= .é\n") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    got = secrets.candidates(frame(spark, [(t, None) for t in texts])).collect()
    assert sorted((r.row.doc_id, r.start, r.end, r.value) for r in got) == [
        (i, *m) for i, t in enumerate(texts) for m in scan_by_hand(t)]


def test_planted_forms(spark, dictionary):
    key = "0123456789abcdef" * 2 + "a1b2c3d4"
    planted = [
        (f"TOKEN={key}", key), (f"set api_key={key} now", key), (f"http://x/y?access_token={key}&user=bob", key),
        (f'x="{key}"', key), ("password: hunter2Secret, then", "hunter2Secret"), ("passwd=abc123", "abc123"),
        ('"credential": "p@ss, w0rd!&x=1"', "p@ss, w0rd!&x=1"), ("token: secret: hunter2", "hunter2"), ("(secret = a1b2c3d4).", "a1b2c3d4"),
        ("password: " + "z9" * 100, "z9" * 100),
    ]
    clean = ["password: abc", "the token is here", "a = b", "token =", None, ""]
    docs = frame(spark, [(t, None) for t in [t for t, _ in planted] + clean])
    got = {}
    for r in secrets.scan(docs, dictionary).collect():
        got.setdefault(r.row.doc_id, []).append((r.start, r.end, r.value, r.label))
    for i, (text, value) in enumerate(planted):
        at = text.index(value)
        assert got[i] == [(at, at + len(value), value, None if i == 3 else 1)], text[:80]
    assert set(got) == set(range(len(planted)))


def test_coverage(spark, dictionary):
    values = ["serviceserviceservice", "configurationxxxxxxxx", "abcdefghijklmnopqrst", "ConfigServiceConfig0"]
    got = {r.value: round(r.coverage, 6) for r in secrets.coverage(
        spark.createDataFrame([(v,) for v in values * 2], "value string"), dictionary).collect()}
    assert got == {values[0]: 1.0, values[1]: round(13 / 21, 6), values[2]: 0.0, values[3]: round(19 / 20, 6)}


def test_held_out_accuracy(spark, dictionary):
    def with_features(rows):
        found = secrets.candidates(frame(spark, rows))
        return secrets.features(found.withColumn("label", secrets.rule_labels(F.col("value"), F.col("before"))), dictionary)

    model = secrets.train(with_features(rows_(1, 60)))
    # Unseen findings, the telling names taken away.
    hidden = [(re.sub(r"token = |api_key: ", "it says ", t), None) for t, _ in rows_(2, 60)]
    got = secrets.classify(with_features(hidden), model).select("row.doc_id", "score").collect()
    right = sum((r.score >= 0.5) == (r.doc_id % 4 < 2) for r in got)
    assert len(got) == 240 and right / len(got) > 0.95


def test_reruns_agree_and_forest_needs_both_labels(spark, dictionary):
    rows = rows_(3, 30)
    runs = [sorted(secrets.scan(frame(spark, rows).repartition(n), dictionary).collect()) for n in (2, 5)]
    assert runs[0] == runs[1]
    only = secrets.scan(frame(spark, rows_(3, 5)[::4]), dictionary).collect()
    assert len(only) == 5 and all(r.secret and r.score == 1.0 for r in only)


def test_equal_values_in_other_contexts_train_alike(spark, dictionary):
    rng = random.Random(4)
    values = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(30)]
    rows = [(f"{rng.choice(WORDS)} {rng.choice(WORDS)} token = {v} here", f"src/{rng.choice(WORDS)}.py") for v in values for _ in range(6)]
    rows += rows_(5, 20)[3::4] + rows_(6, 20)[2::4]
    found = secrets.candidates(frame(spark, rows))
    found = secrets.features(found.withColumn("label", secrets.rule_labels(F.col("value"), F.col("before"))), dictionary)
    assert not {w for r in found.select("words").collect() for w in r.words} & set(secrets.NAME_WORDS)
    order = [list(range(len(rows))), list(reversed(range(len(rows))))]
    runs = []
    for n, places in zip((3, 7), order):
        docs = spark.createDataFrame([(i, *rows[i], 1, 2) for i in places], SCHEMA).repartition(n)
        runs.append(sorted((r.row.doc_id, r.start, r.score) for r in secrets.scan(docs, dictionary).collect()))
    assert runs[0] == runs[1]


def test_empty_table(spark, dictionary):
    assert secrets.scan(spark.createDataFrame([], SCHEMA), dictionary).collect() == []


SF = TESTDATA.parent / "sf0.01"


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    frame_ = QUERIES["op8_secret_forest"](spark, str(SF))
    rows = {(r.doc_id, r.start): r for r in frame_.collect()}
    planted = [(i, m.start(1), m.end(1)) for i, t in docs.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)]
    assert planted and all(rows[i, a].secret and rows[i, a].end == b for i, a, b in planted)
    plain = [r for r in rows.values() if docs[r.doc_id][r.start:r.end].isalpha()]
    assert not any(r.secret for r in plain)
    plan = frame_._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
