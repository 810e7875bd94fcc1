"""Base statistics and line frequency against brute force."""

import re
from collections import defaultdict

import pytest

from conftest import TESTDATA
from knotwork.llm import quality
from knotwork.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(inside))


def normal(line):
    return " ".join(WORD.findall(line.lower()))


def common_lines(rows, min_documents=20, max_share=0.1):
    """The normalised lines above the limits for each host of (text, host) rows."""
    texts = defaultdict(set)
    for text, host in rows:
        if text is not None:
            texts[host].add(text)
    common = defaultdict(set)
    for host, held in texts.items():
        count = defaultdict(int)
        for text in held:
            for line in {normal(x) for x in text.split("\n")} - {""}:
                count[line] += 1
        common[host] = {x for x, n in count.items() if n > min_documents and n > max_share * len(held)}
    return common


def verdicts(rows):
    """(base, base_failed, left, clean, kept) of (text, host) rows."""
    common = common_lines(rows)
    out = []
    for text, host in rows:
        b = base(text)
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        clean = "\n".join(x for x in (text or "").split("\n") if normal(x) not in common.get(host, ()))
        left = len(WORD.findall(clean))
        out.append((*b, failed, left, not failed and left >= 10))
    return out


def found(df, key="row.doc_id"):
    return {r[0]: tuple(r)[1:] for r in df.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_words_left", "kept"
    ).collect()}


def test_cases(spark):
    shared = "Subscribe to our newsletter for more of this and that today"
    data = []
    for i in range(60):  # pages that hold little but the shared line
        data.append((f"{shared if i % 2 else shared.upper()}  \nown{i} words{i}", "a"))
    for i in range(60):  # full documents with the shared line
        data.append((" ".join(f"w{i}x{k}" for k in range(30)) + f"\n\t{shared}", "a"))
    for i in range(300):  # copies count once
        data.append((" ".join(f"copy{k}" for k in range(20)), "a"))
    for i in range(10):  # below the limits elsewhere
        data.append((f"{shared}\nb{i}", "b"))
    data += [
        (None, "a"), ("", "a"), ("  \n\t\n", None), ("é" * 100_000, "c"), ("a b c d e " * 3_000, "c"),
        ("one two three\none two three\n\n\none two three", None), ("x y \x1c #*$%&|<> \x85", "c"),
        ("\r\n".join(["l m n o p"] * 2), "c"), (" ".join(f"v{k}" for k in range(7_000)) + " v0 v1 v2 v3 v4 v5", "c"),
    ]
    docs = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(data)], "doc_id long, text string, source string")
    got = found(quality.rules(docs.repartition(5)))
    for i, want in enumerate(verdicts(data)):
        assert got[i] == want, (i, data[i][0] and data[i][0][:60])
    assert sum(not got[i][-1] for i in range(60)) == 60
    assert all(got[i][-1] for i in range(60, 420))


def test_clean_text_keeps_other_lines(spark):
    rows = [(i, f"first {i}\nSHARED   line\nlast {i}", "h") for i in range(40)]
    out = quality.rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_words=1)
    assert {r.clean_text for r in out.collect()} == {f"first {i}\nlast {i}" for i in range(40)}


def test_empty_table_and_clashing_names(spark):
    schema = "doc_id long, text string, source string, host int, base int, lines int, kept int"
    assert quality.rules(spark.createDataFrame([], schema)).collect() == []
    row = quality.rules(spark.createDataFrame([(None, None, None, 1, 2, 3, 4)], schema)).first()
    assert row.row.kept == 4 and row.kept is False and row.n_words == 0


@pytest.mark.skipif(not TESTDATA.exists(), reason="no test tables")
def test_query(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()
    got = found(QUERIES["op5_line_frequency"](spark, str(TESTDATA)), "doc_id")
    for d, want in zip(docs, verdicts([(d.text, d.source) for d in docs])):
        assert got[d.doc_id] == want
