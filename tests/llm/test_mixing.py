"""Mixing against a brute-force version: targets, rates, copies and reruns."""

import math
import re

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from knotwork.llm.mixing import mix
from knotwork.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted_targets(sizes, weights=(1, 2, 3), cap=3):
    """Share by weight, fix what is above its cap, share again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), list(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level >= cap * sizes[s]]
        if not over:
            out.update({s: weight[s] * level for s in open_})
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def check(rows, ids, texts, sources):
    sizes = {}
    for text, source in zip(texts, sources):
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    targets, taken, largest = wanted_targets(sizes), dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    by_id = dict(zip(ids, zip(texts, sources)))
    assert len(rows) == len(ids)
    for r in rows:
        text, source = by_id[r.doc_id]
        assert r.size == len(WORD.findall(text or ""))
        assert r.source_size == sizes[source]
        assert math.isclose(r.target, targets[source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s], s
    return sizes, targets, taken


def plain(df):
    return df.select("row.doc_id", "size", "source_size", "target", "copies", "taken", "rate").collect()


def test_small_cases(spark):
    data = [(i, "w " * (1 + i * 7 % 23), ["b", "a", "é", "Z", None][i * i % 5]) for i in range(400)]
    data += [(400, None, "a"), (401, "", "empty"), (402, "x" * 100_000, "Z"), (403, "long " * 3_000, "b"), (404, "one", "tiny")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(7)
    rows = plain(mix(docs))
    check(rows, *zip(*[(d[0], d[1], d[2]) for d in data]))
    again = plain(mix(docs.repartition(3)))
    assert sorted(rows) == sorted(again)


def test_rates_are_tilted_exponentially(spark):
    data = [(i, "w " * (1 + i % 40), "ab"[i % 3 == 0]) for i in range(2_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    rates = {}
    for r in plain(mix(docs, weights=(1, 1))):
        rates.setdefault(r.source_size, {})[r.size] = r.rate
    for by_size in rates.values():
        slopes = {round(math.log(r) / s, 6) for s, r in by_size.items() if 0 < r < 3}
        assert len(slopes) == 1


def test_hot_source_and_equal_rows(spark):
    data = [(i % 900, "same text here", "hot") for i in range(3_000)] + [(i, "w " * 5, "s%d" % (i % 4)) for i in range(900, 1_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    rows = plain(mix(docs))
    assert len(rows) == 3_100
    hot = [r for r in rows if r.source_size == 9_000]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 3 * 4


def test_empty_table_and_clashing_names(spark):
    schema = "doc_id long, text string, source string, size int, taken int, skey int, tilt int"
    assert mix(spark.createDataFrame([], schema)).collect() == []
    rows = mix(spark.createDataFrame([(1, "a b", "s", 7, 8, 9, 1), (2, None, None, 7, 8, 9, 1)], schema)).collect()
    assert sorted((r.row.doc_id, r.row.size, r.size) for r in rows) == [(1, 7, 2), (2, 7, 0)]


@pytest.mark.skipif(not TESTDATA.exists(), reason="no test tables")
def test_query(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()
    rows = QUERIES["op6_entropy_balancing"](spark, str(TESTDATA)).collect()
    check(rows, [d.doc_id for d in docs], [d.text for d in docs], [d.source for d in docs])
    plan = QUERIES["op6_entropy_balancing"](spark, str(TESTDATA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
