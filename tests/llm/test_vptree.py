"""The search against brute force: exact with factor one, recall with the default."""

import numpy as np
import pytest

from conftest import TESTDATA
from knotwork.llm import vptree
from knotwork.llm.queries import QUERIES

SF = TESTDATA.parent / "sf0.01"
SCHEMA = "id long, vector array<float>, width int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA).repartition(4)


def takes_part(i, v):
    return i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)


def brute(rows, asked, k):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if takes_part(i, v)]
    out = []
    for i, v in {i: v for i, v in asked if takes_part(i, v)}.items():
        v = np.array(v, np.float32).astype(float)
        scored = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in rows if j != i and len(w) == len(v))
        out += [(i, rank + 1, j, round(d, 9)) for rank, (d, j) in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted((r[0], r[1], r[2], round(r[3], 9)) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = [(i, rng.normal(size=8).tolist()) for i in range(1_500)]
    out += [(i, [1.0] + [0.0] * 7) for i in range(1_500, 2_300)]  # one vector many times
    out += [(i, rng.normal(size=3).tolist()) for i in range(2_300, 2_304)]  # another width, few rows
    out += [(5_000, None), (5_001, []), (5_002, [0.0] * 8), (5_003, [float("nan")] + [1.0] * 7),
            (5_004, [float("inf")] + [1.0] * 7), (5_005, [None] + [1.0] * 7), (None, [1.0] * 8), out[0], out[0], (5_006, [1e30] * 8)]
    return out


def asked(rows):
    return [(i, v) for i, v in rows if i is not None and i % 100 == 0 or i in (2_300, 5_003)]


def test_factor_one_is_exact(spark, rows, monkeypatch):
    monkeypatch.setattr(vptree, "BLOCK_QUERIES", 7)
    got = vptree.search(frame(spark, rows), frame(spark, asked(rows)), 10, 1.0, shard_rows=400)
    assert found(got) == brute(rows, asked(rows), 10)


def test_pruning_skips_rows(rows):
    """With factor one a tree leaves out parts of low-dimensional data, without losing neighbours."""
    rng = np.random.default_rng(0)
    points = rng.normal(size=(5_000, 2))
    tree = vptree.build(np.arange(5_000), points, rng)
    looked = []

    class Counted(vptree.Search):
        def _leaf(self, rows, active):
            looked.append(len(rows) * len(active))
            super()._leaf(rows, active)

    score, got = Counted(tree, np.arange(50), points[:50], 5, 1.0).run()
    assert sum(looked) < 0.3 * 50 * 5_000
    for i in range(50):
        d = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        assert got[i].tolist() == np.argsort(d)[:5].tolist()


def test_empty_tables(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert vptree.search(empty, empty).collect() == []
    assert vptree.search(empty, frame(spark, rows[:3])).collect() == []


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_recall_of_the_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = QUERIES["op9_vantage_points"](spark, str(SF)).select("query_id", "rank", "vec_id", "score").collect()
    assert len(got) == len(want)
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(hits) / len(want) >= 0.95
