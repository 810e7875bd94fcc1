"""Similarity search against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from knotwork.functions.vectors import check_vector
from knotwork.model import EDGE_SCHEMA, PropertyGraph, shape_vertices
from knotwork.operators import nearest, vector
from knotwork.operators.lsh import LshIndex
from knotwork.plans.nodes import ChunkNode, EntityNode, Relation
from knotwork.plans.property_store import PropertyStore


@pytest.fixture(scope="module")
def graph(spark):
    """Half of the rows are copies of one vector, a few are unusable."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        v = [0.5, 0.5, 0.0, 0.5, 0.5, 0.0] if i % 2 else rng.normal(size=6).tolist()
        rows.append((f"T{i % 3}", f"n{i:03d}", v))
    rows += [("T0", "short", [1.0, 2.0]), ("T0", "zero", [0.0] * 6), ("T0", "none", None),
             ("T0", "hole", [1.0, None, 1.0, 1.0, 1.0, 1.0]), ("Entity", "base", [1.0] * 6), ("TextChunk", "chunk", [1.0] * 6)]
    frame = spark.createDataFrame(rows, "label string, name string, e array<float>").repartition(7)
    nodes = shape_vertices(frame, F.col("label"), F.col("name"), name=F.col("name"), embedding=F.col("e"))
    return PropertyGraph(nodes, spark.createDataFrame([], EDGE_SCHEMA))


def brute(graph, query, label=None):
    q = np.array(query) / np.linalg.norm(query)
    scores = []
    for r in graph.vertices.select("vid", "label", "embedding").collect():
        e = r.embedding
        if r.label in ("Entity", "TextChunk") or e is None or len(e) != 6 or None in e or label not in (None, r.label):
            continue
        v = np.array(e, dtype="float64")
        length = np.linalg.norm(v)
        scores.append((-round(max(0.0, float(v @ q / length if length else 0.0)), 9), r.vid))
    return [(vid, -s) for s, vid in sorted(scores)]


QUERIES = [[1.0, 0.2, 0.0, 0.3, 1.0, -0.5], [0.5, 0.5, 0.0, 0.5, 0.5, 0.0], [-1.0, 0.0, 0.0, 0.0, 0.0, 1.0]]


def rounded(rows):
    return [(r.vid, round(r.score, 9)) for r in rows]


@pytest.mark.parametrize("query", QUERIES)
def test_exact_search(graph, query):
    assert rounded(vector.vector_query(graph, query, 25).collect()) == brute(graph, query)[:25]
    assert len(vector.vector_query(graph, query).collect()) == 10


def test_per_type(graph):
    rows = vector.vector_query_per_type(graph, QUERIES[0], 4).collect()
    for label in ("T0", "T1", "T2"):
        mine = sorted((r for r in rows if r.label == label), key=lambda r: (-r.score, r.vid))
        assert rounded(mine) == brute(graph, QUERIES[0], label)[:4]


@pytest.mark.parametrize("sizes", [(6, 6, 6), (1, 9, 4)])
def test_batch_search(graph, sizes, monkeypatch):
    searches = [{"type_name": f"T{i}", "query_embedding": q, "top_k": k} for i, (q, k) in enumerate(zip(QUERIES, sizes))]
    searches.append({"type_name": "T1", "query_embedding": QUERIES[2], "top_k": 6})
    for budget in (vector.MAX_QUERY_BYTES, 50):
        monkeypatch.setattr(vector, "MAX_QUERY_BYTES", budget)
        rows = vector.batch_vector_search(graph, searches).collect()
        for i, s in enumerate(searches):
            mine = sorted((r for r in rows if r.search == i), key=lambda r: (-r.score, r.vid))
            assert rounded(mine) == brute(graph, s["query_embedding"], s["type_name"])[: s["top_k"]]


@pytest.mark.parametrize("budget, tile", [(1 << 25, 8192), (0, 8192), (0, 37), (1 << 25, 37)])
def test_nearest_join(spark, graph, budget, tile, monkeypatch):
    """Both ways of the join, in small tiles too, against a plain search per query."""
    monkeypatch.setattr("knotwork.operators.sizes.MAX_BROADCAST_BYTES", budget)
    monkeypatch.setattr(nearest, "TILE", tile)
    rng = np.random.default_rng(8)
    asked = {f"q{i}": (q, None) for i, q in enumerate([*QUERIES, *rng.normal(size=(60, 6)).tolist()])}
    asked |= {"typed": (QUERIES[0], "T1"), "both": (QUERIES[1], "T2")}
    bad = [("none", None, None), ("zero", [0.0] * 6, None), ("hole", [1.0, None] * 3, None), ("nan", [float("nan")] * 6, None),
           ("wide", [1.0] * 9, None), ("empty", [], None)]
    rows = [(name, q, kind) for name, (q, kind) in asked.items()] + bad
    table = spark.createDataFrame(rows, "query_id string, embedding array<double>, type string")
    got = {}
    for r in nearest.nearest_join(graph, table, 7).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(asked)
    for name, (query, kind) in asked.items():
        mine, wanted = sorted(got[name], key=lambda r: (-r.score, r.vid)), brute(graph, query, kind)[:7]
        assert [r.vid for r in mine] == [vid for vid, _ in wanted]
        assert [r.score for r in mine] == pytest.approx([score for _, score in wanted], abs=1e-8)


def test_nearest_join_of_base_types(spark, graph):
    typed = PropertyGraph(graph.vertices, graph.edges, {"T1": "Top", "T2": "T1", "T0": None})
    table = spark.createDataFrame([(1, QUERIES[0], "Top"), (2, QUERIES[0], "Entity")], "query_id int, embedding array<double>, type string")
    got = nearest.nearest_join(typed, table, 500).groupBy("query_id", "label").count().collect()
    labels = {q: {r.label for r in got if r.query_id == q} for q in (1, 2)}
    assert labels == {1: {"T1", "T2"}, 2: {"T1", "T2", "Entity"}}
    assert nearest.nearest_join(typed, table.limit(0)).count() == 0


def test_index_follows_the_store(spark, tmp_path):
    """Approximate search right after upserts, deletions and a refresh; recall on near neighbours."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 16))
    vectors = {f"n{i:04d}": centres[i % 30] + 0.1 * rng.normal(size=16) for i in range(900)}
    store = PropertyStore(spark, str(tmp_path / "g"), embedding_dimension=16, buckets=3)
    with pytest.raises(ValueError, match="create_vector_index"):
        store.vector_query(centres[0].tolist(), 5, approximate=True)

    def nodes(names):
        return [EntityNode(n, "THING", {"doc_id": "d1"} if n > "n0800" else {}, vectors[n].tolist()) for n in names]

    names = sorted(vectors)
    store.upsert_nodes(nodes(names[:600]))
    store.create_vector_index()
    with pytest.raises(ValueError, match="already"):
        store.create_vector_index()
    store.upsert_nodes(nodes(names[600:]))
    other = PropertyStore(spark, str(tmp_path / "g"), embedding_dimension=16)

    def compare(least):
        found = 0
        for c in range(10):
            query = centres[c].tolist()
            exact = [(r.vid, r.score) for r in store.vector_query(query, 10).collect()]
            got = [(r.vid, r.score) for r in other.vector_query(query, 10, approximate=True).collect()]
            assert got == sorted(got, key=lambda r: (-r[1], r[0]))
            found += len(set(got) & set(exact))
        assert found >= least, found

    compare(90)
    for n in names[:30]:
        vectors[n] = -vectors[n]
    store.upsert_nodes(nodes(names[:30]))
    store.delete(ids=names[30:60])
    compare(90)
    first = store.vector_query((-centres[0]).tolist(), 1, approximate=True).first()
    assert first.vid == "THING/n0000"
    store.refresh_documents(["d1"], [EntityNode("fresh", "THING", {"doc_id": "d1"}, centres[5].tolist())])
    compare(90)
    assert store.vector_query(centres[5].tolist(), 1, approximate=True).first().vid == "THING/fresh"
    entries = spark.read.parquet(f"{store.disk.path}/index/rows")
    assert entries.columns == ["table", "bucket", "label", "vid", "slot"]
    before = entries.count()
    store.compact()
    assert spark.read.parquet(f"{store.disk.path}/index/rows").count() == 8 * store.graph.vertices.count() < before
    compare(90)
    store.clear()
    assert store.vector_query(centres[5].tolist(), 1, approximate=True).count() == 0


def test_retrieval_of_a_table_equals_single_retrievals(spark, store):
    store.upsert_nodes([
        ChunkNode("one", "c1"), ChunkNode("two", "c2"),
        *[EntityNode(f"E{i}", "THING", {"triplet_source_id": f"c{i % 2 + 1}"}, [1.0, i / 10, 0.0, 0.0]) for i in range(8)],
    ])
    store.upsert_relations([Relation("NEAR", f"E{i}", f"E{(i * 3 + 1) % 8}") for i in range(8)] + [Relation("FAR", "E0", f"E{i}") for i in range(1, 8)])
    queries = {1: [1.0, 0.0, 0.0, 0.0], 2: [1.0, 0.8, 0.0, 0.0], 3: [1.0, 0.2, 0.0, 0.0]}
    table = spark.createDataFrame(list(queries.items()), "query_id int, embedding array<double>")
    for limit in (None, 2):
        rows = store.retrieve_table(table, 3, limit_per_hit=limit).collect()
        for number, vector_ in queries.items():
            mine = sorted(tuple(r)[1:] for r in rows if r.query_id == number)
            assert mine == sorted(map(tuple, store.retrieve(vector_, 3, limit_per_hit=limit).collect()))
    assert "source_text" not in store.retrieve_table(table, 3, include_text=False).columns


def test_approximate_search(spark, graph, tmp_path):
    path = str(tmp_path / "index")
    LshIndex.build(graph, 6, path, tables=12, cells=2)
    index = LshIndex(spark, path)
    read = 0
    for query in QUERIES[:2]:
        exact = brute(graph, query)
        got = rounded(index.search(graph, query, 10).collect())
        assert set(got) <= set(exact) and got == sorted(got, key=lambda r: (-r[1], r[0]))
        assert len({score for _, score in got} & {score for _, score in exact[:10]}) >= 1
        read += index.candidates(query).select("vid").distinct().count()
    assert got[:10] == exact[:10]
    assert read < 2 * 400
    with pytest.raises(ValueError):
        index.search(graph, [1.0])


def test_approximate_recall(spark, tmp_path):
    """Near neighbours are found although only a part of the rows is read."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    rows = [(f"n{i:04d}", (centres[i % 40] + 0.15 * rng.normal(size=32)).tolist()) for i in range(2000)]
    frame = spark.createDataFrame(rows, "name string, e array<float>")
    nodes = shape_vertices(frame, "T", F.col("name"), name=F.col("name"), embedding=F.col("e"))
    mine = PropertyGraph(nodes, spark.createDataFrame([], EDGE_SCHEMA))
    index = LshIndex.build(mine, 32, str(tmp_path / "index"))
    found, read = 0, 0
    for c in range(3):
        query = centres[c].tolist()
        wanted = {r.vid for r in vector.vector_query(mine, query, 10).collect()}
        found += len(wanted & {r.vid for r in index.search(mine, query, 10).collect()})
        read += index.candidates(query).select("vid").distinct().count()
    assert found >= 24
    assert read < 0.6 * 3 * 2000


@pytest.mark.parametrize("bad", [None, [], ["a"], [1.0, float("nan")], [True]])
def test_bad_vectors(bad):
    with pytest.raises(ValueError):
        check_vector(bad)


def test_best_rows_are_kept_by_blocks_of_queries(spark, graph, monkeypatch):
    """Adding rows for one block of queries leaves those of the others alone."""
    best = nearest.Best(2)
    for block, number in ((0, 0), (128, 130), (0, 0)):
        best.add(block, np.array([number] * 3), np.array(["b", "a", "c"], object), np.array(["T"] * 3, object), np.array([0.5, 0.5, 0.9]))
    rows = [tuple(r.values()) for batch in best.batches() for r in batch.to_pylist()]
    assert rows == [(0, "c", "T", 0.9), (0, "c", "T", 0.9), (130, "c", "T", 0.9), (130, "a", "T", 0.5)]
    queries = np.random.default_rng(5).normal(size=(300, 6)).tolist()
    table = spark.createDataFrame(list(enumerate(queries)), "query_id long, embedding array<double>")
    got = {(r.query_id, r.vid) for r in nearest.nearest_join(graph, table, 1).collect()}
    assert got == {(i, brute(graph, queries[i], None)[0][0]) for i in (0, 127, 128, 299)} | {x for x in got if x[0] not in (0, 127, 128, 299)}
    assert len(got) == 300
