"""Traversal, ranking and merges against brute force on small random graphs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from knotwork.model import EDGE_SCHEMA, PropertyGraph, shape_vertices
from knotwork.operators import delete, lookup, merge, scans, traverse
from knotwork.operators.ranking import first_rows, top_per_group


def random_graph(spark, seed, vertices=25, edges=60):
    """Vertex 0 is a hub: a third of all edges end there."""
    rng = random.Random(seed)
    pairs = {
        (rng.choice("AB"), rng.randrange(vertices), 0 if rng.random() < 0.33 else rng.randrange(vertices))
        for _ in range(edges)
    }
    rows = sorted((label, f"N/{a:02d}", f"N/{b:02d}") for label, a, b in pairs)
    frame = spark.createDataFrame([(i, f"{i:02d}") for i in range(vertices)], "i int, name string")
    nodes = shape_vertices(frame, "N", F.col("name"), name=F.col("name"), props=F.create_map(F.lit("i"), F.col("i").cast("string")))
    return PropertyGraph(nodes, spark.createDataFrame([(*r, {}) for r in rows], EDGE_SCHEMA)), rows


@pytest.mark.parametrize("seed", [1, 2])
def test_k_hop(spark, seed):
    graph, rows = random_graph(spark, seed, 30, 35)
    around = {}
    for _, a, b in rows:
        around.setdefault(a, set()).add(b)
        around.setdefault(b, set()).add(a)
    starts = ["N/03", "N/07"]
    depth, level = {s: 0 for s in starts}, set(starts)
    for d in range(1, 4):
        level = {n for v in level for n in around.get(v, ())} - set(depth)
        depth |= {v: d for v in level}
    frame = graph.vertices.where(F.col("vid").isin(*starts))
    assert {r.vid: r.depth for r in traverse.k_hop(graph, frame, 3).collect()} == depth


def all_paths(rows, starts, depth):
    walks, found = [(s, (), ()) for s in starts], []
    for length in range(1, depth + 1):
        walks = [
            (start, steps + (label, b), used + ((label, a, b),))
            for start, steps, used in walks for label, a, b in rows
            if a == (steps[-1] if steps else start) and (label, a, b) not in used
        ]
        found += [(length, start, steps) for start, steps, _ in walks]
    return sorted(found)


@pytest.mark.parametrize("seed, depth, limit", [(3, 2, 5), (4, 3, 7), (5, 3, None), (6, 2, 40)])
def test_paths(spark, seed, depth, limit):
    graph, rows = random_graph(spark, seed)
    starts = ["N/00", "N/01", "N/02"]
    wanted = all_paths(rows, starts, depth)[:limit]
    frame = graph.vertices.where(F.col("vid").isin(*starts))
    got = traverse.paths(graph, frame, depth, limit, final_target=False).collect()
    assert sorted((r.length, r.start, tuple(r.path)) for r in got) == wanted


def test_bounded_and_unbounded_starts_agree(spark):
    graph, rows = random_graph(spark, 8)
    starts = graph.vertices.where(F.col("vid").isin("N/00", "N/05")).select("vid")
    wanted = sorted(r for r in rows if {r[1], r[2]} & {"N/00", "N/05"})
    for found in (traverse.touching(graph.edges, starts), traverse.touching(graph.edges, starts, 2)):
        assert sorted((r.label, r.src, r.dst) for r in found.collect()) == wanted
    assert traverse.touching(graph.edges, starts.limit(0), 2).count() == 0
    refs = spark.createDataFrame([("00",), ("05",)], "ref string")
    maps = [
        sorted((r.source.vid, r.relation.label, r.target.vid) for r in traverse.rel_map(graph, refs, bound=b, limit=9).collect())
        for b in (2, None)
    ]
    assert maps[0] == maps[1] and len(maps[0]) == 9


def test_long_id_lists_take_the_join(spark, monkeypatch):
    graph, _ = random_graph(spark, 9)
    ids = ["03", "04", "gone"]
    for limit in (1000, 1):
        monkeypatch.setattr(lookup, "MAX_LITERALS", limit)
        monkeypatch.setattr(delete, "MAX_LITERALS", limit)
        assert sorted(r.name for r in lookup.nodes_by_ids(graph, ids).collect()) == ["03", "04"]
        assert sorted(r.name for r in lookup.nodes_in_list(graph, "name", ids).collect()) == ["03", "04"]
        for remove in (delete.delete_ids, delete.delete_names):
            left = remove(graph, ids)
            assert left.vertices.count() == 23
            assert left.edges.where("src in ('N/03', 'N/04') or dst in ('N/03', 'N/04')").count() == 0
        assert delete.delete_records(graph, ["N/03", "N/04"]).vertices.count() == 23


def test_top_per_group_with_a_hot_group(spark):
    rows = spark.range(3000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.xxhash64("id").alias("v"),
    )
    got = Counter(r.g for r in top_per_group(rows, ["g"], [F.col("v")], 7).collect())
    assert set(got.values()) == {7}
    best = {r.v for r in top_per_group(rows, ["g"], [F.col("v")], 7).where("g = 'hot'").collect()}
    hot = sorted(r.v for r in rows.where("g = 'hot'").collect())
    assert best == set(hot[:7])


def batch(spark, rows):
    return merge.batch_of(
        spark.createDataFrame(rows, "seq long, label string, name string, a string, b string"), merge.NODE_BATCH,
        kind=F.lit("entity"), label=F.col("label"), name=F.col("name"), seq=F.col("seq"),
        props=F.create_map(F.lit("a"), F.col("a"), F.lit("b"), F.col("b")),
    )


def state(graph):
    return sorted((r.vid, tuple(sorted(r.props.items()))) for r in graph.vertices.select("vid", "props").collect())


@pytest.mark.parametrize("known", [None, ["a", "b"]])
def test_upsert_equals_one_pass_over_the_rows(spark, known):
    """Hot key, split batches and repetition all give the state of a plain loop."""
    rng = random.Random(11)
    rows = [
        (i, "x", "hot" if rng.random() < 0.4 else f"n{rng.randrange(12)}",
         rng.choice([None, f"a{i}"]), rng.choice([None, None, f"b{i}"])) for i in range(240)
    ]
    expected = {}
    for _, label, name, a, b in rows:
        props = expected.setdefault(f"{label.upper()}/{name}", {})
        props.update({k: v for k, v in (("a", a), ("b", b)) if v is not None})
    wanted = sorted((vid, tuple(sorted(p.items()))) for vid, p in expected.items())
    empty = PropertyGraph.empty(spark)
    once = merge.upsert_nodes(empty, batch(spark, rows), known)
    assert state(once) == wanted
    halves = merge.upsert_nodes(merge.upsert_nodes(empty, batch(spark, rows[:100]), known), batch(spark, rows[100:]), known)
    assert state(halves) == wanted
    assert state(merge.upsert_nodes(once, batch(spark, rows), known)) == wanted


def test_catalogue_and_samples(spark):
    graph, _ = random_graph(spark, 12)
    assert {(r.kind, r.label, r.parent) for r in scans.catalogue(graph).collect()} == {
        ("vertex", "N", "Entity"), ("vertex", "Entity", None), ("vertex", "TextChunk", None),
        ("edge", "A", None), ("edge", "B", None), ("edge", "MENTIONS", None),
    }
    assert [r.name for r in scans.sample_names(graph).orderBy("name").collect()] == ["00", "01", "02", "03", "04"]
    assert sum(r.degree for r in traverse.degree(graph).collect()) == 2 * graph.edges.count()


@pytest.mark.parametrize("n", [5, 40, 41, 333, 999, 1000, 1001, 5000])
def test_large_limits_are_cut_by_ranges(spark, n, monkeypatch):
    """The same rows, in order, as one sort of all of them; no task sorts them all."""
    monkeypatch.setattr("knotwork.operators.ranking.ONE_TASK", 40)
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000 % 10).alias("a"), (F.col("id") * 31 % 1000).alias("b"), F.lit("x" * 50).alias("c"))
    got = first_rows(rows.repartition(6), ["a", F.desc("b")], n)
    assert [(r.a, r.b) for r in got.collect()] == sorted(((i * 7919 % 1000 % 10, i * 31 % 1000) for i in range(1000)), key=lambda r: (r[0], -r[1]))[:n]
    if n == 999:  # only the range that is cut is sorted again
        assert "_range" in got._jdf.queryExecution().executedPlan().toString()
    assert first_rows(rows.limit(0), ["a", "b"], n).count() == 0


def test_nested_properties_are_typed(spark):
    from knotwork.functions.props import nested_field, with_nested

    bodies = ['{"n": 1.5, "list": [1, "x", null], "deep": {"a": {"b": true}}}', '{"n": "1.5"}', "no json", "", None, "[7, 8]", "null"]
    rows = spark.createDataFrame([(i, {"body": b} if b is not None else {}) for i, b in enumerate(bodies)], "i int, props map<string,string>")
    fields = {"n": ("$.n", "double"), "first": ("$.list[0]", "int"), "word": ("$.list[1]", "int"), "b": ("$.deep.a.b", "boolean"),
              "size": ("$", "array<int>"), "far": ("$.list[9]", "int")}
    got = with_nested(rows, parsed="body").select("i", *[nested_field("parsed", *f).alias(n) for n, f in fields.items()]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [
        (1.5, 1, None, True, None, None), (1.5, None, None, None, None, None), (None,) * 6, (None,) * 6, (None,) * 6,
        (None, None, None, None, [7, 8], None), (None,) * 6]


def test_deleted_ids_are_found_once_and_sent_to_the_edges(spark):
    from knotwork.sources.tables import tables_graph
    from conftest import TESTDATA

    graph = tables_graph(spark, str(TESTDATA))
    nations = [r.name for r in graph.vertices.where("label = 'NATION'").orderBy("name").select("name").collect()]
    first, last = nations[0], nations[-1]
    names = spark.createDataFrame([(first,), (last,)], "ref string")
    ends = F.col("src").isin(f"NATION/{first}", f"NATION/{last}") | F.col("dst").isin(f"NATION/{first}", f"NATION/{last}")
    assert not graph.edges.where(ends).isEmpty()
    for left in (delete.plan_names(graph, [first, last]).apply(graph), delete.plan_names(graph, names).apply(graph)):
        plan = left.edges._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert left.edges.where(ends).isEmpty()
        assert left.vertices.where("label = 'NATION'").count() == len(nations) - 2


def test_edges_of_other_types_stay_out_of_hops(spark):
    graph, rows = random_graph(spark, 4, 30, 35)
    other = spark.createDataFrame([("A", f"X/{i}", f"Y{i}/0", {}) for i in range(1200)], EDGE_SCHEMA)
    more = graph.with_edges(graph.edges.union(other))
    start = graph.vertices.where(F.col("vid") == "N/03")
    assert traverse.types_among(start) == ["N"]
    assert traverse.at_types(more.edges, ["N"], "src", "dst").count() == len(rows)
    assert traverse.types_among(other.select(F.col("dst").alias("vid"))) is None
    wanted = sorted(map(tuple, traverse.k_hop(graph, start, 3).collect()))
    assert sorted(map(tuple, traverse.k_hop(more, start, 3).collect())) == wanted
    all_x = spark.createDataFrame([("X/0",)], "vid string")
    assert {(r.vid, r.depth) for r in traverse.k_hop(more, all_x, 2).collect()} == {("X/0", 0), ("Y0/0", 1)}
    starts = other.select(F.col("dst").alias("vid"))
    assert traverse.k_hop_neighbors(more, starts, 1).count() == 2400


def test_walks_carry_no_second_copy_of_their_edges(spark):
    """A path is told from its steps: parallel edges and missing labels count as edges of their own."""
    rows = [("A", "N/1", "N/2"), ("B", "N/1", "N/2"), (None, "N/2", "N/1"), ("A", "N/2", "N/2")]
    edges = spark.createDataFrame([(*r, {}) for r in rows], EDGE_SCHEMA)
    start = spark.createDataFrame([("N/1",)], "vid string")
    found = traverse.paths(PropertyGraph(start, edges), start, 4, None, final_target=False)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "used#" not in plan
    longest = [tuple(r.path) for r in found.where("length = 4").collect()]
    assert sorted(longest, key=str) == sorted([
        ("A", "N/2", None, "N/1", "B", "N/2", "A", "N/2"), ("B", "N/2", None, "N/1", "A", "N/2", "A", "N/2"),
        ("A", "N/2", "A", "N/2", None, "N/1", "B", "N/2"), ("B", "N/2", "A", "N/2", None, "N/1", "A", "N/2")], key=str)
