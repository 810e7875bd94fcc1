"""Stored tables, document sources and SQL parameters."""

import pytest
from pyspark.sql import DataFrame, functions as F

from conftest import column
from knotwork.functions.props import prop
from knotwork.model import EDGE_SCHEMA, PropertyGraph, shape_edges, shape_vertices
from knotwork.operators import sizes
from knotwork.operators.delete import plan_records, plan_types
from knotwork.operators.lookup import nodes_by_ids
from knotwork.operators.merge import upsert_nodes
from knotwork.operators.scans import schema_summary, schema_table
from knotwork.plans.nodes import EntityNode, Relation
from knotwork.plans.property_store import PropertyStore
from knotwork.plans.sql import query_views, run_sql
from knotwork.session import cut_lineage, tune
from knotwork.sources.documents import chunk_batch, json_vertices, read_text, write_text
from knotwork.sources.store import FILES, GraphStore


def small(spark, names, label="N"):
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    edges = shape_edges(rows, "LOOP", F.concat(F.lit(f"{label}/"), "n"), F.concat(F.lit(f"{label}/"), "n"))
    return PropertyGraph(shape_vertices(rows, label, F.col("n"), name=F.col("n")), edges)


def test_text_files_are_put_in_place_by_the_tasks(spark, tmp_path):
    """No folder for a file and no checksum file beside it; a name's texts in a task share a file."""
    rows = [(i, f"text {i}\n") for i in range(2500)] + [(7, "more"), (3000, None), (3001, "")]
    write_text(spark.createDataFrame(rows, "n long, text string").coalesce(1), f"{tmp_path}/texts",
               F.col("n").cast("string"), F.col("text"))
    files = [p for p in (tmp_path / "texts").rglob("*") if p.is_file()]
    assert len(files) == 2502 and len({p.parent for p in files}) == 3
    read = {int(r.file_name.split("_")[0]): r.text for r in read_text(spark, f"{tmp_path}/texts").collect()}
    assert sorted(read.pop(7).split("\n")) == ["", "", "more", "text 7"]
    assert read == {n: (text or "") + "\n" for n, text in rows if n != 7}


def test_written_texts_are_listed_by_the_tasks(spark, tmp_path, monkeypatch):
    """The plan holds folders and no files; rows and paths are those of Spark's own source."""
    rows = [(f"{i} é%", f"text {i}\n") for i in range(1200)] + [("_x", "left out"), (".y", "left out"), ("none", None)]
    folder = f"{tmp_path}/texts of é"
    write_text(spark.createDataFrame(rows, "n string, text string").coalesce(1), folder, F.col("n"), F.col("text"))
    read = read_text(spark, folder)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "InMemoryFileIndex" not in plan and read.rdd.getNumPartitions() == 2
    monkeypatch.setattr("knotwork.sources.documents._shelves", lambda path: [])
    own = read_text(spark, folder)
    assert "FileScan" in own._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, own.collect()))
    assert read.count() == 1201 and read.columns == own.columns


def test_both_ways_is_one_scan(spark, tmp_path):
    rows = [("R", "N/1", "N/2", {}), ("R", "N/2", "N/2", {})]
    spark.createDataFrame(rows, EDGE_SCHEMA).write.parquet(f"{tmp_path}/edges")
    graph = PropertyGraph(small(spark, ["1", "2"]).vertices, spark.read.parquet(f"{tmp_path}/edges"))
    none = spark.createDataFrame([], "kind string, label string, property string")
    found = query_views(graph, "SELECT v.vid, n.vid AS other FROM V v, LATERAL both_v(v.vid) n", catalogue=none)
    assert sorted(map(tuple, found.collect())) == [("N/1", "N/2"), ("N/2", "N/1"), ("N/2", "N/2")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.count("Relation [") for line in plan.splitlines() if "src#" in line) == 1


def test_shuffles_are_read_in_small_parts(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    tune(spark)
    assert int(spark.conf.get(key)) == 16 * 1024 * 1024
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 800
    spark.conf.set(key, "8m")
    try:
        assert tune(spark).conf.get(key) == "8m"
    finally:
        spark.conf.unset(key)
        tune(spark)


def test_missing_graph(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        GraphStore(spark, str(tmp_path / "none"), create=False)
    GraphStore(spark, str(tmp_path / "new"))
    assert GraphStore(spark, str(tmp_path / "new"), create=False).graph().vertices.count() == 0


def files_of(path):
    return {str(f.relative_to(path)) for kind in ("vertices", "edges") for f in (path / kind).rglob("*.parquet")}


def scanned_rows(df):
    """Rows that the scan of a collected plan put out."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_only_touched_parts_change(spark, tmp_path):
    path = tmp_path / "g"
    store = GraphStore(spark, str(path), parents={"N": "Base"}, buckets=4)
    names = [f"n{i}" for i in range(20)]
    store.overwrite(small(spark, names))
    odd = "odd label/=%"
    store.append("vertices", small(spark, ["c"], odd).vertices)
    store.note("vertices", small(spark, ["c"], odd).vertices)
    before = files_of(path)
    store.replace("vertices", small(spark, ["c"], odd).vertices)
    changed = before ^ files_of(path)
    assert len(changed) == 2 and len({f.rsplit("/", 1)[0] for f in changed}) == 1
    again = GraphStore(spark, str(path), create=False)
    assert again.buckets == 4 and again.parents == {"N": "Base"}
    assert column(again.graph().vertices, "key") == sorted([*names, "c"])
    assert column(again.graph(["N"]).vertices, "key") == sorted(names)
    parts = spark.createDataFrame([("N", 2)], "label string, bucket int")
    one = again.part("vertices", parts)
    assert one.count() == one.where(F.pmod(F.xxhash64("vid"), F.lit(4)) == 2).count() > 0
    assert "dynamicpruning" in one._jdf.queryExecution().executedPlan().toString()
    found = again.catalogue().where(F.col("label") == odd).collect()
    assert {(r.kind, r.property) for r in found} == {("vertex", None), ("vertex", "name")}
    assert column(again.labels("vertices"), "label") == sorted(["N", odd]) and column(again.labels("edges"), "label") == ["LOOP"]
    store.append("edges", small(spark, ["n1"]).edges)
    held = len(files_of(path))
    store.compact()
    assert len(files_of(path)) < held and store.graph().edges.count() == 21


def test_a_part_may_lose_all_rows(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"), buckets=2)
    both = small(spark, ["a", "b", "c"])
    store.overwrite(both.with_vertices(both.vertices.union(small(spark, ["x"], "M").vertices)))
    store.remove(plan_types(["N", "LOOP"]))
    assert column(store.graph().vertices, "key") == ["x"] and store.graph().edges.count() == 0
    store.remove(plan_types(["N", "none"]))
    store.append("vertices", small(spark, ["b"]).vertices)
    assert column(store.graph().vertices, "key") == ["b", "x"]
    # What comes from the store may replace it.
    store.overwrite(store.graph().with_vertices(store.graph().vertices.where("label = 'M'")))
    assert column(store.graph().vertices, "key") == ["x"] and column(store.labels("vertices"), "label") == ["M"]
    store.truncate()
    assert store.graph().vertices.count() == 0 and store.catalogue().count() == 0


def test_few_deletions_move_no_rows(spark, tmp_path, monkeypatch):
    """Rows that stay are written by the tasks that read them; edges are found without a join."""
    store = GraphStore(spark, str(tmp_path / "g"))
    names = [f"n{i:04}" for i in range(500)]
    store.overwrite(small(spark, names))
    moved, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, name, *rest: moved.append(name) or hint(df, name, *rest))
    removal = plan_records(store.graph(), ["N/n0007", "N/n0499"])
    gone, lost = store.doomed(removal)
    plan = removal.doomed_edges(store.graph(), gone, True, gone.count())._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and lost.count() == 2
    store.remove(removal)
    assert "rebalance" not in moved
    left = sorted(set(names) - {"n0007", "n0499"})
    assert column(store.graph().vertices, "key") == left
    assert column(store.graph().edges, "src") == [f"N/{n}" for n in left]
    stored = spark.read.parquet(f"{tmp_path}/g/vertices").where("live").withColumn("file", F.input_file_name())
    for row in stored.groupBy("file").agg(F.collect_list("vid").alias("vids")).collect():
        assert row.vids == sorted(row.vids)


def test_many_deletions_are_gathered(spark, tmp_path, monkeypatch):
    """Keys that do not fit in memory are joined by a shuffle, and parts are put together after it."""
    monkeypatch.setattr(sizes, "MAX_BROADCAST_BYTES", 0)
    store = GraphStore(spark, str(tmp_path / "g"))
    store.overwrite(small(spark, ["a", "b", "c"]))
    store.remove(plan_records(store.graph(), ["N/b"]))
    assert column(store.graph().vertices, "key") == ["a", "c"]
    assert column(store.graph().edges, "src") == ["N/a", "N/c"]


def test_names_of_properties_are_noted_by_sets(spark, tmp_path):
    """Rows are reduced to their sets of names before a row becomes many."""
    store = GraphStore(spark, str(tmp_path / "g"))
    rows = spark.createDataFrame([("a", {"x": "1"}), ("b", {"x": "2", "y": "3"}), ("c", {}), ("d", None)],
                                 "n string, p map<string,string>")
    store.append("vertices", cut_lineage(shape_vertices(rows, "N", F.col("n"), props=F.col("p"))))
    noted = {(r.kind, r.label, r.property) for r in store.catalogue().collect()}
    assert noted == {("vertex", "N", None), ("vertex", "N", "x"), ("vertex", "N", "y")}


def test_a_broken_write_leaves_the_old_rows(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"))
    store.overwrite(small(spark, ["a", "b"]))
    broken = store.graph().vertices.withColumn("name", F.when(F.col("key") == "b", F.raise_error(F.lit("lost"))).otherwise("new"))
    with pytest.raises(Exception, match="lost"):
        store.replace("vertices", broken)
    assert column(store.graph().vertices, "name") == ["a", "b"]


def test_session_settings_do_not_matter(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    try:
        for mode in ("dynamic", "static"):
            spark.conf.set(key, mode)
            store = GraphStore(spark, str(tmp_path / mode))
            store.overwrite(small(spark, ["a"]))
            store.replace("vertices", small(spark, ["b"], "M").vertices)
            assert column(store.graph().vertices, "key") == ["a", "b"]
            store.truncate()
            assert store.graph().vertices.count() == 0
    finally:
        spark.conf.set(key, before)


def test_lookups_skip_stored_rows(spark, tmp_path, monkeypatch):
    """Ten ids or names out of 100,000 rows: sorted row groups and Bloom filters leave the rest unread."""
    monkeypatch.setitem(FILES, "parquet.block.size", str(64 * 1024))
    rows = spark.range(0, 100_000, 1, 2).select(F.sha2(F.col("id").cast("string"), 256).alias("n"), F.xxhash64("id").cast("string").alias("m"))
    vertices = shape_vertices(rows, "N", F.col("n"), name=F.col("m"), id=F.reverse("n"))
    store = GraphStore(spark, str(tmp_path / "g"))
    store.overwrite(PropertyGraph.empty(spark).with_vertices(vertices))
    some = vertices.where(F.col("vid").substr(1, 4).isin("N/00", "N/ab")).limit(10).collect()
    for name in ("vid", "id", "name"):
        wanted = [r[name] for r in some]
        found = store.graph().vertices.where(F.col(name).isin(*wanted)).select("vid")
        assert column(found, "vid") == sorted(r.vid for r in some)
        found = store.graph().vertices.where(F.col(name).isin(*wanted)).select("vid")
        found.collect()
        assert scanned_rows(found) < 10_000, name
    ids = [r.id for r in some]
    asked = nodes_by_ids(store.graph(), ids)
    assert column(asked, "vid") == sorted(r.vid for r in some)


def test_very_many_types(spark, tmp_path):
    """A hundred thousand types: written, listed and joined without passing the driver."""
    store = GraphStore(spark, str(tmp_path / "g"))
    rows = spark.range(100_000).select(F.concat(F.lit("T"), "id").alias("label"), F.lit("1").alias("key"))
    store.note("vertices", cut_lineage(shape_vertices(rows, F.col("label"), F.col("key"), name=F.col("label"))))
    table = schema_table(store.graph(), known=store.catalogue())
    assert table.where("kind = 'vertex' AND array_contains(properties, 'name')").count() == 100_000
    with pytest.raises(ValueError, match="types"):
        schema_summary(store.graph(), known=store.catalogue())
    assert len(schema_summary(store.graph(), known=store.catalogue().where("label < 'T10'"))["vertex_types"]) == 4
    # A statement over few of them collects only those.
    found = query_views(store.graph(), "SELECT count(name) AS n FROM T77", catalogue=store.catalogue())
    assert found.first().n == 0


def test_small_and_large_batches_merge_alike(spark, tmp_path, monkeypatch):
    states = []
    for i, limit in enumerate((sizes.MAX_BROADCAST_BYTES, 0)):
        monkeypatch.setattr(sizes, "MAX_BROADCAST_BYTES", limit)
        store = PropertyStore(spark, str(tmp_path / f"g{i}"), buckets=3)
        store.upsert_nodes([EntityNode(f"n{k}", "N", {"a": k}) for k in range(9)])
        store.upsert_nodes([EntityNode(f"n{k}", "N", {"b": k}) for k in range(6, 12)] + [EntityNode("n1", "M")])
        store.upsert_relations([Relation("KNOWS", f"n{k}", " n5") for k in range(9)])
        store.upsert_relations([Relation("KNOWS", "n1", "n5"), Relation("KNOWS", "n3", "n4")])
        store.delete(ids=["n3"])
        assert store.graph.edges.count() == 8
        states.append(sorted((r.vid, sorted(r.props.items())) for r in store.graph.vertices.collect()))
    assert states[0] == states[1] and len(states[0]) == 12


def test_open_store_sees_other_writers(spark, tmp_path):
    reader = PropertyStore(spark, str(tmp_path / "g"))
    writer = PropertyStore(spark, str(tmp_path / "g"))
    writer.upsert_nodes([EntityNode("a", "N")])
    assert column(reader.get(), "name") == ["a"]
    reader.upsert_nodes([EntityNode("b", "N")])
    assert column(writer.get(), "name") == ["a", "b"]


def test_labels_prune_partitions(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"))
    both = small(spark, ["a"])
    store.overwrite(both.with_vertices(both.vertices.union(small(spark, ["b"], "M").vertices)))
    plan = store.graph().vertices.where("label = 'M'").select("name")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ReadSchema: struct<name:string,live:boolean>" in plan
    assert store.graph().vertices.where("label = 'M'").inputFiles()


def test_text_files(spark, tmp_path):
    (tmp_path / "one.txt").write_text("first line\nsecond “line”", encoding="utf8")
    (tmp_path / "two.txt").write_text("other", encoding="utf8")
    documents = read_text(spark, str(tmp_path)).withColumn("seq", F.crc32("file_name"))
    assert column(documents, "file_name") == ["one.txt", "two.txt"]
    batch = chunk_batch(documents, F.col("file_name"), F.lit("doc"), F.col("seq"), ["file_name", "file_type"])
    chunks = upsert_nodes(PropertyGraph.empty(spark), batch).vertices
    row = chunks.where("id = 'one.txt'").first()
    assert row.text == 'first line\nsecond "line"'
    assert (row.ref_doc_id, row.props["file_type"]) == ("doc", "text/plain")


def test_json_content(spark):
    body = '{"name": "Doc", "embedding": [0.5, 1], "age": 3, "meta": {"type": "pdf"}, "gone": null}'
    row = json_vertices(spark.createDataFrame([("1", body)], "k string, body string"), "body", "Document", F.col("k"))
    found = row.select("vid", "name", "embedding", "props", F.get_json_object(prop("meta"), "$.type").alias("kind")).first()
    assert (found.vid, found.name, found.embedding, found.kind) == ("Document/1", "Doc", [0.5, 1.0], "pdf")
    assert set(found.props) == {"age", "meta"} and found.props["age"] == "3"


def test_sql_parameters(spark):
    spark.createDataFrame([("a", 10), ("b", 20)], "name string, age int").createOrReplaceTempView("ages")
    assert column(run_sql(spark, "SELECT name FROM ages WHERE age > :low", {"low": 15}), "name") == ["b"]
    assert column(run_sql(spark, "SELECT name FROM ages WHERE name = ? OR age = ?", {"x": "a", "y": 20}, positional=True), "name") == ["a", "b"]
    assert run_sql(spark, "SELECT name FROM ages").count() == 2
