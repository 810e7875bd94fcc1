"""The store's behaviour on small literal graphs.

The graph is a harbour: a vessel that is a hub, two relations between one pair of ends, a
vessel that follows itself, and relations to a port that does not exist.
"""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import column
from knotwork.functions.props import prop
from knotwork.model import edge_id
from knotwork.plans.nodes import ChunkNode, EntityNode, LabelledNode, Relation
from knotwork.plans.property_store import PropertyStore

CREW = [f"Mate {i}" for i in range(130)]


def harbour(store):
    store.upsert_nodes([
        EntityNode("Skua", "VESSEL", {"length": 31}), EntityNode("Tern", "VESSEL", {"length": 18}),
        EntityNode("Hull", "PORT"), EntityNode("Bergen", "PORT"), *[EntityNode(m, "SAILOR") for m in CREW],
    ])
    store.upsert_relations([
        Relation("SAILS_TO", "Skua", "Hull"), Relation("CALLS_AT", "Skua", "Hull", {"berth": "7"}),
        Relation("SAILS_TO", "Skua", "Bergen"), Relation("FOLLOWS", "Skua", "Skua"), Relation("FOLLOWS", "Tern", "Skua"),
        Relation("REGISTERED_IN", "Tern", "Bergen"), Relation("SAILS_TO", "Tern", "Atlantis"),
        *[Relation("SERVES_ON", m, "Skua") for m in CREW],
    ])


def triplet_set(store, **filters):
    return {tuple(r) for r in store.get_triplets(**filters).collect()}


SHIPPING = {
    ("Skua", "SAILS_TO", "Hull"), ("Skua", "CALLS_AT", "Hull"), ("Skua", "SAILS_TO", "Bergen"),
    ("Skua", "FOLLOWS", "Skua"), ("Tern", "FOLLOWS", "Skua"), ("Tern", "REGISTERED_IN", "Bergen"),
}


def test_get_by_id_takes_names_as_stored(store):
    store.upsert_nodes([EntityNode("Gannet Ltd", "VESSEL"), ChunkNode("She was launched in May.", "log-9")])
    assert column(store.get(ids=["Gannet"]), "label") == ["VESSEL"]
    assert store.get(ids=["Gannet Ltd"]).count() == 0
    assert [(r.label, r.text) for r in store.get(ids=["log-9"]).collect()] == [("TextChunk", "She was launched in May.")]
    assert store.get(ids=["log-10"]).count() == 0


def test_get_by_properties(store):
    store.upsert_nodes([
        EntityNode("Skua", "VESSEL", {"length": 31, "steam": True}), EntityNode("Tern", "VESSEL", {"length": 31.0, "steam": False}),
        EntityNode("Hull", "PORT", {"length": 900, "depth": "10.0000001"}),
    ])
    assert column(store.get(properties={"name": "Skua"}), "name") == ["Skua"]
    assert column(store.get(properties={"length": 31}), "name") == ["Skua", "Tern"]
    assert column(store.get(properties={"length": 31, "steam": True}), "name") == ["Skua"]
    assert store.get(properties={"beam": "x"}).count() == 0
    # Nothing is rounded before integers are compared.
    assert store.get(properties={"depth": 10}).count() == 0
    assert store.get(properties={"depth": 10.0000001}).count() == 1


def test_limits_can_be_lifted(store):
    harbour(store)
    assert store.get().groupBy("label").count().where("label = 'SAILOR'").first()["count"] == 50
    assert store.get(limit_per_type=None).count() == len(CREW) + 4
    assert store.get(limit_per_type=1).count() == 3
    serving = {(m, "SERVES_ON", "Skua") for m in CREW}
    assert len(triplet_set(store)) == 100 + len(SHIPPING)
    assert triplet_set(store, limit_per_type=None) == SHIPPING | serving
    # A filter says what is wanted, so it is not cut.
    assert triplet_set(store, entity_names=["Skua"]) == SHIPPING - {("Tern", "REGISTERED_IN", "Bergen")} | serving
    assert len(triplet_set(store, entity_names=["Skua"], limit_per_type=2)) == 2 + 2 + 1 + 2


def test_relations(store):
    harbour(store)
    store.upsert_relations([
        Relation("SAILS_TO", " Skua", "Hull", {"later": "1"}), Relation(" ", "Skua", "Hull"), Relation(None, "Skua", "Hull"),
        Relation("VESSEL", "Tern", "Hull"), Relation("PERSON", "Tern", "Hull"), Relation("TextChunk", "Tern", "Hull"),
    ])
    # Types that are declared without any row are vertex types too.
    assert triplet_set(store, ids=["Tern"]) == {
        ("Tern", "FOLLOWS", "Skua"), ("Tern", "REGISTERED_IN", "Bergen"), ("Tern", "VESSEL_REL", "Hull"),
        ("Tern", "PERSON_REL", "Hull"), ("Tern", "TextChunk_REL", "Hull"),
    }
    kept = store.graph.edges.where("label IN ('SAILS_TO', 'CALLS_AT') AND dst = 'PORT/Hull'")
    assert {r.label: r.props for r in kept.collect()} == {"SAILS_TO": {}, "CALLS_AT": {"berth": "7"}}


def test_one_namespace_in_both_orders(store, spark):
    harbour(store)
    for label in ("FOLLOWS", "MENTIONS"):
        with pytest.raises(ValueError, match="edge type"):
            store.upsert_nodes([LabelledNode("x", label)])
    rows = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="edge type"):
        store.bulk_insert("SAILS_TO", rows, F.col("id").cast("string"), F.create_map())
    assert store.structured_query("SELECT count(*) AS n FROM FOLLOWS").first().n == 2


def test_triplet_filters(store):
    harbour(store)
    assert triplet_set(store, relation_names=["FOLLOWS"]) == {t for t in SHIPPING if t[1] == "FOLLOWS"}
    assert triplet_set(store, ids=["Hull"], relation_names=["SAILS_TO"]) == {("Skua", "SAILS_TO", "Hull")}
    assert triplet_set(store, entity_names=["Hull"]) == {t for t in SHIPPING if t[2] == "Hull"}
    typed = store.get_triplets_by_type(["VESSEL"], None, ["VESSEL"])
    assert {tuple(r) for r in typed.collect()} == {t for t in SHIPPING if t[1] == "FOLLOWS"}


def test_rel_map_honours_depth(store):
    harbour(store)

    def shown(ref="Tern", limit=None, **options):
        rows = store.get_rel_map([ref, "absent"], limit=limit or 1_000, **options).collect()
        return {(r.source.name, r.relation.label, r.target.name) for r in rows}

    near = {t for t in SHIPPING if "Tern" in t}
    far = SHIPPING | {(m, "SERVES_ON", "Skua") for m in CREW}
    assert shown(depth=1) == near and shown() == far and shown(depth=2) == far
    assert shown(depth=2, one_hop=True) == near
    assert shown(one_hop=True, ignore_rels=["FOLLOWS"]) == near - {("Tern", "FOLLOWS", "Skua")}
    assert shown(one_hop=True, limit=1, ignore_rels=["FOLLOWS"]) == set()
    assert len(shown(limit=30)) == 30


def test_dynamic_types_and_schema(store):
    store.upsert_nodes([EntityNode("Dogger Bank", "FISHERY", {"area": 17600}), EntityNode("Nordkap Corp", "")])
    schema = store.get_schema()
    types = {t["name"]: t["properties"] for t in schema["vertex_types"]}
    assert set(types) == {"Entity", "TextChunk", "PERSON", "ORGANIZATION", "LOCATION", "PLACE", "FISHERY"}
    assert types["FISHERY"] == ["area", "name"]
    assert [t["name"] for t in schema["edge_types"]] == ["MENTIONS"]
    assert {(e["type"], e["name"]) for e in schema["sample_entities"]} == {("ORGANIZATION", "Nordkap"), ("FISHERY", "Dogger Bank")}
    assert schema["entity_count"] == 2
    assert column(store.get_entity_names(), "name") == ["Dogger Bank", "Nordkap"]


def test_vector_query(store):
    vectors = {"Skua": [2, 0, 0, 1], "Tern": [2, 0, 1, 1], "Hull": [0, 3, 0, 0]}
    store.upsert_nodes([
        *[EntityNode(n, "VESSEL" if n != "Hull" else "PORT", embedding=v) for n, v in vectors.items()], EntityNode("Bare", "VESSEL"),
        ChunkNode("wide", "c5", embedding=[1, 1, 1, 1, 1]), ChunkNode("near", "c4", embedding=[2, 0, 0, 1]),
    ])
    query = np.array([4.0, 0, 1, 2])
    want = {n: query @ v / np.linalg.norm(query) / np.linalg.norm(v) for n, v in vectors.items()}
    hits = store.vector_query(query.tolist(), 2).collect()
    assert [r.name for r in hits] == sorted(vectors, key=lambda n: -want[n])[:2]
    assert hits[0].score == pytest.approx(want[hits[0].name], abs=1e-6)
    assert store.vector_query([], 2).count() == store.vector_query(None).count() == 0
    assert store.vector_query([1, 0, 0, 0]).count() == 3
    assert store.get(ids=["c5"]).first().embedding is None
    with pytest.raises(ValueError):
        store.vector_query([1.0, 2.0], 2)
    assert store.get_vector_similarity("VESSEL/Skua", [4, 0, 0, 2]).first().similarity == pytest.approx(1.0, abs=1e-6)


def test_batch_search_takes_base_types(spark, tmp_path):
    store = PropertyStore(spark, str(tmp_path / "g"), parents={"Craft": None, "SLOOP": "Craft"})
    store.upsert_nodes([EntityNode("a", "Sloop", embedding=[1, 0]), EntityNode("b", "SLOOP", embedding=[0, 1])])
    searches = [{"type_name": t, "query_embedding": [1, 0.1], "top_k": k} for t, k in (("Craft", 1), ("SLOOP", 2), ("Entity", 2))]
    got = sorted((r.search, r.vid) for r in store.batch_vector_search(searches).collect())
    assert got == [(0, "SLOOP/a"), (1, "SLOOP/a"), (1, "SLOOP/b")]


def test_structured_query(store):
    harbour(store)
    store.upsert_nodes([ChunkNode("x", "k1", {"ref_doc_id": "d1"})])
    found = store.structured_query("""
        SELECT v.name AS vessel, p.name AS port FROM VESSEL v, PORT p, SAILS_TO s
        WHERE s.src = v.vid AND s.dst = p.vid""").collect()
    assert {tuple(r) for r in found} == {("Skua", "Hull"), ("Skua", "Bergen")}
    assert [r.id for r in store.structured_query("SELECT id FROM TextChunk WHERE ref_doc_id = 'd1'").collect()] == ["k1"]
    long_ = store.structured_query("SELECT name FROM VESSEL WHERE CAST(length AS INT) > :least", {"least": 20})
    assert column(long_, "name") == ["Skua"]
    assert store.structured_query("SELECT count(*) AS n FROM Entity").first().n == len(CREW) + 4


def test_views_belong_to_one_store_and_statement(store, spark, tmp_path):
    store.upsert_nodes([
        EntityNode("a", "VESSEL", {"label": "mine", "Role": "x", "role": "y", "Vid": "z"}), LabelledNode("b", "Dock"), LabelledNode("c", "DOCK"),
    ])
    other = PropertyStore(spark, str(tmp_path / "other"))
    other.upsert_nodes([EntityNode("z", "PORT")])
    row = store.structured_query("SELECT label, vid, Role, props FROM VESSEL").first()
    assert (row.label, row.vid, row.Role) == ("VESSEL", "VESSEL/a", "x") and row.props["role"] == "y"
    with pytest.raises(Exception, match="VESSEL"):
        other.structured_query("SELECT * FROM VESSEL").collect()
    with pytest.raises(ValueError, match="one name"):
        store.structured_query("SELECT * FROM Dock")
    assert spark.catalog.listTables() == []


def test_retrieve_counts_relations_per_hit(store):
    harbour(store)
    store.upsert_nodes([
        ChunkNode("about Skua", "c1"), EntityNode("Skua", "VESSEL", {"triplet_source_id": "c1"}, [1, 0, 0, 0]),
        EntityNode("Bergen", "PORT", {}, [1, 0.1, 0, 0]),
    ])
    rows = store.retrieve([1, 0, 0, 0], 2, limit_per_hit=3).collect()
    assert len([r for r in rows if "Bergen" in (r.subject, r.object)]) >= 2
    assert {r.source_text for r in rows if r.subject == "Skua" or r.object == "Skua"} == {"about Skua"}
    everything = store.retrieve([1, 0, 0, 0], 2, limit_per_hit=None).count()
    assert everything == len(CREW) + len(SHIPPING) + 1
    assert "source_text" not in store.retrieve([1, 0, 0, 0], 1, include_text=False).columns


def test_plain_record_writes(store, spark):
    schema, key = "no int, name string, tons int, vec array<float>", F.col("no").cast("string")
    props = F.create_map(F.lit("tons"), F.col("tons").cast("string"))

    def give(rows):
        return spark.createDataFrame(rows, schema)

    first = give([(1, "Auk", 300, [1.0] * 4), (2, "Rail", 250, [1.0]), (None, "lost", 1, None)])
    assert store.bulk_insert("Barge", first, key, props, name=F.col("name"), embedding=F.col("vec")) == 2
    for again in ([(2, "Rail", 1, None)], [(7, "a", 1, None), (7, "b", 2, None)]):
        with pytest.raises(ValueError, match="already"):
            store.bulk_insert("Barge", give(again), key, props, name=F.col("name"))
    newer = give([(2, "Rail", 260, None), (3, "Coot \u2013 II", None, None), (None, "lost", 1, None)])
    assert store.bulk_upsert("Barge", newer, key, F.lit(1), props, name=F.col("name")) == 2
    for label in ("a/b", " "):
        with pytest.raises(ValueError, match="type"):
            store.bulk_upsert(label, newer, key, F.lit(1), props)
    rows = {r.key: r for r in store.get_records("Barge").collect()}
    assert {k: (r.name, r.props) for k, r in rows.items()} == {
        "1": ("Auk", {"tons": "300"}), "2": ("Rail", {"tons": "260"}), "3": ("Coot - II", {})}
    assert rows["1"].embedding == [1.0] * 4 and rows["2"].embedding is None
    heavy = store.get_records("Barge", prop("tons").try_cast("int") > 255, 10)
    assert column(heavy, "name") == ["Auk", "Rail"]


def test_update_where_reaches_declared_properties(store):
    store.upsert_nodes([EntityNode("Auk", "VESSEL", {"ref_doc_id": "old", "flag": "x", "tons": 5}), EntityNode("Rail", "VESSEL")])
    store.update_where("VESSEL", F.col("name") == "Auk", {"ref_doc_id": F.lit("new"), "flag": F.lit(None), "tons": F.lit(6)})
    assert column(store.get(properties={"ref_doc_id": "new"}), "name") == ["Auk"]
    assert store.get(properties={"ref_doc_id": "old"}).count() == 0
    assert store.get(ids=["Auk"]).first().props == {"tons": "6"}
    assert store.get(ids=["Rail"]).first().props == {}


def test_edge_ids_do_not_depend_on_separators(spark):
    edges = spark.createDataFrame([("L", "A/a|b", "A/c"), ("L", "A/a", "b|A/c")], "label string, src string, dst string")
    assert edges.select(edge_id()).distinct().count() == 2


def test_large_relation_batches_are_settled_once(store, spark, monkeypatch):
    """A batch beyond what fits in memory: the same edges, computed once, sorted by hash."""
    from knotwork.operators import merge, sizes
    from knotwork.plans import property_store

    harbour(store)
    store.upsert_nodes([ChunkNode("She was launched in May.", "Hull")])
    monkeypatch.setattr(sizes, "MAX_BROADCAST_BYTES", 0)
    settled, cut = [], property_store.cut_lineage
    monkeypatch.setattr(property_store, "cut_lineage", lambda df: settled.append(df) or cut(df))
    rows = [("CALLS_AT", "Skua", "Bergen LLC", {"berth": "2"}, 5), ("CALLS_AT", " Skua", "Bergen", {"berth": "1"}, 4),
            ("SAILS_TO", "Skua", "Bergen", None, 6), ("SAILS_TO", "Tern", "Atlantis", None, 7),
            ("SAILS_TO", "Tern", None, None, 8), ("SAILS_TO", "Tern", "Hull", None, None), (" ", "Tern", "Skua", None, 9)]
    batch = spark.createDataFrame(rows, merge.RELATION_BATCH)
    edges = [tuple(r) for r in store.graph.edges.select("label", "src", "dst").collect()]
    for _ in range(2):
        settled.clear()
        store.upsert_relations(batch)
        # The batch, its references, what they name, its labels, and the new edges.
        assert len(settled) == 5
        assert any("xxhash64" in df._jdf.queryExecution().optimizedPlan().toString() for df in settled)
        got = {(r.label, r.src, r.dst): r.props for r in store.graph.edges.collect()}
        assert store.graph.edges.count() == len(got) == len(edges) + 2
        assert got["CALLS_AT", "VESSEL/Skua", "PORT/Bergen"] == {"berth": "1"}
        assert ("SAILS_TO", "VESSEL/Tern", "TextChunk/Hull") in got


def test_refresh_computes_before_it_writes(store, monkeypatch):
    harbour(store)
    store.upsert_nodes([ChunkNode("old", "c1", {"ref_doc_id": "d1"}), EntityNode("Gone", "PORT", {"doc_id": "d1"})])
    store.refresh_documents(["d1"], [ChunkNode("new", "c2", {"ref_doc_id": "d1"}), EntityNode("Brest", "PORT", {"doc_id": "d1"})],
                            [Relation("SAILS_TO", "Tern", "Brest"), Relation("SAILS_TO", "Tern", "Gone")])
    assert triplet_set(store, ids=["Brest"]) == {("Tern", "SAILS_TO", "Brest")}
    assert store.get(ids=["Gone"]).count() == store.get(ids=["c1"]).count() == 0
    monkeypatch.setattr(PropertyStore, "_new_edges", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.refresh_documents(["d1"], [ChunkNode("newer", "c3", {"ref_doc_id": "d1"})])
    assert store.get(ids=["c2"]).count() == 1 and store.get(ids=["c3"]).count() == 0


def test_last_write_wins_per_property(store):
    store.upsert_nodes([EntityNode("Acme Inc", "company", {"a": "1", "b": "1"}, [1, 0, 0, 0])])
    store.upsert_nodes([
        EntityNode("Acme", "Company", {"b": "2"}), EntityNode(" Acme Ltd", "COMPANY", {"b": "3", "c": [1, {"x": 2}]}),
    ])
    row = store.get(properties={"name": "Acme"}).collect()
    assert len(row) == 1
    assert row[0].props == {"a": "1", "b": "3", "c": '[1, {"x": 2}]'}
    assert row[0].embedding == [1.0, 0.0, 0.0, 0.0]


def test_generic_nodes_and_reserved_properties(store):
    store.upsert_nodes([
        LabelledNode("n1", "Thing", {"name": "first", "size": 3}), LabelledNode("n1", "Thing", {"size": 4}),
        LabelledNode("", "Thing"), LabelledNode("n2", "a/b"), LabelledNode("n3", " "),
        EntityNode("   ", "PERSON"), EntityNode("({'x': 1})", "PERSON"),
        EntityNode("Bob", "PERSON", {"ref_doc_id": "d", "doc_id": "d", "triplet_source_id": "c", "name": "other"}),
    ])
    rows = {r.vid: r for r in store.graph.vertices.collect()}
    assert set(rows) == {"Thing/n1", "PERSON/Bob"}
    assert rows["Thing/n1"].name == "first" and rows["Thing/n1"].props == {"size": "4"}
    bob = rows["PERSON/Bob"]
    assert (bob.name, bob.ref_doc_id, bob.doc_id, bob.triplet_source_id, bob.props) == ("Bob", "d", "d", "c", {})


def test_provenance_edges(store):
    store.upsert_nodes([
        EntityNode("Early", "PERSON", {"triplet_source_id": "c1"}), ChunkNode("text", "c1"),
        EntityNode("Lost", "PERSON", {"triplet_source_id": "none"}),
    ])
    store.upsert_nodes([EntityNode("Later", "PERSON", {"triplet_source_id": "c1"})])
    store.upsert_nodes([EntityNode("Later", "PERSON", {"triplet_source_id": "c1"})])
    assert triplet_set(store) == {("c1", "MENTIONS", "Early"), ("c1", "MENTIONS", "Later")}


def test_minimal_schema(spark, tmp_path):
    store = PropertyStore(spark, str(tmp_path / "g"), include_basic_schema=False)
    store.upsert_nodes([EntityNode("One", "CUSTOM_TYPE")])
    assert {t["name"] for t in store.get_schema()["vertex_types"]} == {"Entity", "TextChunk", "CUSTOM_TYPE"}


def test_polymorphic_types(spark, tmp_path):
    store = PropertyStore(spark, str(tmp_path / "g"), parents={"Base1": None, "SUB1": "Base1", "SUBSUB": "SUB1"})
    store.upsert_nodes([
        EntityNode("a", "Sub1", embedding=[1, 0, 0, 0]), EntityNode("b", "SubSub", embedding=[0, 1, 0, 0]),
        EntityNode("c", "Other"),
    ])
    graph = store.graph
    assert column(graph.vertices.where(graph.in_type("Base1")), "name") == ["a", "b"]
    assert column(graph.vertices.where(graph.in_type("SUB1")), "name") == ["a", "b"]
    assert column(graph.vertices.where(graph.in_type("Entity")), "name") == ["c"]
    assert column(store.vector_search("Base1", [1, 0, 0, 0], 5), "name") == ["a", "b"]
    assert column(store.vector_search("SUBSUB", [1, 0, 0, 0], 5), "name") == ["b"]


def test_chunk_nodes(store):
    store.upsert_nodes([
        ChunkNode("one", "a", {"file_name": "f.txt", "ref_doc_id": "d"}),
        ChunkNode("two", "b", {"source": "s", "file_name": "g.txt", "file_type": "t", "file_path": "/p"}),
    ])
    rows = store.get_chunk_nodes(["b", "", "a", "gone", None, "b"]).collect()
    assert [(r.id, r.text, r.ref_doc_id, r.source, r.file_name, r.file_type, r.file_path) for r in rows] == [
        ("b", "two", "", "s", "g.txt", "t", "/p"), ("a", "one", "d", "f.txt", "f.txt", "", ""),
        ("b", "two", "", "s", "g.txt", "t", "/p"),
    ]


def test_large_properties_can_be_left_out(store):
    store.upsert_nodes([EntityNode("A", "PERSON", {"big": "x" * 1001, "edge": "y" * 1000})], max_property_length=1000)
    assert set(store.get(ids=["A"]).first().props) == {"edge"}


def people(store):
    store.upsert_nodes([
        EntityNode("P", "PERSON", {"tag": "x"}), EntityNode("O", "ORGANIZATION", {"tag": "x"}), EntityNode("Keep", "PERSON"),
        ChunkNode("1", "c1", {"ref_doc_id": "d1"}), ChunkNode("2", "c2", {"ref_doc_id": "d1"}),
        ChunkNode("3", "c3", {"ref_doc_id": "d2"}),
    ])
    store.upsert_relations([
        Relation("WORKS_FOR", "P", "O"), Relation("WORKS_FOR", "Keep", "O"), Relation("KNOWS", "Keep", "P"),
        Relation("MENTIONS", "c1", "Keep"),
    ])


@pytest.mark.parametrize("options, vertices, edges", [
    ({"entity_names": ["P", "O"]}, {"Keep", "c1", "c2", "c3"}, {"MENTIONS"}),
    ({"ids": ["P", "c2"]}, {"O", "Keep", "c1", "c3"}, {"WORKS_FOR", "MENTIONS"}),
    ({"properties": {"ref_doc_id": "d1"}}, {"P", "O", "Keep", "c3"}, {"WORKS_FOR", "KNOWS"}),
    ({"properties": {"tag": "x"}}, {"Keep", "c1", "c2", "c3"}, {"MENTIONS"}),
    ({"relation_names": ["WORKS_FOR"]}, {"P", "O", "Keep", "c1", "c2", "c3"}, {"KNOWS", "MENTIONS"}),
    ({"ids": ["c3"], "entity_names": ["P"], "relation_names": ["KNOWS"]}, {"P", "O", "Keep", "c1", "c2"},
     {"WORKS_FOR", "MENTIONS"}),
    ({"relation_names": ["PERSON"]}, {"O", "c1", "c2", "c3"}, set()),
    ({}, {"P", "O", "Keep", "c1", "c2", "c3"}, {"WORKS_FOR", "KNOWS", "MENTIONS"}),
])
def test_delete(store, options, vertices, edges):
    people(store)
    store.delete(**options)
    graph = store.graph
    assert set(column(graph.vertices, "key")) == vertices
    assert set(column(graph.edges, "label")) == edges
    vids = graph.vertices.select("vid")
    for end in ("src", "dst"):
        assert graph.edges.join(vids, graph.edges[end] == vids.vid, "left_anti").count() == 0


def test_bulk_delete_and_type_delete(store):
    people(store)
    with pytest.raises(ValueError, match="safe mode"):
        store.bulk_delete("PERSON", [])
    store.bulk_delete("PERSON", [{"tag": "x"}, {"name": "nobody"}])
    assert column(store.graph.vertices.where("label = 'PERSON'"), "name") == ["Keep"]
    assert store.delete_all_of("TextChunk") == 3
    assert store.delete_all_of("TextChunk") == 0
    store.clear()
    assert store.graph.vertices.count() == 0 and store.graph.edges.count() == 0


def test_document_refresh(store):
    store.upsert_nodes([
        ChunkNode("old", "c1", {"ref_doc_id": "d1"}), ChunkNode("else", "c9", {"ref_doc_id": "d9"}),
        EntityNode("Gone", "PERSON", {"doc_id": "d1", "triplet_source_id": "c1"}),
        EntityNode("Stays", "PERSON", {"doc_id": "d9", "triplet_source_id": "c9"}),
    ])
    store.refresh_documents(["d1"], [
        ChunkNode("new", "c2", {"ref_doc_id": "d1"}), EntityNode("Fresh", "PERSON", {"doc_id": "d1", "triplet_source_id": "c2"}),
    ], [Relation("KNOWS", "Fresh", "Stays")])
    assert triplet_set(store) == {
        ("c2", "MENTIONS", "Fresh"), ("c9", "MENTIONS", "Stays"), ("Fresh", "KNOWS", "Stays"),
    }
    assert set(column(store.graph.vertices, "key")) == {"c2", "c9", "Fresh", "Stays"}
