"""The triple store on a small food web: a cycle, an animal that eats its own kind, and a
plant that many eat."""

from conftest import column

WEB = [
    ("pike", "eats", "perch"), ("perch", "eats", "shrimp"), ("shrimp", "eats", "algae"), ("pike", "eats", "pike"),
    ("heron", "preys on", "perch"), ("heron", "preys on", "pike"), ("snail", "eats", "algae"), ("algae", "feeds", "snail"),
]


def fill(triples):
    triples.upsert_triplets(WEB)


def test_get(triples):
    fill(triples)
    triples.upsert_triplet("heron", "preys on", "pike")
    found = sorted(tuple(r) for r in triples.get("heron").collect())
    assert found == [("heron", "PREYS_ON", "perch"), ("heron", "PREYS_ON", "pike")]
    assert triples.get("otter").count() == 0
    assert column(triples.graph.vertices, "id") == ["algae", "heron", "perch", "pike", "shrimp", "snail"]


def test_blank_parts_are_left_out(triples):
    triples.upsert_triplets([(None, "eats", "reed"), ("vole", " ", "reed"), ("vole", "eats", ""), ("vole", None, "reed"), ("vole", "eats", "reed")])
    assert column(triples.graph.vertices, "id") == ["reed", "vole"]
    assert [tuple(r) for r in triples.get("vole").collect()] == [("vole", "EATS", "reed")]


def test_rel_map(triples):
    fill(triples)
    rows = triples.get_rel_map(["snail"], depth=3).collect()
    # The last target stands after every relation; no relation is used twice.
    assert sorted((r.length, list(r.path)) for r in rows) == [
        (1, ["EATS", "algae"]), (2, ["EATS", "snail", "FEEDS", "snail"]),
    ]
    assert triples.get_rel_map(["pike", "heron"], depth=1).count() == 4
    assert triples.get_rel_map(["pike", "heron"], depth=2, limit=5).count() == 5
    assert triples.get_rel_map(None).count() == 0


def test_delete_removes_orphans_only(triples):
    fill(triples)
    triples.delete("heron", "preys on", "pike")
    assert "pike" in column(triples.graph.vertices, "id")
    triples.delete("heron", "PREYS_ON", "perch")
    assert column(triples.graph.vertices, "id") == ["algae", "perch", "pike", "shrimp", "snail"]
    triples.delete("pike", "no such", "perch")
    assert triples.get("pike").count() == 2


def test_schema_and_query(triples):
    fill(triples)
    assert "PREYS_ON" in triples.get_schema()
    found = triples.query("SELECT dst FROM FEEDS WHERE src = ?", {"who": "Entity/algae"}).collect()
    assert [r.dst for r in found] == ["Entity/snail"]
    triples.upsert_triplet("otter", "hunts", "pike")
    assert "HUNTS" not in triples.get_schema() and "HUNTS" in triples.get_schema(refresh=True)
    triples.clear()
    assert triples.graph.vertices.count() == 0
