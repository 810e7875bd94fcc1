"""Label, name and punctuation rules on literal cases."""

import pytest
from pyspark.sql import functions as F

from knotwork.functions import text

NORMALIZED = [
    ("Harbour Software", "Harbour"), ("  Acme Inc ", "Acme"), ("Acme Inc.", "Acme"), ("Acme Corp", "Acme"),
    ("Acme Corp.", "Acme"), ("Acme Ltd", "Acme"), ("Acme Ltd.", "Acme"), ("Acme LLC", "Acme"),
    ("Acme Company", "Acme"), ("Acme Co.", "Acme"), ("Acme Co", "Acme Co"),
    ("Acme Corporation", "Acme Corporation"), ("Foo Ltd LLC", "Foo Ltd"), ("AB Inc", "AB Inc"),
    ("ABC Inc", "ABC"), ("Acme  Inc", "Acme"), ("acme software", "acme software"),
    ("Apple ({'type': 'COMPANY'})", "Apple"), ("Apple Inc. ({'a': 1})", "Apple"), ("Apple ({})", "Apple ({})"),
    ("\tTabbed Name\n", "Tabbed Name"), (" Wide ", "Wide"), ("Inc", "Inc"), (" Inc", "Inc"),
    ("({'only': 'data'})", ""), ("a\nb Inc", "a\nb"),
]

CLASSIFIED = [
    ("Microsoft Corp", "ORGANIZATION"), ("Orange County", "ORGANIZATION"), ("Data Protocol", "ORGANIZATION"),
    ("Falcon", "ORGANIZATION"), ("the prince", "ORGANIZATION"), ("Space Agency", "ORGANIZATION"),
    ("MIT", "ORGANIZATION"), ("NASA HQ", "Entity"), ("A", "Entity"), ("X1", "ORGANIZATION"), ("42", "Entity"),
    ("open systems", "ORGANIZATION"), ("a system", "TECHNOLOGY"), ("REST API", "TECHNOLOGY"),
    ("capital", "TECHNOLOGY"), ("Apollo Project", "PROJECT"), ("project", "Entity"), ("new program", "PROJECT"),
    ("Mexico", "ORGANIZATION"), ("York City", "LOCATION"), ("steady state", "LOCATION"), ("Steve Jobs", "Entity"),
    ("", "Entity"),
]

LABELS = [
    ("person", "PERSON"), (" Works-For me ", "WORKS_FOR_ME"), ("Entity", "ENTITY"), ("a/b", None), ("", None),
    ("  ", None), ("__", None), ("café", "CAFÉ"), ("x.y", None), ("v2", "V2"), (None, None),
]


def evaluate(spark, cases, expression):
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, given string")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("given"))).collect()]


@pytest.mark.parametrize("cases, expression", [
    (NORMALIZED, text.normalize_name), (CLASSIFIED, text.classify_name), (LABELS, text.canonical_label),
])
def test_rules(spark, cases, expression):
    got = evaluate(spark, cases, expression)
    assert [(c[0], g) for c, g in zip(cases, got)] == cases


def test_label_beats_pattern(spark):
    rows = spark.createDataFrame([("Person", "Acme Corp"), ("?!", "Acme Corp"), (None, "Bob")], "label string, name string")
    got = [r[0] for r in rows.select(text.entity_label(F.col("label"), F.col("name"))).collect()]
    assert got == ["PERSON", "ORGANIZATION", "Entity"]


def test_punctuation_is_the_same_for_columns_and_literals(spark):
    given = "a–b—c ‘x’ “y” plain"
    folded = "a-b--c 'x' \"y\" plain"
    assert evaluate(spark, [(given,)], text.fold_punctuation) == [folded]
    assert text.fold_literal(given) == folded


def test_relation_name(spark):
    assert evaluate(spark, [("works for",), ("KNOWS",)], text.relation_name) == ["WORKS_FOR", "KNOWS"]


def test_rows_of_a_small_file_are_spread(spark):
    from workload.rules import spread

    rows = spark.range(1000).coalesce(1)
    assert spread(rows).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in spread(rows).collect()) == list(range(1000))
