"""The coder against the library called on whole texts, and raw-byte round trips."""

import base64
import hashlib
import time

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from conftest import TESTDATA
from knotwork.llm import bpe
from knotwork.llm.queries import QUERIES, rank_file


@pytest.fixture(scope="module")
def whole():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", " ", "\n\n\n", "a", "don't stop  now\t\tok \n x", "<|endoftext|>", "é ñ 　 x", "\x1c\x1d a\x85b",
    "word " * 30_000, "x" * 50_000, " " * 50_000 + "y", "ab cd\n" * 20_000 + "   ", "🙂 🙂🙂", "same", "same",
]


def test_same_ids_as_whole_texts_and_exact_round_trip(spark, whole):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    encode, decode, round_trip = bpe.coder(spark, *rank_file())
    both = {r.doc_id: r.b for r in docs.select("doc_id", round_trip("text").alias("b")).collect()}
    rows = docs.select("doc_id", encode("text").alias("ids")).withColumn("raw", decode("ids")).collect()
    for row in rows:
        text = TEXTS[row.doc_id]
        assert (both[row.doc_id].ids, both[row.doc_id].raw) == (row.ids, row.raw)
        if text is None:
            assert row.ids is None and row.raw is None
        else:
            assert row.ids == whole.encode_ordinary(text)
            assert bytes(row.raw) == text.encode()


def test_parts_cut_only_where_ids_stay_the_same(whole):
    for text in filter(None, TEXTS):
        cut = list(bpe.parts(text, 7))
        assert "".join(cut) == text
        if len(text) < 40_000 or " " in text:
            assert [i for part in cut for i in whole.encode_ordinary(part)] == whole.encode_ordinary(text)


def test_long_runs_of_white_space(spark, whole):
    """Runs that the pattern can still take, against whole texts; longer ones against their piece."""
    encode, _, round_trip = bpe.coder(spark, *rank_file())
    middle = [f"{a}{w * 3000}{b}" for w in (" ", "\n", "\t", "\u3000", " \n", "\x85", "\x1c") for a in ("", "a", "a b ") for b in ("", "b", "\nc", "1")]
    middle += ["x" + " " * 1023 + "y", " " * 1024, (" " * 1500 + "ab\n") * 5]
    rows = spark.createDataFrame([(t,) for t in middle], "text string").select("text", encode("text").alias("ids")).collect()
    assert len(rows) == len(middle) and all(r.ids == whole.encode_ordinary(r.text) for r in rows)
    one = tiktoken.Encoding("one", pat_str="(?s:.+)", mergeable_ranks=whole._mergeable_ranks, special_tokens={})
    long_ = [c * 2_000_000 + w for c in " \n\t" for w in ("", "word")]
    began = time.time()
    got = spark.createDataFrame([(t,) for t in long_], "text string").select("text", round_trip("text").alias("b")).collect()
    assert time.time() - began < 60 and len(got) == len(long_)
    for r in got:
        run, word = (r.text[:1_999_999], r.text[1_999_999:]) if r.text[-1] == "d" else (r.text, "")
        assert r.b.ids == one.encode_ordinary(run) + whole.encode_ordinary(word)
        assert bytes(r.b.raw) == r.text.encode()


def test_ids_without_valid_text_decode_to_raw_bytes(spark, whole):
    ids = [whole.encode_single_token(b"\xe2"), whole.encode_single_token(b"a")]
    _, decode, _ = bpe.coder(spark, *rank_file())
    row = spark.createDataFrame([(ids,)], "ids array<int>").select(decode("ids").alias("raw")).first()
    assert bytes(row.raw) == b"\xe2a"


def test_query_digests(spark, whole):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    rows = QUERIES["op7_byte_bpe"](spark, str(TESTDATA)).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = whole.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_empty_table_and_other_columns(spark):
    from knotwork.llm.queries import bpe_digests

    empty = spark.createDataFrame([], "doc_id long, text string, ids int, raw string")
    assert bpe_digests(spark, empty).collect() == []
    one = spark.createDataFrame([(None, None, 1, "x")], "doc_id long, text string, ids int, raw string")
    row = bpe_digests(spark, one).first()
    assert row.n_tokens == 0 and row.ids_sha256 == row.decoded_sha256 == hashlib.sha256(b"").hexdigest()
