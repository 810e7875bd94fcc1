"""Derived records: links to the source, digests, text and the file format."""

import base64
import gzip
import hashlib
import html
import json
import random
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from knotwork.llm import warc
from knotwork.llm.queries import QUERIES


class Reader(HTMLParser):
    """The visible words of a page, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.silent, self.words, self.links = 0, [], 0

    def handle_starttag(self, tag, attrs):
        self.silent += tag in ("script", "style", "head")
        if tag in ("a", "img", "link", "script", "iframe", "form"):
            self.links += any(k in ("href", "src", "action") for k, _ in attrs)
        if tag in ("p", "br", "li", "div", "h1", "article", "footer", "nav", "ul"):
            self.words.append(" ")

    def handle_endtag(self, tag):
        self.silent -= tag in ("script", "style", "head")
        if tag in ("p", "li", "div", "h1", "article", "footer", "nav", "ul"):
            self.words.append(" ")

    def handle_data(self, data):
        if not self.silent:
            self.words.append(data)


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGES = [
    (1, "http://a.example/x/y?q=1", "<html><head><title>T &amp; U</title><style>p{}</style></head><body><nav><a href='/n'>n</a></nav>"
     "<p>One<b>bold</b> &lt;two&gt;<br>three</p><script>var t='</p>';</script><!-- no --><img src=i.png></body></html>"),
    (2, None, None), (3, "not a uri [", ""), (4, "http://b.example/", "plain & simple\n\n  text"), (5, "u", "<p>open <b"),
    (6, "http://c.example/", "<p>" + "long words " * 100_000), (6, "http://c.example/", "<div>é</div><a href='http://[bad'>x</a>"),
]


@pytest.fixture(scope="module")
def records(spark):
    pages = spark.createDataFrame([(*p, "x", 3) for p in PAGES], "page_id long, url string, html string, block string, links int")
    return warc.page_records(pages.repartition(3)).collect()


def test_records_refer_to_their_source(records):
    assert len(records) == 2 * len(PAGES)
    by = {}
    for r in records:
        by.setdefault((r.row.page_id, r.row.html), {})[r.record_type] = r
    for page_id, url, html in PAGES:
        meta, text = by[page_id, html]["metadata"], by[page_id, html]["conversion"]
        assert meta.refers_to == text.refers_to and len({meta.record_id, text.record_id, meta.refers_to}) == 3
        assert meta.target_uri == text.target_uri == url
        assert meta.payload_digest == text.payload_digest == sha((html or "").encode())
        for r in (meta, text):
            assert r.block_digest == sha(r.block.encode()) and r.content_length == len(r.block.encode())
        source = json.loads(meta.block)
        assert source["source"]["WARC-Record-ID"] == meta.refers_to
        assert source["source"]["WARC-Payload-Digest"] == meta.payload_digest
        assert source["http"]["status"] == 200 and source["http"]["headers"]["content-length"] == str(len((html or "").encode()))
        assert source["text"]["words"] == len(text.block.split())
    first = json.loads(by[1, PAGES[0][2]]["metadata"].block)["html"]
    assert first["title"] == "T & U"
    assert [x["url"] for x in first["links"]] == ["http://a.example/n", "http://a.example/x/i.png"]
    assert by[1, PAGES[0][2]]["conversion"].block == "n\nOnebold <two>\nthree"
    assert by[4, PAGES[3][2]]["conversion"].block == "plain & simple\ntext"
    assert by[2, None]["conversion"].block == ""


def test_file_round_trip(spark, records, tmp_path):
    response = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://a/\r\nContent-Length: 42\r\n\r\n"
                b"HTTP/1.1 404 Gone\r\nX: y\r\n\r\n<p>not here</p>\r\n\r\n")
    derived = [warc.as_bytes(r.asDict()) for r in records[:4]]
    (tmp_path / "a.warc").write_bytes(response + b"".join(derived))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in [response, *derived]))
    for name in ("a.warc", "b.warc.gz"):
        parsed = list(warc.parse_file((tmp_path / name).read_bytes()))
        assert [p["block"].decode() for p in parsed[1:]] == [r.block for r in records[:4]]
        assert parsed[1]["headers"]["WARC-Refers-To"] == records[0].refers_to
    rows = warc.read_responses(spark, str(tmp_path))
    out = warc.derive(rows, F.col("headers")["WARC-Target-URI"], F.col("headers")["WARC-Record-ID"], F.lit(None).cast("string"),
                      F.col("http"), F.col("payload")).collect()
    assert len(out) == 4
    assert {r.block for r in out if r.record_type == "conversion"} == {"not here"}
    assert {json.loads(r.block)["http"]["status"] for r in out if r.record_type == "metadata"} == {404}
    assert {r.refers_to for r in out} == {"<urn:uuid:1>"}


def test_empty_table(spark):
    assert warc.page_records(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.skipif(not TESTDATA.exists(), reason="no test tables")
def test_query_against_the_standard_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{TESTDATA}/pages.parquet").collect()}
    rows = QUERIES["op3_warc_derivatives"](spark, str(TESTDATA)).collect()
    assert len(rows) == 2 * len(pages)
    for r in rows:
        page = pages[r.page_id]
        assert r.payload_digest == sha(page.html.encode()) and r.target_uri == page.url
        if r.record_type == "conversion":
            reader = Reader()
            reader.feed(page.html)
            assert r.block.split() == "".join(reader.words).split()
            assert r.links == reader.links


# One backtracking pattern for each step: slow on hostile pages, plain to read.
SILENT = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|head|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
LINK = re.compile(r"<(a|link|img|script|iframe|form)\b[^>]*?\b(href|src|action)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.S | re.I)


def test_steps_equal_backtracking_patterns():
    rng = random.Random(4)
    tokens = ["<a ", "<A", "<img", "<script", "</script", "<style>", "</style >", "<!--", "-->", "<p", "<p>", "</p>", "<title", "<title>",
              "</title>", "</TITLE", ">", "<", " ", "\n", "href", "src=", "href = ", "'", '"', "=", "x", "action='y'", "<head>", "</head\t>", "<template a>"]
    for _ in range(20_000):
        page = "".join(rng.choices(tokens, k=rng.randrange(1, 16)))
        silent = SILENT.sub(" ", page)
        assert warc.without_silent(page) == silent, page
        found = TITLE.search(page)
        assert warc.title_of(page) == (found[1] if found else None), page
        assert list(warc.links_of(page)) == LINK.findall(page), page
        text = warc.TAG.sub("", warc.BREAK.sub("\n", silent))
        lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
        assert warc.plain_text(page) == "\n".join(line for line in lines if line), page


@pytest.mark.parametrize("piece", ["<a ", "<script ", "<title>", "<title ", "<p ", "<!--", "<a href=\"", "<a href='x ", "<style>", "</title <title ",
                                   "<script></script ", "<a href", "<a x>", "<", "&lt", "<img src= >"])
def test_hostile_pages(piece):
    for page in (piece * (1_000_000 // len(piece)), piece * (1_000_000 // len(piece)) + ">"):
        began = time.time()
        warc.derive_one("http://a/", "<urn:uuid:1>", None, None, page.encode())
        assert time.time() - began < 8


def test_date_and_digests_are_written(spark):
    pages = spark.createDataFrame([("http://a/", "<p>x</p>")], "url string, html string")
    for r in warc.page_records(pages, date="2024-05-06T07:08:09Z").collect():
        head = warc.as_bytes(r.asDict()).split(b"\r\n\r\n")[0].decode().split("\r\n")
        assert "WARC-Date: 2024-05-06T07:08:09Z" in head and f"WARC-Payload-Digest: {r.payload_digest}" in head
        assert r.date == "2024-05-06T07:08:09Z"
