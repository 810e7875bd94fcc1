"""WARC derivatives: metadata and plain-text conversion records of response records.

Each response gives one ``metadata`` record (a JSON block with the source record's headers,
the HTTP status and headers, title, links and text counts) and one ``conversion`` record (the
plain text).  Both refer to the response by its record id, carry its target URI and date, and
have digests of their own block beside the payload digest of the source.  Record ids follow
from the response's id, so reruns and retried tasks give the same records.

Defined cases: a null payload is empty and gives records with an empty text; a null URI leaves
out the header and the links stay as written; null or malformed HTTP headers give status null;
bytes that do not decode are replaced; pages of any length are read whole, in time that grows
with their length whatever is left unclosed; repeated responses give repeated records; an empty
table gives an empty result; input columns may have any names (they come back inside ``row``).
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, MapType, StringType, StructField, StructType

from knotwork.llm.common import whole_row

VERSION = "WARC/1.1"
NAMESPACE = uuid.UUID("5b0a7d6c-7a43-4d3a-9a52-0d6c4b1f9e21")

# What is never text, and elements after which a line ends.  No pattern here scans further than
# what it takes: where a tag, an element or a value ends is looked up once.
SILENT = re.compile(r"<!--|<(script|style|head|noscript|template)\b", re.I)
CLOSING = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "head", "noscript", "template")}
BREAK = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|tr|table|h[1-6]|nav|article|section|header|footer|blockquote|pre|title|body|html)\b[^>]*>", re.I)
TAG = re.compile(r"<[a-zA-Z/!?][^>]*>?")
TITLE, TITLE_END = re.compile(r"<title\b[^>]*>", re.I), re.compile(r"</title", re.I)
LINKING = re.compile(r"<(a|link|img|script|iframe|form)\b", re.I)
LINK_NAME = re.compile(r"\b(href|src|action)\s*=\s*", re.I)
LINK_VALUE = re.compile(r"\"[^\"]*\"|'[^']*'|[^\s>]+")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)

RECORD = StructType([
    StructField("record_type", StringType()), StructField("record_id", StringType()), StructField("refers_to", StringType()),
    StructField("target_uri", StringType()), StructField("date", StringType()), StructField("content_type", StringType()), StructField("payload_digest", StringType()),
    StructField("block_digest", StringType()), StructField("content_length", LongType()), StructField("links", LongType()),
    StructField("block", StringType()),
])
SOURCE = StructType([
    StructField("headers", MapType(StringType(), StringType())), StructField("http", StringType()), StructField("payload", BinaryType()),
])


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(parts))}>"


def without_silent(page: str) -> str:
    """A page with a space for each comment, script and the like; unclosed ones reach its end."""
    parts, at, search = [], 0, 0
    while (found := SILENT.search(page, search)) is not None:
        if found[1] is None:
            end = page.find("-->", found.end())
            end = len(page) if end < 0 else end + 3
        else:
            opened = page.find(">", found.end())
            if opened < 0:  # not a tag; only comments can follow
                search = found.end()
                if (comment := page.find("<!--", search)) < 0:
                    break
                search = comment
                continue
            closed = CLOSING[found[1].lower()].search(page, opened + 1)
            end = closed.end() if closed else len(page)
        parts += [page[at:found.start()], " "]
        at = search = end
    return "".join([*parts, page[at:]])


def plain_text(page: str) -> str:
    """The visible text: block elements end lines, white space is collapsed, empty lines go."""
    text = without_silent(page)
    last = text.rfind(">") + 1  # no tag ends after it
    text = TAG.sub("", BREAK.sub("\n", text[:last]) + text[last:])
    lines = (" ".join(line.split()) for line in entities.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def title_of(page: str) -> str | None:
    """What stands between the first title tag and the next title end, if there are both."""
    end = None
    for end in TITLE_END.finditer(page):
        pass
    last = page.rfind(">", 0, end.start()) + 1 if end else 0
    opened = TITLE.search(page, 0, last)
    return page[opened.end():TITLE_END.search(page, opened.end()).start()] if opened else None


def links_of(page: str) -> Iterator[tuple[str, str, str]]:
    """(element, attribute, value as written): the first link attribute after each linking element
    and before the tag ends."""
    at = 0
    while (found := LINKING.search(page, at)) is not None:
        end = page.find(">", found.end())
        end = len(page) if end < 0 else end
        name, value = LINK_NAME.search(page, found.end(), end), None
        while name is not None and (value := LINK_VALUE.match(page, name.end())) is None:
            name = LINK_NAME.search(page, name.end(), end)
        if name is not None:
            yield found[1], name[1], value[0]
        at = end if value is None else value.end()


def parse_http(head: str | None) -> tuple[int | None, dict[str, str]]:
    """Status and headers of an HTTP head; names in lower case, the last of equal names wins."""
    lines = (head or "").replace("\r\n", "\n").split("\n")
    status = re.match(r"HTTP/\S+\s+(\d{3})", lines[0])
    headers = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:]) if k.strip())
    return (int(status[1]) if status else None), headers


def _decoded(payload: bytes, headers: dict[str, str]) -> str:
    said = CHARSET.search(headers.get("content-type", "")) or CHARSET.search(payload[:1024].decode("latin-1"))
    try:
        return payload.decode(said[1] if said else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive_one(uri: str | None, identity: str, date: str | None, head: str | None, payload: bytes) -> list[dict]:
    """The metadata and the conversion record of one response."""
    status, headers = parse_http(head)
    page = _decoded(payload, headers)
    text, title = plain_text(page), title_of(page)
    links = []
    for tag, name, value in links_of(page):
        target = entities.unescape(value.strip("\"'").strip())
        try:
            target = urljoin(uri or "", target)
        except ValueError:  # not a URI: kept as written
            pass
        links.append({"path": f"{tag.lower()}@{name.lower()}", "url": target})
    source = digest(payload)
    metadata = json.dumps({
        "source": {"WARC-Type": "response", "WARC-Record-ID": identity, "WARC-Target-URI": uri, "WARC-Date": date,
                   "WARC-Payload-Digest": source, "Payload-Length": len(payload)},
        "http": {"status": status, "headers": headers},
        "html": {"title": " ".join(entities.unescape(title).split()) if title is not None else None, "links": links},
        "text": {"words": len(text.split()), "lines": text.count("\n") + 1 if text else 0},
    }, ensure_ascii=False, sort_keys=True)
    out = []
    for kind, mime, block in (("metadata", "application/json", metadata), ("conversion", "text/plain", text)):
        raw = block.encode("utf-8", "replace")
        out.append({
            "record_type": kind, "record_id": record_id(identity, kind), "refers_to": identity, "target_uri": uri, "date": date,
            "content_type": mime, "payload_digest": source, "block_digest": digest(raw), "content_length": len(raw),
            "links": len(links), "block": raw.decode(),
        })
    return out


@F.arrow_udf(ArrayType(RECORD))
def _derivatives(uris: pa.Array, ids: pa.Array, dates: pa.Array, heads: pa.Array, payloads: pa.Array) -> pa.Array:
    rows = [
        derive_one(uri.as_py(), identity.as_py() or record_id(uri.as_py() or ""), date.as_py(), head.as_py(), payload.as_py() or b"")
        for uri, identity, date, head, payload in zip(uris, ids, dates, heads, payloads)
    ]
    strings = {f.name: pa.int64() if isinstance(f.dataType, LongType) else pa.string() for f in RECORD}
    return pa.array(rows, pa.list_(pa.struct(list(strings.items()))))


def derive(responses: DataFrame, uri: Column, identity: Column, date: Column, http: Column, payload: Column) -> DataFrame:
    """Each input row as ``row`` with its two derived records, the columns of RECORD."""
    made = _derivatives(uri.cast("string"), identity, date, http, payload.cast("binary"))
    return responses.select(whole_row(responses), F.explode(made).alias("record")).select("row", "record.*")


def as_bytes(record: dict, date: str | None = None) -> bytes:
    """A record in the WARC file format; ``date`` stands for one that the record lacks."""
    named = [
        ("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Refers-To", record["refers_to"]),
        ("WARC-Target-URI", record["target_uri"]), ("WARC-Date", record["date"] or date), ("WARC-Block-Digest", record["block_digest"]),
        ("WARC-Payload-Digest", record["payload_digest"]),
        ("Content-Type", record["content_type"]), ("Content-Length", str(record["content_length"])),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in named if v is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + record["block"].encode() + b"\r\n\r\n"


def parse_file(data: bytes) -> Iterator[dict]:
    """Records of a WARC file (plain, or one gzip member or more): headers and block."""
    if data[:2] == b"\x1f\x8b":
        members, rest = [], data
        while rest:
            unpack = zlib.decompressobj(31)
            members.append(unpack.decompress(rest) + unpack.flush())
            rest = unpack.unused_data
        data = b"".join(members)
    at = data.find(b"WARC/")
    while at >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = dict((k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines))
        size = int(headers.get("Content-Length") or 0)
        yield {"headers": headers, "block": data[end + 4:end + 4 + size]}
        at = data.find(b"WARC/", end + 4 + size)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """(headers, http, payload) of the response records of WARC files, one file per task at a time."""

    def parse(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for r in parse_file(content.as_py()):
                    if r["headers"].get("WARC-Type") == "response":
                        head, _, payload = r["block"].partition(b"\r\n\r\n")
                        rows.append({"headers": list(r["headers"].items()), "http": head.decode("latin-1"), "payload": payload})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    ("headers", pa.map_(pa.string(), pa.string())), ("http", pa.string()), ("payload", pa.binary())]))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, SOURCE)


def page_records(pages: DataFrame, url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Derivatives of a table of fetched pages, taken as successful HTML responses.

    The response's record id follows from the URL and the page, its date is a parameter
    because such a table has none.
    """
    link, page = F.col(f"`{url}`").cast("string"), F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    hashed = F.md5(F.concat(F.coalesce(link, F.lit("")).cast("binary"), F.unhex(F.lit("00")), page))
    identity = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(hashed, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(page).cast("string"), F.lit("\r\n"))
    return derive(pages, link, identity, F.lit(date), head, page)
