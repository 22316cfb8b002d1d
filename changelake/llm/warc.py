"""WARC records: reading, and derivatives of responses as metadata and conversion records.

Each response becomes a `metadata` record that describes its source, and, if it is text,
a `conversion` record with its plain text. Both refer to the response by its id, URI and
date and carry its HTTP headers and digests on. Ids are made from the source's id, so a
task that runs again makes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm.dom import VOID, Node, blocks, parse

VERSION = "WARC/1.1"
#: Between two records in a file.
_BORDER = "\r\n\r\n"
#: Elements whose text isn't shown.
_HIDDEN = frozenset("head title script style noscript template iframe object svg math textarea select".split())
_CHARSET = re.compile(rb"""<meta[^>]{0,200}?charset\s*=\s*["']?\s*([A-Za-z0-9_.:-]+)""", re.I)
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "derived WARC records")

RECORD = (
    "record_type string, record_id string, target_uri string, date string, content_type string, refers_to string,"
    " refers_to_target_uri string, refers_to_date string, block_digest string, source_payload_digest string,"
    " source_block_digest string, content_length long, block string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def response_block(body: Column, content_type: Column) -> Column:
    """HTTP message of a body, as a response record holds it."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: "), content_type, F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body).cast("binary")


def _http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status, headers in their order, and the payload as sent."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    status = (first.split(" ", 2) + ["", ""])[1] if first.startswith("HTTP/") else ""
    headers = [(name.strip(), value.strip()) for name, _, value in (line.partition(":") for line in lines) if name.strip()]
    return status, headers, body


def _unchunked(body: bytes) -> bytes:
    out, place = [], 0
    while True:
        end = body.find(b"\r\n", place)
        try:
            size = int(body[place:end].split(b";")[0], 16) if end >= 0 else 0
        except ValueError:
            return body if not out else b"".join(out)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        place = end + 4 + size


def _decoded(headers: dict[str, str], body: bytes) -> bytes:
    if "chunked" in headers.get("transfer-encoding", "").lower():
        body = _unchunked(body)
    if headers.get("content-encoding", "").lower() in ("gzip", "x-gzip", "deflate"):
        return _inflated(body)
    return body


def _inflated(body: bytes) -> bytes:
    """All members of a compressed body, with a header or without; as it is if it is neither."""
    for window in (47, -15):
        out, rest = [], body
        try:
            while rest.strip(b"\0"):
                member = zlib.decompressobj(window)
                out.append(member.decompress(rest))
                if not member.eof:
                    break
                rest = member.unused_data
        except zlib.error:
            # What follows the last whole member isn't compressed.
            if not out:
                continue
        return b"".join(out)
    return body


def _text(headers: dict[str, str], body: bytes) -> tuple[str, str]:
    """The payload's text and the charset it was read by: that of the header, of the page, or UTF-8."""
    named = re.search(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", headers.get("content-type", ""), re.I)
    in_page = _CHARSET.search(body, 0, 4096)
    for charset in (named and named[1], in_page and in_page[1].decode(), "utf-8"):
        try:
            return body.decode(charset or "utf-8", "replace"), (charset or "utf-8").lower()
        except LookupError:
            continue
    raise AssertionError("utf-8 is always known")


def plain_text(html: str) -> tuple[str, str, list[str]]:
    """Shown text with a line for each block, the title, and the targets of links."""
    root = parse(html)
    title, links, stack = "", [], [root]
    while stack:
        node = stack.pop()
        if node.tag == "title" and not title:
            title = " ".join("".join(child for child in node.children if isinstance(child, str)).split())
        if node.tag == "a" and node.attributes.get("href", "").strip():
            links.append(node.attributes["href"].strip())
        stack += [child for child in reversed(node.children) if isinstance(child, Node)]
    return "\n".join(text for _, text in blocks(root, lambda node: node.tag not in _HIDDEN and node.tag not in VOID)), title, links


def _line(value: str) -> str:
    return " ".join(value.split())


def _derived(source: dict) -> Iterator[dict]:
    block = source["block"] or b""
    status, headers, body = _http(block)
    lower = {name.lower(): value for name, value in reversed(headers)}
    payload = source["payload_digest"] or digest(body)
    whole = source["block_digest"] or digest(block)
    kind = lower.get("content-type", "").split(";")[0].strip().lower()
    linked = {
        "target_uri": source["target_uri"],
        "date": source["date"],
        "refers_to": source["record_id"],
        "refers_to_target_uri": source["target_uri"],
        "refers_to_date": source["date"],
        "source_payload_digest": payload,
        "source_block_digest": whole,
    }
    content = _decoded(lower, body)
    is_html = kind in ("text/html", "application/xhtml+xml", "") and bool(kind or content.lstrip()[:1] == b"<")
    text, title, links, charset = None, "", [], ""
    if is_html or kind.startswith("text/"):
        text, charset = _text(lower, content)
        if is_html:
            text, title, links = plain_text(text)
    fields = [("source-status", status), ("source-payload-digest", payload), ("source-block-digest", whole)]
    fields += [("source-payload-digest-valid", str(payload == digest(body)).lower())] if payload.startswith("sha1:") else []
    fields += [(f"source-header-{name.lower()}", value) for name, value in headers]
    fields += [("charset-read", charset), ("title", title)] + [("outlink", link) for link in links]
    about = "".join(f"{name}: {_line(value)}\r\n" for name, value in fields if value)
    yield linked | _made("metadata", "application/warc-fields", about, source["record_id"])
    if text is not None:
        yield linked | _made("conversion", "text/plain; charset=utf-8", text, source["record_id"])


def _made(kind: str, content_type: str, block: str, source: str | None) -> dict:
    data = block.encode("utf-8", "replace")
    return {
        "record_type": kind,
        "record_id": f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind} {source}')}>",
        "content_type": content_type,
        "block_digest": digest(data),
        "content_length": len(data),
        "block": data.decode(),
    }


def derive(responses: DataFrame, id: str | None = None) -> DataFrame:
    """The metadata and conversion records of `responses`, with the source's `id` column if one is named.

    `responses` has record_id, target_uri, date, block (the HTTP message), and payload_digest
    and block_digest, which are computed where null. A response that is no text has only a
    metadata record; an empty or null block counts as an empty message without status. A
    null URI or date stays null and is left out of a file. Repeated records give repeated
    derivatives. Other columns are not read. No shuffle.
    """
    kind = responses.schema[id].dataType.simpleString() if id else "long"
    source = responses.select(
        (F.col(id) if id else F.lit(None).cast("long")).alias("source"),
        "record_id", "target_uri", "date", F.col("block").cast("binary").alias("block"), "payload_digest", "block_digest",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORD.split(", ")]
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                made, of = [], []
                for place, row in enumerate(part.to_pylist()):
                    for record in _derived(row):
                        made.append(record)
                        of.append(place)
                arrays = [
                    pa.array([record[name] for record in made], pa.int64() if name == "content_length" else pa.string()) for name in names
                ]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of, pa.int64())), *arrays], ["source", *names])

    derived = source.mapInArrow(run, f"source {kind}, {RECORD}")
    return derived.withColumnRenamed("source", id) if id else derived.drop("source")


def record_text() -> Column:
    """A record as it stands in a file, without the border after it."""
    fields = [
        ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"),
        ("WARC-Refers-To", "refers_to"), ("WARC-Refers-To-Target-URI", "refers_to_target_uri"), ("WARC-Refers-To-Date", "refers_to_date"),
        ("WARC-Block-Digest", "block_digest"), ("WARC-Source-Payload-Digest", "source_payload_digest"),
        ("WARC-Source-Block-Digest", "source_block_digest"), ("Content-Type", "content_type"),
    ]
    lines = [F.concat(F.lit(f"{name}: "), F.col(column), F.lit("\r\n")) for name, column in fields]
    length = F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.lit(f"{VERSION}\r\n"), *[F.coalesce(line, F.lit("")) for line in lines], length, F.col("block"))


def write_warc(records: DataFrame, path: str) -> None:
    """Records as gzipped files, one or more for each partition."""
    records.select(record_text().alias("value")).write.option("lineSep", _BORDER).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """`headers` (names in lower case), `block` and `complete` of the records of files, gzipped or not.

    A file is read as a stream of records, of any version 1. A block that itself holds a border followed
    by a version line is put together again where its length ends at such a border. A record
    whose length fits no border is returned as it stands up to the next one, marked as not complete,
    and the records after it are read by themselves. So is one whose block is cut by the split of
    an uncompressed file, or said to be longer than a value can be.
    """
    lines = spark.read.option("lineSep", _NEXT).text(path).select(F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces()
        for batch in batches:
            yield _read([record for value in batch.column(0).to_pylist() for record in pieces.add(value)])
        yield _read(list(pieces.end()))

    return lines.mapInArrow(run, "headers map<string,string>, block binary, complete boolean")


#: What stands between records, up to the minor version, and the longest block that a row can hold.
_NEXT = f"{_BORDER}WARC/1."
_LONGEST = (1 << 31) - 1


class _Pieces:
    """Pieces of a file between borders, put together to records by their lengths."""

    def __init__(self) -> None:
        self.held: deque[bytes] = deque()
        #: Bytes that the first record lacks as far as known.
        self.lacks = 0

    def add(self, value: bytes) -> Iterator[tuple]:
        if value.startswith(b"WARC/1."):
            yield from self.end()
            value = value.removeprefix(b"WARC/1.")
        elif not self.held and not value.strip():
            return
        if self.held:
            self.lacks -= len(value) + len(_NEXT)
        self.held.append(value)
        if len(self.held) == 1 or self.lacks <= 0:
            yield from self._records(False)

    def end(self) -> Iterator[tuple]:
        """The records of a file that is over."""
        yield from self._records(True)

    def _records(self, over: bool) -> Iterator[tuple]:
        while self.held:
            headers, block, length = _record(self.held[0])
            # A block that begins with a record: its header's border is part of what was cut out.
            size, number = len(block) if _BORDER.encode() in self.held[0] else -len(_BORDER), 1
            while size < length <= _LONGEST and number < len(self.held):
                size += len(_NEXT) + len(self.held[number])
                number += 1
            if size < length <= _LONGEST and not over:
                self.lacks = length - size
                return
            whole = block
            if number > 1:
                whole = _record(_NEXT.encode().join([self.held[n] for n in range(number)]))[1]
            # The last record of a file has its border behind it.
            last = size > length and number == len(self.held) and not whole[length:].strip(b"\r\n")
            if last and not over:
                self.lacks = 0
                return
            if size == length or last:
                yield headers, whole[:length], True
            else:
                yield headers, block, False
                number = 1
            for _ in range(number):
                self.held.popleft()


def _read(records: list[tuple[list[tuple[str, str]], bytes, bool]]) -> pa.RecordBatch:
    headers, contents, complete = (list(column) for column in zip(*records)) if records else ([], [], [])
    arrays = [pa.array(headers, pa.map_(pa.string(), pa.string())), pa.array(contents, pa.binary()), pa.array(complete, pa.bool_())]
    return pa.RecordBatch.from_arrays(arrays, ["headers", "block", "complete"])


def _record(raw: bytes) -> tuple[list[tuple[str, str]], bytes, int]:
    """Headers, what of the block is in the piece, and the block's length; without one, the rest of the piece."""
    head, _, block = raw.partition(b"\r\n\r\n")
    # The first line is what is left of the version.
    named = [line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]]
    headers = {name.strip().lower(): value.strip() for name, colon, value in named if colon}
    length = int(headers["content-length"]) if headers.get("content-length", "").isdigit() else len(block)
    return list(headers.items()), block, length


def responses(records: DataFrame) -> DataFrame:
    """The response records of `read_warc`, in the form that `derive` takes."""
    header = lambda name: F.col("headers")[name]
    return records.filter((header("warc-type") == "response") & F.col("complete")).select(
        header("warc-record-id").alias("record_id"), header("warc-target-uri").alias("target_uri"), header("warc-date").alias("date"),
        "block", header("warc-payload-digest").alias("payload_digest"), header("warc-block-digest").alias("block_digest"),
    )


def page_responses(pages: DataFrame, date: str, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of pages kept as rows; ids are made from a page's id and URL."""
    key = F.md5(F.concat_ws(" ", F.lit("response"), F.col(id).cast("string"), F.col(url)).cast("binary"))
    parts = [F.substring(key, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        F.col(id).alias(id),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col(url).alias("target_uri"),
        F.lit(date).alias("date"),
        response_block(F.col(html), F.lit("text/html; charset=utf-8")).alias("block"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.lit(None).cast("string").alias("block_digest"),
    )
