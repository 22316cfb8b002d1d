import base64
import gzip
import hashlib
import zlib
from pathlib import Path

from changelake.llm.warc import derive, digest, page_responses, plain_text, read_warc, responses, write_warc

HTML = "<html><head><title> A  title </title><script>no</script></head><body><p>One &amp; two</p><a href='/x'>link</a></body></html>"
SCHEMA = "record_id string, target_uri string, date string, block binary, payload_digest string, block_digest string, n int"


def message(body, *headers):
    return "\r\n".join(["HTTP/1.1 200 OK", *headers]).encode() + b"\r\n\r\n" + body


def derived(spark, *rows):
    return [row.asDict() for row in derive(spark.createDataFrame([(*row, 1) for row in rows], SCHEMA), "n").collect()]


def test_both_records_refer_to_the_response_and_keep_headers_and_digests(spark):
    block = message(HTML.encode(), "Content-Type: text/html", "X-Own: a  b", "X-Own: c")
    meta, text = derived(spark, ("<urn:uuid:1>", "http://a/", "2024-05-06T00:00:00Z", block, "sha1:GIVEN", None))
    for record in (meta, text):
        assert (record["refers_to"], record["refers_to_target_uri"], record["refers_to_date"]) == ("<urn:uuid:1>", "http://a/", "2024-05-06T00:00:00Z")
        assert record["source_payload_digest"] == "sha1:GIVEN" and record["source_block_digest"] == digest(block)
        assert record["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(record["block"].encode()).digest()).decode()
        assert record["content_length"] == len(record["block"].encode()) and record["n"] == 1
    assert (meta["record_type"], text["record_type"], text["block"]) == ("metadata", "conversion", "One & two\nlink")
    assert meta["record_id"] != text["record_id"]
    for line in ("source-status: 200", "source-header-x-own: a b", "source-header-x-own: c", "title: A title", "outlink: /x", "source-payload-digest-valid: false"):
        assert f"{line}\r\n" in meta["block"]


def test_bodies_are_decoded(spark):
    latin = message("<p>café</p>".encode("latin-1"), "Content-Type: text/html; charset=ISO-8859-1")
    zipped = message(gzip.compress(b"<p>z</p>"), "Content-Type: text/html", "Content-Encoding: gzip")
    chunked = message(b"3\r\n<p>\r\n5;x=y\r\nabc d\r\n0\r\n\r\n", "Content-Type: text/html", "Transfer-Encoding: chunked")
    plain = message("é".encode(), "Content-Type: text/plain")
    image = message(b"\xff\xd8", "Content-Type: image/jpeg")
    odd = message(b"x", "Content-Type: text/html; charset=no-such")
    rows = [(f"<{n}>", None, None, block, None, None) for n, block in enumerate((latin, zipped, chunked, plain, image, odd))]
    found = derived(spark, *rows)
    assert [row["block"] for row in found if row["record_type"] == "conversion"] == ["café", "z", "abc d", "é", "x"]
    assert sum(row["record_type"] == "metadata" for row in found) == 6


def test_null_empty_and_broken_responses(spark):
    rows = [(None, None, None, None, None, None), ("<1>", "u", "d", b"", None, None), ("<2>", "u", "d", b"no message at all", None, None)]
    found = derived(spark, *rows)
    assert [row["record_type"] for row in found] == ["metadata"] * 3
    same = derived(spark, rows[1], rows[1])
    assert same[0] == same[1]
    assert derive(spark.createDataFrame([], SCHEMA)).collect() == []


def test_written_files_hold_whole_records(spark, tmp_path):
    pages = spark.createDataFrame([(n, f"http://h/{n}", HTML if n else None) for n in range(5)], "page_id long, url string, html string")
    source = page_responses(pages, "2024-01-01T00:00:00Z")
    records = derive(source)
    write_warc(records, str(tmp_path / "out"))
    raw = b"".join(gzip.decompress(path.read_bytes()) for path in sorted(Path(tmp_path / "out").glob("*.gz")))
    count = 0
    while raw:  # by length alone, as any reader does
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n") and digest(rest[:size]).encode() == fields[b"WARC-Block-Digest"]
        assert rest[size : size + 4] == b"\r\n\r\n"
        raw, count = rest[size + 4 :], count + 1
    assert count == 10
    back = read_warc(spark, str(tmp_path / "out")).collect()
    assert sorted(row.block.decode() for row in back) == sorted(row.block for row in records.collect())
    assert all(row.complete and row.headers["warc-refers-to"].startswith("<urn:uuid:") for row in back)


def test_responses_are_read_even_if_a_body_looks_like_a_record(spark, tmp_path):
    body = b"<p>x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\ny</p>"
    block = message(body, "Content-Type: text/html")
    record = lambda kind, data: (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <r>\r\nContent-Length: {len(data)}\r\n\r\n".encode() + data + b"\r\n\r\n")
    (tmp_path / "in.warc.gz").write_bytes(gzip.compress(record("warcinfo", b"software: x\r\n")) + gzip.compress(record("response", block)) + gzip.compress(record("request", b"GET /")))
    found = responses(read_warc(spark, str(tmp_path / "in.warc.gz"))).collect()
    assert [(row.record_id, row.block) for row in found] == [("<r>", block)]


def test_long_pages():
    text, title, links = plain_text("<p>a</p>" * 100_000)
    assert text == "\n".join(["a"] * 100_000) and (title, links) == ("", []) and zlib.crc32(b"")  == 0


def record_of(version, kind, id, data, length=None):
    return f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{id}>\r\nContent-Length: {len(data) if length is None else length}\r\n\r\n".encode() + data + b"\r\n\r\n"


def read_ids(spark, path):
    return [(row.headers["warc-record-id"], bytes(row.block), row.complete) for row in read_warc(spark, str(path)).collect()]


def test_every_version_is_read(spark, tmp_path):
    for version in ("1.0", "1.1"):
        path = tmp_path / f"{version}.warc.gz"
        path.write_bytes(b"".join(gzip.compress(record_of(version, "response", n, b"block %d" % n)) for n in range(5)))
        assert read_ids(spark, path) == [(f"<{n}>", b"block %d" % n, True) for n in range(5)]
    assert sorted(read_ids(spark, tmp_path)) == sorted(2 * [(f"<{n}>", b"block %d" % n, True) for n in range(5)])


def test_a_wrong_length_costs_its_own_record_only(spark, tmp_path):
    for name, length in (("long", 10_000), ("over", 60), ("huge", 10**15), ("short", 3)):
        path = tmp_path / f"{name}.warc"
        path.write_bytes(b"".join(record_of("1.0", "response", n, b"block %d" % n, length if n == 1 else None) for n in range(5)))
        assert read_ids(spark, path) == [(f"<{n}>", b"block %d" % n, n != 1) for n in range(5)]


def test_records_within_a_block_stay_there(spark, tmp_path):
    inner = record_of("1.0", "response", "in", b"a") + record_of("1.1", "response", "in", b"b")
    path = tmp_path / "nested.warc"
    path.write_bytes(record_of("1.0", "resource", 0, inner) + record_of("1.0", "response", 1, b"c"))
    assert read_ids(spark, path) == [("<0>", inner, True), ("<1>", b"c", True)]


def test_all_members_and_raw_deflate_are_decoded(spark):
    raw = zlib.compressobj(wbits=-15)
    bodies = [gzip.compress(b"<p>a</p>") + gzip.compress(b"<p>b</p>"), raw.compress(b"<p>c</p>") + raw.flush(), b"<p>plain</p>"]
    rows = [(f"<{n}>", None, None, message(body, "Content-Type: text/html", "Content-Encoding: " + ("deflate" if n == 1 else "gzip")), None, None) for n, body in enumerate(bodies)]
    assert [row["block"] for row in derived(spark, *rows) if row["record_type"] == "conversion"] == ["a\nb", "c", "plain"]
