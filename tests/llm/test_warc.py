"""Derived records: links, digests, and files that parse again."""

import base64
import hashlib
import uuid

from tablecontract.llm.warc import derive, digest, responses


def records(text):
    """Header fields and block of each record of a WARC text."""
    data, out = text.encode(), []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        out.append((fields, rest[:n]))
        data = rest[n + 4 :]
    return out


def test_records_of_pages(spark):
    rows = [(1, "http://a.org/?q=\r\nx", "<p>Hällo &amp; more<script>no()</script><p>two"), (2, None, None), (None, "http://b.org", ""), (1, "http://a.org/?q=\r\nx", "<p>x")]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, BLOCK string")
    sources = {(r.key, r.payload): r for r in responses(frame).collect()}
    out = derive(responses(frame)).collect()
    assert len(out) == 8 and {r.warc_type for r in out} == {"metadata", "conversion"}
    for r in out:
        (fields, block), = records(r.record)
        assert fields["WARC-Type"] == r.warc_type and fields["WARC-Block-Digest"] == r.block_digest == digest(block)
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() and block.decode() == r.block
        assert fields.get("WARC-Refers-To") == r.refers_to and fields.get("WARC-Target-URI") == r.target_uri
        assert r.record_id.startswith("<urn:uuid:") and uuid.UUID(r.record_id[10:-1])
        source = next(s for s in sources.values() if s.record_id == r.refers_to and digest(bytes(s.payload)) == r.source_digest)
        if r.warc_type == "metadata":
            assert f"source-payload-digest: {r.source_digest}\r\n" in r.block and all(f"source-http: {x}\r\n" in r.block for x in source.http_headers.split("\r\n"))
    text = [r.block for r in out if r.warc_type == "conversion"]
    assert sorted(text) == ["", "", "Hällo & more\ntwo", "x"]
    assert {r.target_uri for r in out} == {"http://a.org/?q=%0D%0Ax", None, "http://b.org"}


def test_the_same_again_and_nothing(spark):
    frame = spark.createDataFrame([(1, "http://a.org", "<p>x" * 50_000)], "page_id long, url string, html string")
    first, second = (sorted(derive(responses(frame)).collect()) for _ in range(2))
    assert first == second and derive(responses(frame.limit(0))).count() == 0


def test_bytes_that_are_no_text(spark):
    frame = spark.createDataFrame([(b"<p>\xff\xfe", None)], "payload binary, record_id string").selectExpr(
        "1 as key", "record_id", "'u' as target_uri", "'d' as warc_date", "cast(null as string) as http_headers", "payload")
    conversion = derive(frame).where("warc_type = 'conversion'").first()
    assert conversion.source_digest == digest(b"<p>\xff\xfe") and conversion.block == "\ufffd\ufffd" and conversion.refers_to is None
