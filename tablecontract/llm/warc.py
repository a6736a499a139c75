"""WARC derivatives: metadata and plain-text conversion records of response records."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import name_in, refuse
from .pages import parse

#: Names of what a derived record has, in order.
RECORD = [
    T.StructField(n, T.LongType() if n == "content_length" else T.StringType())
    for n in "warc_type record_id refers_to target_uri warc_date content_type content_length block_digest source_headers source_digest block record".split()
]


def responses(pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Pages as response records: ``key, record_id, target_uri, warc_date, http_headers, payload``.

    A page has no record id or date of its own: the id is a UUID of key and URL, and all get ``date``.
    """
    target, body = name_in(pages, url).cast("string"), F.coalesce(name_in(pages, html).cast("string"), F.lit("")).cast("binary")
    name = F.sha1(F.concat_ws(" ", name_in(pages, id).cast("string"), target))
    part = lambda a, n: F.substring(name, a, n)
    record = F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.length(body).cast("string"))
    return pages.select(
        name_in(pages, id).alias("key"), record.alias("record_id"), target.alias("target_uri"),
        F.lit(date).alias("warc_date"), headers.alias("http_headers"), body.alias("payload"))


def digest(data: bytes) -> str:
    """A labelled digest as WARC files write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derive(records: DataFrame, *, key: str = "key") -> DataFrame:
    """Two records for each response: ``metadata`` and ``conversion``, both referring to it.

    ``records`` has ``record_id, target_uri, warc_date, http_headers, payload`` (bytes of a text in UTF-8), and
    ``key``, which is carried. ``metadata`` keeps the source's HTTP headers line by line, its payload digest
    and length; ``conversion`` is the page's text, a line a block, without markup. Ids are made from the
    response's id, so a task that runs again writes the same records. ``record`` is the whole record as a
    WARC file holds it. Narrow: nothing is shuffled.

    Null or empty payloads have empty text; bytes that are no UTF-8 are replaced in the text and left
    alone in the digest; a null URL has no WARC-Target-URI, a null id no WARC-Refers-To; line ends in a URL are escaped;
    repeated rows give repeated records; other columns are not carried;
    a key named like a field of the result is refused; no responses give no records.
    """
    refuse(key, [f.name for f in RECORD])
    names = ("record_id", "target_uri", "warc_date", "http_headers")
    rows = records.select(name_in(records, key).alias("__key"), *[F.col(n).cast("string") for n in names], F.col("payload").cast("binary"))
    fields = [f.name for f in RECORD]
    schema = T.StructType([T.StructField(key, rows.schema["__key"].dataType), *RECORD])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                made: dict[str, list] = {n: [] for n in fields}
                for row in batch.drop_columns(["__key"]).to_pylist():
                    for record in _derived(row):
                        for n in fields:
                            made[n].append(record[n])
                twice = pa.array([i for i in range(len(batch)) for _ in range(2)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__key").take(twice), *[pa.array(made[n], pa.int64() if n == "content_length" else pa.string()) for n in fields]],
                    names=[key, *fields])

    return rows.mapInArrow(build, schema)


def _derived(row: dict) -> Iterator[dict]:
    payload, headers = row["payload"] or b"", row["http_headers"] or ""
    source = digest(payload)
    uri = None if row["target_uri"] is None else row["target_uri"].replace("\r", "%0D").replace("\n", "%0A")
    lines = [f"source-http: {x}" for x in headers.splitlines() if x]
    lines += [f"source-payload-digest: {source}", f"source-payload-length: {len(payload)}"]
    text = "\n".join(parse(payload.decode("utf-8", "replace")).lines)
    for kind, media, block in (
        ("metadata", "application/warc-fields", "".join(f"{x}\r\n" for x in lines)),
        ("conversion", "text/plain; charset=utf-8", text),
    ):
        data = block.encode("utf-8", "replace")
        record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row['record_id']} {kind}')}>"
        head = {
            "WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": row["warc_date"], "WARC-Target-URI": uri,
            "WARC-Refers-To": row["record_id"], "WARC-Refers-To-Target-URI": uri, "WARC-Refers-To-Date": row["warc_date"],
            "WARC-Block-Digest": digest(data), "Content-Type": media, "Content-Length": str(len(data)),
        }
        header = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
        yield {
            "warc_type": kind, "record_id": record_id, "refers_to": row["record_id"], "target_uri": uri, "warc_date": row["warc_date"],
            "content_type": media, "content_length": len(data), "block_digest": head["WARC-Block-Digest"], "source_headers": headers,
            "source_digest": source, "block": block, "record": f"{header}\r\n{block}\r\n\r\n",
        }
