"""WARC archives: one gzip member per record, written and read by Spark tasks.

Writing: records of equal payloads of at least ``least_bytes`` are stored once, as the response
with the largest page_id; the others become revisit records that refer to it. Each task streams
its records into archive files of a bounded size under a name of its own. A manifest table, written
by Spark, names the files of the attempts that counted, so a lost executor leaves at most files that
nobody reads.

Reading: sequential. Files are read in pieces, decompressed incrementally, framed by the
Content-Length of each record, and the block and payload digests are verified; a record that
doesn't match raises an error.

Defined results: null html is an empty payload; a null url has no WARC-Target-URI; line breaks and
control characters in a url are percent-encoded. Rows that share the largest page_id of a payload
are all responses. A null page_id is never referred to: it revisits if another row has an id, else it
is a response. Records of shorter payloads are all responses. Other columns are ignored. An empty
table gives an empty manifest and no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

LEAST_BYTES = 1000
ARCHIVE_BYTES = 64_000_000
PIECE = 1 << 20
DATE = "1970-01-01T00:00:00Z"
LEVEL = 6

MANIFEST = "file string, n_records long, n_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store behind a folder name: a local or shared path, s3, gs or hdfs."""
    uri = re.sub(r"^s3a:", "s3:", uri)
    uri = re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages as (page_id, url, html, digest, refers_to): refers_to is the largest page_id with an
    equal payload, null for responses. Only payloads that occur twice take part in the join."""
    pages = common.clean_columns(pages, {"page_id": "long", "url": "string", "html": "string"})
    html = F.coalesce("html", F.lit(""))
    pages = pages.withColumns(
        {"html": html, "size": F.octet_length(html), "digest": F.sha1(html), "check": F.xxhash64(html)}
    )
    same = ["digest", "size", "check"]
    many = (
        pages.where(F.col("size") >= least_bytes)
        .groupBy(*same)
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and largest is not null")
        .drop("copies")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("largest"))
    return pages.join(many, same, "left").select(
        "page_id", "url", "html", "digest", F.when(other, F.col("largest")).alias("refers_to")
    )


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """The bytes of one record: WARC header, HTTP header, and for a response the payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_uri(refers_to)}")
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    lines.append(f"WARC-Block-Digest: {_sha1(block)}")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per page into archives in a shared folder; returns the stored manifest."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        out, name, n, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict(
                {"file": [name], "n_records": pa.array([n], pa.int64()), "n_bytes": pa.array([size], pa.int64())}
            )

        for batch in rows:
            columns = [batch.column(k) for k in ("page_id", "url", "html", "digest", "refers_to")]
            for row in zip(*columns, strict=True):
                page_id, url, html, digest, refers_to = (x.as_py() for x in row)
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                data = member(record(page_id, url, html.encode(), digest, refers_to))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return common.stored(pages.mapInArrow(run, MANIFEST))


class BadRecord(ValueError):
    """A record whose framing or digest is wrong."""


def _members(stream) -> Iterator[bytes]:
    """The decompressed gzip members of a file, read in pieces."""
    piece, inflate, parts = stream.read(PIECE), None, []
    while piece:
        inflate = inflate or zlib.decompressobj(31)
        parts.append(inflate.decompress(piece))
        if not inflate.eof:
            piece = stream.read(PIECE)
            continue
        yield b"".join(parts)
        piece, inflate, parts = inflate.unused_data or stream.read(PIECE), None, []
    if inflate is not None:
        raise BadRecord("the last record is cut off")


def _header(data: bytes, at: int) -> tuple[dict[str, str], int]:
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise BadRecord("a header has no end")
    lines = data[at:end].decode().split("\r\n")[1:]
    return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}, end + 4


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def parse(data: bytes) -> tuple:
    """A verified record as a row of RECORDS."""
    if not data.startswith(b"WARC/1.1\r\n"):
        raise BadRecord("no WARC record")
    head, at = _header(data, 0)
    block = data[at : at + int(head["content-length"])]
    if data[at + len(block) :] != b"\r\n\r\n" or _sha1(block) != head["warc-block-digest"]:
        raise BadRecord(f"{head.get('warc-record-id')}: length or block digest is wrong")
    http, at = _header(block, 0)
    payload, size = block[at:], int(http["content-length"])
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response":
        if len(payload) != size or _sha1(payload) != f"sha1:{digest}":
            raise BadRecord(f"{head.get('warc-record-id')}: payload digest is wrong")
    else:
        payload = None
    return (
        _page(head["warc-record-id"]),
        head.get("warc-target-uri"),
        head["warc-type"],
        _page(head.get("warc-refers-to")),
        size,
        base64.b32decode(digest).hex(),
        payload,
    )


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives that a manifest names, one row each."""
    schema = common.schema_of(RECORDS)
    names = schema.names if payloads else schema.names[:-1]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    arrow = pa.schema(list(zip(schema.names, kinds, strict=True))[: len(names)])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        for batch in rows:
            for name in batch.column("file").to_pylist():
                held, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        held.append(parse(data)[: len(names)])
                        size += len(data)
                        if size >= 8 * PIECE or len(held) >= 5000:
                            yield _rows(held, arrow)
                            held, size = [], 0
                if held:
                    yield _rows(held, arrow)

    wanted = schema if payloads else common.schema_of(RECORDS.rsplit(",", 1)[0])
    # a file is read by one task; the names alone are dealt out
    names_only = manifest.select("file")
    return names_only.repartition(max(1, manifest.count()), "file").mapInArrow(run, wanted)


def _rows(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    folder = f"{common.scratch(spark)}/warc"
    manifest = write_archives(with_revisits(common.read_table(spark, sf_dir, "pages")), folder)
    records = read_archives(manifest, folder, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), m AS (
  SELECT html, max(page_id) AS largest FROM p WHERE n >= 1000 GROUP BY html
)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN largest IS NULL OR largest IS NOT DISTINCT FROM p.page_id
            THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN largest IS DISTINCT FROM p.page_id THEN largest END AS refers_to
FROM p LEFT JOIN m ON p.html = m.html AND p.n >= 1000
"""
