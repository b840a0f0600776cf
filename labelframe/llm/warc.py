"""Web archives: one gzip member per record, written and read in sequence.

Pages become ``response`` records; of pages with equal payloads of at least
``LEAST_REVISIT`` bytes the one with the greatest id is the response and the others are
``revisit`` records that refer to it and carry the HTTP header alone.

Each task writes one archive, cut at record boundaries into parts of a few megabytes:
rows (archive, part, content).  Joined in order the parts are a .warc.gz file.  A reader
takes parts (or whole files, such as Spark's binaryFile source gives) through an
incremental decompressor, one member after another, frames each record by its
Content-Length and verifies its digests.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelframe.llm.batches import bounded

LEAST_REVISIT = 1000
PART_BYTES = 4 << 20
READ_BYTES = 64 << 10
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PARTS = "archive string, part long, content binary"


def mark_revisits(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(id, url, payload, response_id): response_id is null for a response.

    Payloads are grouped by SHA-1, a second hash and length, pre-aggregated before the
    shuffle; only groups of two or more rows are joined back, and adaptive execution may
    split a hot one.  Rows that share the greatest id of their group are all responses,
    and so are rows without an id.
    """
    own = pages.select(
        F.col(id_column).alias("id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    )
    size = F.octet_length("payload")
    keyed = own.withColumn("key", F.when((size >= least) & F.col("id").isNotNull(), F.struct(F.sha1("payload").alias("sha1"), F.xxhash64("payload").alias("hash"), size.alias("size"))))
    groups = keyed.where("key IS NOT NULL").groupBy("key").agg(F.max("id").alias("greatest"), F.count("*").alias("n"))
    groups = groups.where("n > 1").select(F.col("key").alias("group_key"), "greatest")
    # rows without a group are dealt out by their id, not to one task for the null key
    alone = keyed.where("key IS NULL").select("id", "url", "payload", F.lit(None).cast(own.schema["id"].dataType).alias("response_id"))
    joined = keyed.where("key IS NOT NULL").join(groups, F.col("key") == F.col("group_key"), "left")
    return joined.select("id", "url", "payload", F.when(F.col("id") != F.col("greatest"), F.col("greatest")).alias("response_id")).unionByName(alone)


def base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_uri(key) -> str:
    return f"<urn:x-page:{'' if key is None else quote(str(key), safe='')}>"


def write_record(key, url: str | None, payload: bytes, response_id, compressed: bool = True) -> bytes:
    """One WARC record as a gzip member; a revisit if ``response_id`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if response_id is not None else http + payload
    head = [
        "WARC/1.0",
        f"WARC-Type: {'response' if response_id is None else 'revisit'}",
        f"WARC-Record-ID: {record_uri(key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~._-')}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: {base32(hashlib.sha1(payload).digest())}",
        f"WARC-Block-Digest: {base32(hashlib.sha1(block).digest())}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_uri(response_id)}"] if response_id is not None else []),
        f"Content-Length: {len(block)}",
    ]
    record = "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"
    if not compressed:
        return record
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def archive_parts(marked: DataFrame) -> DataFrame:
    """Archives of the records that ``mark_revisits`` gives: (archive, part, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, number, held, size = f"part-{TaskContext.get().partitionId():05d}.warc.gz", 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size
            row = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([number], pa.int64()), pa.array([b"".join(held)], pa.binary())],
                names=["archive", "part", "content"],
            )
            number, size = number + 1, 0
            held.clear()
            return row

        for batch in batches:
            for key, url, payload, response in zip(*batch.columns):
                held.append(write_record(key.as_py(), url.as_py(), payload.as_py(), response.as_py()))
                size += len(held[-1])
                if size >= PART_BYTES:
                    yield flush()
        if held:
            yield flush()

    return bounded(marked).select("id", "url", "payload", "response_id").mapInArrow(run, PARTS)


class BadRecord(ValueError):
    """A record whose framing or digest is wrong."""


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes | None  # None for a revisit


def fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(record: bytes) -> Record:
    """Frame one decompressed record by its Content-Length and verify its digests."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/"):
        raise BadRecord("no WARC header")
    headers = fields(lines[1:])
    size = int(headers.get("content-length", -1))
    if size < 0 or rest[size:] != b"\r\n\r\n":
        raise BadRecord("Content-Length does not frame the record")
    block = rest[:size]
    if headers.get("warc-block-digest", base32(hashlib.sha1(block).digest())) != base32(hashlib.sha1(block).digest()):
        raise BadRecord("block digest")
    http_head, _, payload = block.partition(b"\r\n\r\n")
    http = fields(http_head.split(b"\r\n")[1:])
    if headers.get("warc-type") == "revisit":
        return Record(headers, http, None)
    if headers.get("warc-payload-digest", base32(hashlib.sha1(payload).digest())) != base32(hashlib.sha1(payload).digest()):
        raise BadRecord("payload digest")
    return Record(headers, http, payload)


def read_members(content: bytes) -> Iterator[bytes]:
    """Decompress gzip members one after another, a small piece of input at a time."""
    view, at, unpacker, held = memoryview(content), 0, zlib.decompressobj(31), []
    while at < len(view):
        piece = view[at : at + READ_BYTES]
        held.append(unpacker.decompress(piece))
        at += len(piece) - len(unpacker.unused_data)
        if unpacker.eof:
            yield b"".join(held)
            unpacker, held = zlib.decompressobj(31), []
    if held:
        raise BadRecord("the archive ends inside a record")


def read_archives(parts: DataFrame, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """Records of archives: (page_id, payload_bytes, payload_digest, record_type, refers_to, url[, payload]).

    ``parts`` needs a binary column ``content`` of whole members.  Length and digest
    (lower-case hex SHA-1) are those of the full payload, for a revisit as its headers
    state them.  A broken record ends the job with BadRecord.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", *["payload"] * with_payload]

    def key(uri: str | None) -> str | None:
        return unquote(uri[len("<urn:x-page:") : -1]) or None if uri else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for member in read_members(content.as_py() or b""):
                    r = parse(member)
                    length = len(r.payload) if r.payload is not None else int(r.http.get("content-length", 0))
                    digest = base64.b32decode(r.headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                    row = [key(r.headers["warc-record-id"]), length, digest, r.headers["warc-type"], key(r.headers.get("warc-refers-to")), unquote(r.headers["warc-target-uri"])]
                    rows.append(row + [r.payload] * with_payload)
                    size += len(member) * with_payload
                    if size > PART_BYTES or len(rows) >= 2000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, *[pa.binary()] * with_payload]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string" + ", payload binary" * with_payload
    read = bounded(parts).select("content").mapInArrow(run, schema)
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
