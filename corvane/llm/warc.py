"""WARC archives: writing with payload deduplication, and a salvage reader.

Writing: every page becomes a record, each its own gzip member. Of pages with
equal payloads (of at least ``min_bytes``) the one with the smallest id is a
``response``, the others are ``revisit`` records that name it and carry no
payload. Archives are written to the shared folder under a name of their own
for each attempt; the manifest row that a task returns names only files that
the successful attempt closed.

Reading: members are read in turn and checked (CRC and size of the gzip
member, version line, lengths, payload digest). After a failed check the
reader searches for the next valid gzip member or, in plain archives, the next
version line, recovers what follows and logs the byte gap that it skipped.

Defined results: a null payload is empty; an empty payload is a payload like
any other; rows that repeat an id and its payload are all responses when the id
is the payload's smallest; a null page id is ordered after all others and is
read back as null; long payloads and URLs stay whole (headers of over
``HEADER_BYTES`` are quarantined); an empty table gives empty results. Extra
columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, materialise, shared_path

VERSION = b"WARC/1.1"
#: An archive is closed once it holds this many bytes.
ARCHIVE_BYTES = 32 << 20
#: Bytes that the reader asks for at a time.
CHUNK = 1 << 17
#: The longest headers of a record that the reader takes.
HEADER_BYTES = 1 << 24
#: Revisits of at most this many rows, of about 60 bytes each, are broadcast to the pages; more are joined by shuffle.
BROADCAST_ROWS = 200_000
_MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_DATE = b"2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One uncompressed record. A revisit keeps digest and length of the payload it leaves out."""
    kind = b"revisit" if revisit else b"response"
    head = [
        VERSION,
        b"WARC-Type: " + kind,
        b"WARC-Record-ID: <urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}")).encode(),
        b"WARC-Date: " + _DATE,
        b"WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), url or "").encode(),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"X-Page-Id: " + str("" if page_id is None else page_id).encode(),
        b"X-Payload-Length: %d" % len(payload),
    ]
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"X-Refers-To-Page-Id: " + str(refers_to).encode()]
        payload = b""
    head += [b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Bad(Exception):
    """A failed check."""


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and length of the record that ``data`` begins with. Raises ``EOFError`` if it is cut off."""
    if not _VERSION_LINE.match(data):
        if len(data) < 10 and VERSION[:5].startswith(data[:5]):
            raise EOFError
        raise Bad("version line")
    end = data.find(b"\r\n\r\n", 0, HEADER_BYTES)
    if end < 0:
        if len(data) >= HEADER_BYTES:
            raise Bad("headers")
        raise EOFError
    head = {}
    for line in data[:end].split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            raise Bad("header line")
        head[k.decode("latin-1").lower()] = v.strip().decode("utf-8", "replace")
    if not (size := head.get("content-length", "")).isdigit():
        raise Bad("length")
    start, size = end + 4, int(size)
    if len(data) < start + size + 4:
        raise EOFError
    if data[start + size : start + size + 4] != b"\r\n\r\n":
        raise Bad("record end")
    block = data[start : start + size]
    if head.get("warc-type") == "response" and head.get("warc-payload-digest", "").removeprefix("sha1:") != sha1_base32(block):
        raise Bad("payload digest")
    return head, block, start + size + 4


class _Stream:
    """A window over a file from ``at`` on, filled as it is needed."""

    def __init__(self, f):
        self.f, self.data, self.at, self.over = f, b"", 0, False

    def more(self) -> bool:
        if not self.over:
            got = self.f.read(max(CHUNK, len(self.data)))
            self.over = not got
            self.data += got
        return not self.over

    def skip(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def _gzip_member(s: _Stream) -> tuple[bytes, int]:
    """Content and compressed length of the member at the window's start."""
    d, out, fed = zlib.decompressobj(31), [], 0
    while True:
        try:
            out.append(d.decompress(s.data[fed:]))
        except zlib.error as e:
            raise Bad(f"gzip: {e}") from None
        fed = len(s.data)
        if d.eof:
            return b"".join(out), fed - len(d.unused_data)
        if not s.more():
            raise Bad("gzip: cut off")


def _plain_record(s: _Stream) -> tuple[dict, bytes, int]:
    while True:
        try:
            return parse(s.data)
        except EOFError:
            if not s.more():
                raise Bad("cut off") from None


def salvage(f) -> Iterator[tuple]:
    """("record", headers, block, at) and ("gap", from, to, reason) in file order."""
    s, gap, why = _Stream(f), None, ""
    while s.data or s.more():
        while len(s.data) < 16 and s.more():
            pass
        try:
            if s.data.startswith(_MAGIC):
                content, used = _gzip_member(s)
                try:
                    head, block, n = parse(content)
                except EOFError:
                    raise Bad("record cut off in member") from None
                if n != len(content):
                    raise Bad("more than a record in member")
            else:
                head, block, used = _plain_record(s)
        except Bad as e:
            gap, why = (s.at, str(e)) if gap is None else (gap, why)
            s.skip(1)
            while True:  # the next place where a member or a version line may begin
                line = _VERSION_LINE.search(s.data)
                found = [i for i in (s.data.find(_MAGIC), line.start() if line else -1) if i >= 0]
                if found:
                    s.skip(min(found))
                    break
                s.skip(max(0, len(s.data) - 9))
                if not s.more():
                    s.skip(len(s.data))
                    break
            continue
        if gap is not None:
            yield "gap", gap, s.at, why
            gap = None
        yield "record", head, block, s.at
        s.skip(used)
    if gap is not None:
        yield "gap", gap, s.at, why


def _open(path: str):
    fs, inner = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return fs, inner


def plan(pages: DataFrame, id_col="page_id", url_col="url", payload_col="html", min_bytes: int = 0) -> DataFrame:
    """Pages with ``refers_to`` (null for responses). Only ids and digests are grouped; if revisits are few, payloads stay where they are."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    keys = rows.select("page_id", F.sha1(F.encode("payload", "UTF-8")).alias("sha"), F.octet_length("payload").alias("n")).filter(F.col("n") >= min_bytes)
    first = keys.groupBy("sha", "n").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies")).filter("copies > 1")
    later = keys.join(first, ["sha", "n"]).filter("refers_to is not null and not (page_id <=> refers_to)").select(F.col("page_id").alias("later_id"), F.col("sha").alias("later_sha"), "refers_to").distinct()
    later = materialise(later)
    if later.count() <= BROADCAST_ROWS:
        later = F.broadcast(later)
    on = F.col("page_id").eqNullSafe(F.col("later_id")) & (F.sha1(F.encode("payload", "UTF-8")) == F.col("later_sha"))
    return rows.join(later, on, "left").select("page_id", "url", "payload", "refers_to")


def write(pages: DataFrame, folder: str, **columns) -> DataFrame:
    """Writes the archives; returns their manifest (path, records, bytes), materialised."""

    def run(batches):
        fs, inner = _open(folder)
        fs.create_dir(inner, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        out, done, path = None, [], ""
        for b in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    path = f"{name}-{len(done):04d}.warc.gz"
                    out, records, size = fs.open_output_stream(f"{inner}/{path}", compression=None), 0, 0
                raw = payload.encode()
                data = member(record(page_id, url, raw, sha1_base32(raw), refers_to, refers_to is not None))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{folder}/{path}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{path}", records, size))
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("path", "records", "bytes"), map(list, zip(*done, strict=True)), strict=True)), schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return materialise(in_arrow(plan(pages, **columns), run, "path string, records long, bytes long"))


_READ = "path string, at long, kind string, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary, gap_end long, reason string"


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records (kind ``record``) and quarantined byte gaps (kind ``gap``) of the archives named in ``path``."""
    names = [x.split()[0] for x in _READ.split(", ")]
    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t.split()[1]]) for n, t in zip(names, _READ.split(", "), strict=True)])
    whole = lambda x: int(x) if re.fullmatch(r"-?\d+", x or "") else None

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, inner = _open(path)
                rows, held = [], 0
                with fs.open_input_stream(inner, compression=None) as f:
                    for kind, *x in salvage(f):
                        if kind == "gap":
                            rows.append((path, x[0], kind, *[None] * 7, x[1], x[2]))
                        else:
                            h, block, at = x
                            rows.append((path, at, kind, whole(h.get("x-page-id")), h.get("warc-target-uri"), h.get("warc-type"), h.get("warc-payload-digest", "").removeprefix("sha1:"), whole(h.get("x-payload-length")), whole(h.get("x-refers-to-page-id")), block if payloads else None, None, None))
                            held += len(block) if payloads else 0
                        if len(rows) >= 4096 or held > 8 << 20:
                            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), schema=schema)

    paths = manifest.select("path")
    return in_arrow(paths.repartition(max(1, min(paths.count(), 10_000))), run, _READ)


def query(spark, sf_dir):
    manifest = write(spark.read.parquet(f"{sf_dir}/pages.parquet"), shared_path(spark, "warc"))
    gap = F.raise_error(F.format_string("bytes %d to %d of %s can't be read back: %s", "at", "gap_end", "path", "reason"))
    records = read(manifest, payloads=False).filter(F.when(F.col("kind") == "gap", gap.cast("boolean")).otherwise(True))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(p.h, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (h)
"""
