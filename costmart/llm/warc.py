"""WARC archives of pages: written with an index first, read by coalesced byte ranges.

Writing: each task writes archives of its own to a shared folder and returns, for each record, the
archive, offset, length, URL and digest. That index is stored as a table, so only archives of tasks
that succeeded are ever referred to; one left by a lost or repeated task is not in the index.

Reading: the wanted rows of the index are sorted by archive and offset; neighbouring ranges are
joined into one read (up to a size, over small gaps), and each record is parsed from its range and
checked against its digest.

Of records with equal payloads of at least ``revisit_bytes``, the one of the largest id is a
``response`` and the others are ``revisit`` records that refer to it and hold no payload (they keep
the HTTP headers with the payload's length); smaller ones are all responses. Records may be
compressed one by one (gzip members), as archives usually are.

Defined cases: a null payload counts as empty. Rows of a null id are written; in a group that has
other ids they are revisits, otherwise responses. Repeated rows are records of their own; rows that
share the largest id are all responses. A null URL has no target header; characters that a header
can't hold are percent-encoded.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costmart.llm.common import stored, table, utf8
from costmart.session import scratch_path

REVISIT_BYTES = 1000
#: An archive is closed beyond this size.
ARCHIVE_BYTES = 256 << 20
#: A task reads about so much of the archives.
TASK_BYTES = 16 << 20
#: One read takes ranges up to this size together, and skips gaps up to that.
READ_BYTES, GAP_BYTES = 8 << 20, 64 << 10
#: More groups of copies than this are joined by a shuffle; up to it (about 60 bytes each) by broadcast.
BROADCAST_GROUPS = 100_000
DATE = "2024-01-01T00:00:00Z"
_INDEX = "archive string, offset long, length long, url string, digest string, page_id string, record_type string"
_RECORD = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. Ids are written as URNs; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else quote(page_id, safe='')}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{quote(refers_to, safe='')}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "".join(map(chr, range(0x21, 0x7F)))


def parse(data: bytes) -> dict:
    """The fields of one record; its payload is None for a revisit."""
    from urllib.parse import unquote

    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record does not end where it should")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))

    def page(field: str) -> str | None:
        urn = fields.get(field, "")[len("<urn:page:"):-1]
        return unquote(urn) if urn else None

    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload does not match its digest")
    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": page("WARC-Refers-To"), "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def _filesystem(uri: str):
    """The file system of a shared folder (local or network path, or a store that Arrow knows)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _Archives:
    """Writes records to archives, one after the other; gives the index rows of each as it is closed."""

    def __init__(self, folder: str, compress: bool, archive_bytes: int):
        self.fs, self.folder = _filesystem(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.compress, self.limit, self.out = compress, archive_bytes, None

    def _open(self) -> None:
        self.name = f"{uuid.uuid4().hex}.warc{'.gz' if self.compress else ''}"
        self.out, self.at, self.rows = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None), 0, []

    def _put(self, data: bytes) -> int:
        if self.compress:
            z = zlib.compressobj(1, zlib.DEFLATED, 31)
            data = z.compress(data) + z.flush()
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def write(self, row: tuple, data: bytes) -> list[tuple]:
        if self.out is None:
            self._open()
            info = b"format: WARC File Format 1.1\r\n"
            self._put(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\n"
                      b"Content-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
                      % (str(uuid.uuid4()).encode(), DATE.encode(), len(info), info))
        start = self.at
        self.rows.append((self.name, start, self._put(data), *row))
        return self.close() if self.at >= self.limit else []

    def close(self) -> list[tuple]:
        if self.out is None:
            return []
        self.out.close()
        self.out, rows = None, self.rows
        return rows


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   revisit_bytes: int = REVISIT_BYTES, compress: bool = True, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes all rows and returns the stored index: ``_INDEX``."""
    payload = utf8(payload_col)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= revisit_bytes
    # aggregated per task first, so a frequent payload costs one row per task
    copies = stored(rows.where(large).groupBy("digest").agg(F.max("id").alias("keeper"), F.count("*").alias("n"))
                    .where((F.col("n") > 1) & F.col("keeper").isNotNull())
                    .select(F.col("digest").alias("copy_of"), "keeper"), "warc-copies")
    small = copies.count() <= BROADCAST_GROUPS
    linked = rows.join(F.broadcast(copies) if small else copies, large & (rows["digest"] == copies["copy_of"]), "left")
    refers = F.when(F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper")), F.col("keeper").cast("string"))
    linked = linked.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, compress, archive_bytes)
        names = [x.split()[0] for x in _INDEX.split(", ")]
        types = [pa.int64() if x.endswith(" long") else pa.string() for x in _INDEX.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for page, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                data = record(page, url, payload, digest, refers_to)
                if done := archives.write((url, digest, page, "response" if refers_to is None else "revisit"), data):
                    yield batch(done)
        if done := archives.close():
            yield batch(done)

    return stored(linked.mapInArrow(write, _INDEX), "warc-index")


def ranges(rows: list[tuple[str, int, int]], read_bytes: int = READ_BYTES, gap_bytes: int = GAP_BYTES):
    """Sorted (archive, offset, length) as (archive, start, end, [positions in rows]) per read."""
    out: list[list] = []
    for i, (archive, offset, length) in enumerate(rows):
        last = out[-1] if out else None
        if last and last[0] == archive and 0 <= offset - last[2] <= gap_bytes and offset + length - last[1] <= read_bytes:
            last[2] = offset + length
            last[3].append(i)
        else:
            out.append([archive, offset, offset + length, [i]])
    return out


def read_records(index: DataFrame, folder: str, with_payload: bool = True, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of ``index`` (any selection of its rows): ``_RECORD``. A task reads about ``task_bytes``."""
    wanted = index.select("archive", "offset", "length")
    # the index rows are narrow, so their own size says nothing about the work: tasks follow the archives' bytes
    size = wanted.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-size // task_bytes))
    sorted_rows = wanted.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    names = [x.split()[0] for x in _RECORD.split(", ")]
    types = [{"long": pa.int64(), "binary": pa.binary()}.get(x.split()[1], pa.string()) for x in _RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        name, source = None, None
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns)))
            for archive, start, end, members in ranges(rows):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, fs.open_input_file(f"{root}/{archive}")
                data = memoryview(source.read_at(end - start, start))
                out = []
                for i in members:
                    piece = data[rows[i][1] - start:rows[i][1] - start + rows[i][2]]
                    found = parse(zlib.decompress(piece, 31) if archive.endswith(".gz") else bytes(piece))
                    if not with_payload:
                        found["payload"] = None
                    out.append(found)
                yield pa.record_batch([pa.array([r[n] for r in out], t) for n, t in zip(names, types)], names=names)
        if source is not None:
            source.close()

    return sorted_rows.mapInArrow(read, _RECORD)


def query(spark, sf_dir) -> DataFrame:
    """op2: all pages are written and all records read back."""
    pages = table(spark, sf_dir, "pages")
    kind = dict(pages.dtypes)["page_id"]
    folder = scratch_path(spark, "warc")
    index = write_archives(pages, folder)
    found = read_records(index, folder, with_payload=False)
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN keeper IS NOT NULL AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""
