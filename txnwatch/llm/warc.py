"""WARC archives of pages: a distributed writer and a sequential reader.

Every record is one gzip member. Of pages with equal payloads of at least ``REVISIT_BYTES``
bytes, that with the smallest id is stored as a response; the others are revisit records that
name it and carry its digest. Each task writes its own archives below the shared folder, under
a name of the attempt first, and renames them when complete, so a repeated task leaves the same
files. The reader goes through an archive once, front to back: it inflates in pieces of bounded
size, frames a record by its Content-Length, and compares the digest of what it read with the
one in the header. Payloads are never held whole unless asked for.

Defined results: a null page is an empty payload; a null id reads back as null and is never
referred to; rows that share the smallest id of their payload are all responses; a null address
gives a record without one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import whole_text, written
from txnwatch.session import shared_dir

REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 16
DATE = "2024-01-01T00:00:00Z"
# Fixed: names and texts of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
PAGE_URN = "urn:x-page:"

ARCHIVES = "path string, records bigint, bytes bigint"
RECORDS = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, digest_ok boolean, payload binary"
)


# --- one record -------------------------------------------------------------------------
def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as one gzip member."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return zlib_member("\r\n".join(lines).encode() + END + block + END)


def zlib_member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _urn(page_id: int | None) -> str:
    return f"<{PAGE_URN}{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(PAGE_URN)
    return int(number) if number else None


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        # what would end the line or the field is escaped
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        headers += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    block = head if refers_to is not None else head + payload
    headers += [
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(headers, block)


# --- reading ----------------------------------------------------------------------------
class Members:
    """The gzip members of a stream, one after the other, inflated piece by piece."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.raw, self.kept = stream, b"", b""
        self.inflate = None

    def next(self) -> bool:
        """Starts the next member; False at the end of the stream."""
        if self.inflate is not None:
            while self.read(PIECE):
                pass
            self.raw = self.inflate.unused_data
        self.raw = self.raw or self.stream.read(PIECE)
        self.inflate, self.kept = zlib.decompressobj(31), b""
        return bool(self.raw)

    def read(self, most: int) -> bytes:
        """At most so many bytes of the member; none at its end."""
        if self.kept:
            out, self.kept = self.kept[:most], self.kept[most:]
            return out
        while not self.inflate.eof:
            self.raw = self.raw or self.stream.read(PIECE)
            if not self.raw:
                raise ValueError("the archive ends inside a record")
            out = self.inflate.decompress(self.raw, most)
            self.raw = self.inflate.unconsumed_tail
            if out:
                return out
        return b""

    def until(self, mark: bytes) -> bytes:
        """What comes before the mark, which is read too."""
        got = b""
        while (at := got.find(mark)) < 0:
            piece = self.read(PIECE)
            if not piece:
                raise ValueError("a header without an end")
            got += piece
        self.kept = got[at + len(mark) :] + self.kept
        return got[:at]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    pairs = (line.split(":", 1) for line in lines[1:])
    return {"": lines[0]} | {k.strip().lower(): v.strip() for k, v in pairs}


def read_records(stream: BinaryIO, payloads: bool = False) -> Iterator[dict]:
    """The page records of one archive, in order."""
    members = Members(stream)
    while members.next():
        head = _fields(members.until(END))
        if head[""] != VERSION:
            raise ValueError(f"not a {VERSION} record: {head['']!r}")
        left, block, payload = int(head["content-length"]), hashlib.sha256(), hashlib.sha256()
        size, parts, http, pending = 0, [], None, b""
        while left:
            piece = members.read(min(left, PIECE))
            if not piece:
                raise ValueError("a record shorter than its Content-Length")
            left -= len(piece)
            block.update(piece)
            if http is None:
                pending += piece
                if END not in pending:
                    continue
                first, piece = pending.split(END, 1)
                http = _fields(first)
            size += len(piece)
            payload.update(piece)
            if payloads:
                parts.append(piece)
        if members.until(END) or members.read(1):
            raise ValueError("a record longer than its Content-Length")
        if head["warc-type"] not in ("response", "revisit"):
            continue
        revisit = head["warc-type"] == "revisit"
        named = head["warc-payload-digest"].removeprefix("sha256:")
        same_block = head["warc-block-digest"] == f"sha256:{block.hexdigest()}"
        yield {
            "page_id": _page(head["warc-record-id"]),
            "url": _unescaped(head.get("warc-target-uri")),
            "record_type": head["warc-type"],
            "refers_to": _page(head.get("warc-refers-to")),
            "payload_bytes": None if revisit else size,
            "payload_digest": named if revisit else payload.hexdigest(),
            "digest_ok": same_block and (revisit or payload.hexdigest() == named),
            "payload": b"".join(parts) if payloads and not revisit else None,
        }


def _unescaped(url: str | None) -> str | None:
    return None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)


# --- tables -----------------------------------------------------------------------------
def _writer(folder: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        done, out, count, size = [], None, 0, 0

        def close() -> None:
            nonlocal out
            out.close()
            name = f"{base}/pages-{task:06d}-{len(done):04d}.warc.gz"
            files.move(f"{base}/.{attempt}", name)
            done.append((f"{folder}/{name.rsplit('/', 1)[1]}", count, size))
            out = None

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(batch.column(i) for i in range(5))):
                if out is None:
                    out, count, size = files.open_output_stream(f"{base}/.{attempt}", compression=None), 0, 0
                    out.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(int=task)}>"),
                                      ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC 1.1\r\n"))
                data = page_record(page_id.as_py(), url.as_py(), html.as_py().encode(), digest.as_py(), refers_to.as_py())
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), *[pa.array([d[i] for d in done], pa.int64()) for i in (1, 2)]],
            names=["path", "records", "bytes"],
        )

    return write


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes all pages and returns the archives: ``path, records, bytes``."""
    rows = pages.select(
        "page_id", "url", whole_text("html").alias("html"), F.sha2(whole_text("html"), 256).alias("digest")
    )
    long_enough = F.octet_length("html") >= REVISIT_BYTES
    copied = (
        rows.filter(long_enough).groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    marked = rows.join(copied, (F.col("digest") == F.col("_digest")), "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )
    return written(marked.mapInArrow(_writer(shared_dir(pages.sparkSession, "warc")), ARCHIVES), "warc-list")


def _reader(payloads: bool):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]

        def packed(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with files.open_input_stream(name, compression=None) as stream:
                    for row in read_records(stream, payloads):
                        rows.append(row)
                        held += len(row["payload"] or b"")
                        if len(rows) >= 5000 or held >= 16 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    return read


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of all archives; a task reads whole archives, each front to back."""
    paths = archives.select("path").repartition(max(1, archives.count()))
    return paths.mapInArrow(_reader(payloads), RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """Revisits get the length of the response they refer to, and are checked against its digest."""
    plain = records.drop("payload")
    responses = (
        plain.filter("record_type = 'response'")
        .groupBy(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"))
        .agg(F.max("payload_bytes").alias("_bytes"), F.bool_and("digest_ok").alias("_ok"))
    )
    found = plain.filter("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest")), "left"
    )
    revisits = found.withColumns(
        {"payload_bytes": F.col("_bytes"), "digest_ok": F.col("digest_ok") & F.coalesce("_ok", F.lit(False))}
    ).drop("_page", "_digest", "_bytes", "_ok")
    return plain.filter("record_type = 'response'").unionByName(revisits)


def archived(pages: DataFrame) -> DataFrame:
    """All pages, written and read back."""
    return resolved(written(read_archives(write_archives(pages)), "warc-records"))
