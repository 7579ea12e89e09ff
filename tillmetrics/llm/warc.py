"""Web archives: one gzip member per record, written by tasks and read back in sequence.

Tasks write to files of their own in the shared folder; a file counts only when
its task ends well and lists it in the manifest, so a task that is run again
leaves no trace. The reader never holds more than the head and a chunk of a record: it
decompresses step by step, frames the block by its Content-Length and digests it
on the way.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.session import scratch_path

from .sharedfs import open_new, open_old
from .ship import ship

#: A file is closed once it holds this many bytes.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
#: Longest accepted HTTP head in a record's block; the writer's is of one size.
HEAD_BYTES = 1 << 20
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _one_line(text: str) -> str:
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in text or "\n" in text else text


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One compressed record: a response, or a revisit of page `refers_to` without payload."""
    digest = base32_sha1(payload)
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block += b"Content-Length: %d\r\n\r\n" % len(payload)
    block += b"" if revisit else payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _one_line(url)),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to) if revisit else None),
        ("X-Page-Id", None if page_id is None else str(page_id)),
        ("X-Refers-To-Page", str(refers_to) if revisit else None),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Length", str(len(block))),
    ]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in head if v is not None), b"", b""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + block + b"\r\n\r\n") + packer.flush()


class _Member:
    """The decompressed bytes of one gzip member, in order."""

    def __init__(self, source: BinaryIO, rest: bytes):
        self.source, self.rest = source, rest
        self.unpack = zlib.decompressobj(31)
        self.ready = b""

    def more(self) -> bool:
        """Decompress up to a chunk more; False at the end of the member."""
        while not self.unpack.eof:
            data = self.unpack.unconsumed_tail or self.rest or self.source.read(CHUNK)
            if not self.unpack.unconsumed_tail:
                self.rest = b""
            if not data:
                raise ValueError("the file ends inside a record")
            out = self.unpack.decompress(data, CHUNK)
            if out:
                self.ready += out
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """What stands before `mark`, of any length, as the writer puts whole urls there."""
        head, self.ready, seen = bytearray(self.ready), b"", 0
        while (at := head.find(mark, seen)) < 0:
            seen = max(0, len(head) - len(mark) + 1)
            if not self.more():
                raise ValueError("a record's head has no end")
            head += self.ready
            self.ready = b""
        self.ready = bytes(head[at + len(mark) :])
        return bytes(head[:at])

    def chunks(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.more():
                raise ValueError("a record's block is shorter than its Content-Length")
            part, self.ready = self.ready[:n], self.ready[n:]
            n -= len(part)
            yield part


def read_records(source: BinaryIO, keep_payload: bool = False) -> Iterator[dict]:
    """The records of an archive, one after the other.

    Each has its head fields (lower-case names), payload_bytes, payload_digest and
    digest_ok: whether block and payload have the digests that the head names. A
    damaged archive raises ValueError.
    """
    rest = source.read(CHUNK)
    while rest:
        member = _Member(source, rest)
        lines = member.until(b"\r\n\r\n").split(b"\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        head = {}
        for line in lines[1:]:
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode()] = value.strip().decode()
        block, payload = hashlib.sha1(), hashlib.sha1()
        size, kept, http, in_payload = 0, [], b"", False
        for part in member.chunks(int(head["content-length"])):
            block.update(part)
            if not in_payload:
                http += part
                if b"\r\n\r\n" not in http:
                    if len(http) > HEAD_BYTES:
                        raise ValueError("a block has no end of its HTTP head")
                    continue
                part = http.partition(b"\r\n\r\n")[2]
                in_payload = True
            payload.update(part)
            size += len(part)
            if keep_payload:
                kept.append(part)
        if b"".join(member.chunks(4)) != b"\r\n\r\n" or member.ready or member.more():
            raise ValueError("a record is longer than its Content-Length")
        named = {k: head.get(k, "").removeprefix("sha1:") for k in ("warc-payload-digest", "warc-block-digest")}
        found = base64.b32encode(payload.digest()).decode()
        revisit = head["warc-type"] == "revisit"
        ok = base64.b32encode(block.digest()).decode() == named["warc-block-digest"]
        ok &= revisit or found == named["warc-payload-digest"]
        yield {
            **head,
            "payload_bytes": int(head["x-payload-length"]) if revisit else size,
            "payload_digest": named["warc-payload-digest"] if revisit else found,
            "digest_ok": ok,
            "payload": b"".join(kept) if keep_payload else None,
        }
        rest = member.unpack.unused_data or member.rest or source.read(CHUNK)


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): the smallest page of equal payloads, for the others.

    Payloads are equal when SHA-1 and length are. Only groups of several pages reach
    the join, as one row each.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keyed = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("size")
    )
    path = scratch_path(spark, "payloads")
    groups = keyed.filter(F.col("size") >= min_bytes).groupBy("sha1", "size")
    groups.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n").write.parquet(path)
    several = spark.read.schema("sha1 string, size int, first long").parquet(path)
    refers = F.when(F.col("page_id") > F.col("first"), F.col("first"))
    return keyed.join(several, ["sha1", "size"], "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, refers_to) below `folder`; the manifest (path, records, bytes).

    The manifest is a stored table: reading it again does not write again.
    """
    spark = marked.sparkSession
    ship(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stem = f"{folder}/pages-{context.partitionId():06d}-{context.taskAttemptId()}"
        done, out, size, records = [], None, 0, 0
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*batch.columns, strict=True):
                if out is None:
                    path, size, records = f"{stem}-{len(done):04d}.warc.gz", 0, 0
                    out = open_new(path)
                data = record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "records", "bytes"])

    manifest = f"{folder}/manifest"
    marked.select("page_id", "url", "payload", "refers_to").mapInArrow(
        work, "path string, records long, bytes long"
    ).write.parquet(manifest)
    return spark.read.parquet(manifest)


RECORDS = (
    "path string, page_id long, url string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, digest_ok boolean"
)


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """The records of every archive named in `path`, an archive to a task at a time."""
    ship(manifest.sparkSession)

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORDS.split(", ")] + ["payload"] * keep_payload
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        types += [pa.binary()] * keep_payload

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with open_old(path) as source:
                    for r in read_records(source, keep_payload):
                        row = (
                            path,
                            number(r.get("x-page-id")),
                            r.get("warc-target-uri"),
                            r["warc-type"],
                            number(r.get("x-refers-to-page")),
                            r["payload_bytes"],
                            r["payload_digest"],
                            r["digest_ok"],
                        )
                        rows.append((*row, r["payload"]) if keep_payload else row)
                        if len(rows) >= (64 if keep_payload else 4096):
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    files = manifest.count()
    schema = RECORDS + (", payload binary" if keep_payload else "")
    return manifest.select("path").repartition(max(1, min(files, 20_000))).mapInArrow(work, schema)


def archive_and_read(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write a record for every page and read all of them back: the columns of RECORDS.

    Of pages with equal payloads of at least `min_bytes` bytes the smallest id is
    the response, the others are revisits of it; all smaller ones are responses.

    A null html is an empty payload. A null url leaves the target out. Null ids are
    never the smallest and always responses; rows that share the smallest id are
    all responses. Other columns are ignored. An empty table gives an empty result.
    """
    folder = folder or scratch_path(pages.sparkSession, "archives")
    return read_archives(write_archives(mark_revisits(pages, min_bytes), folder))
