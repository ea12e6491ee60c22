"""WARC archives: writing pages, and reading them back as a table of chunks.

Writers put records into gzip members of archives of about ``ARCHIVE`` bytes in the shared
folder, each attempt under names of its own; the table of archives lists those of the attempt that counts, so a
repeated or doubled task neither adds nor overwrites records. Readers
stream an archive through a fixed buffer: a payload comes out as rows of a record identifier and a
chunk number with at most ``CHUNK`` bytes, the digest is carried along, and no record is held whole.

Null html counts as an empty payload, a null url as a URN of the page. Equal payloads of at least ``least`` bytes
are one response, that of the smallest page_id, and revisits. A null page_id sorts before all others.
Where rows of the first page repeat, that of the least url is the response and the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwater.llm import common

CHUNK, ARCHIVE, BUFFER = 1 << 20, 256 << 20, 1 << 18
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNKS = pa.schema([("page_id", pa.int64()), ("chunk_no", pa.int32()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("is_last", pa.bool_()), ("digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64())])


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def headers(page: int, url: str | None, kind: str, digest: str, size: int, refers_to: int | None) -> bytes:
    """Both header blocks of a record; its payload follows in a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    urn = lambda x: f"<urn:headwater:page:{x}>"
    target = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else urn(page)[1:-1]
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(page)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {urn(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + (size if kind == 'response' else 0)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Archive:
    def __init__(self, system: fs.FileSystem, place: str):
        self.place, self.size = place, 0
        self.out = system.open_output_stream(place, compression=None)

    def write(self, head: bytes, payload: memoryview) -> None:
        member = zlib.compressobj(1, wbits=31)
        self._put(member.compress(head))
        for i in range(0, len(payload), CHUNK):
            self._put(member.compress(payload[i : i + CHUNK]))
        self._put(member.compress(b"\r\n\r\n") + member.flush())

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> tuple[str, int]:
        self.out.close()
        return self.place, self.size


def _write(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, path = open_folder(folder)
    task, archive, done = TaskContext.get(), None, []
    own = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
    for batch in batches:
        page, url, html, refers = (batch.column(i) for i in range(4))
        for i in range(batch.num_rows):
            if archive is None:
                archive = _Archive(system, posixpath.join(path, f"{own}-{len(done):05d}.warc.gz"))
            text = html[i].as_buffer()
            payload = memoryview(text if text is not None else b"")
            first = refers[i].as_py()
            kind = "response" if first is None else "revisit"
            digest = base32(hashlib.sha1(payload).digest())
            archive.write(headers(page[i].as_py(), url[i].as_py(), kind, digest, len(payload), first), payload if first is None else payload[:0])
            if archive.size >= ARCHIVE:
                done.append(archive.close())
                archive = None
    if archive is not None:
        done.append(archive.close())
    yield pa.record_batch([pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], pa.int64())], names=["path", "bytes"])


def write(pages: DataFrame, folder: str | None = None, least: int = 0) -> tuple[str, DataFrame]:
    """Writes the archives now; returns their folder and a table of their paths and sizes."""
    folder = folder or posixpath.join(common.shared_folder(pages.sparkSession), f"warc-{uuid.uuid4().hex}")
    common.shared_folder(pages.sparkSession)
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    own = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(common.NO_ID)).alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    own = own.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html")})
    key = ["page_id", "digest", "size"]
    # narrow rows only, combined before they are dealt: a payload that many pages have is a row for each page
    same = own.select(key).where(F.col("size") >= least).groupBy(key).agg(F.count("*").alias("rows"))
    firsts = same.groupBy("digest", "size").agg(F.min("page_id").alias("refers_to"), F.sum("rows").alias("n")).where("n > 1").select("digest", "size", "refers_to")
    later = same.join(firsts, ["digest", "size"]).where("page_id <> refers_to or rows > 1").select(*key, "refers_to", "rows").checkpoint()
    joined = own.join(later, key, "left")
    if not later.where("page_id = refers_to").isEmpty():
        nth = F.row_number().over(Window.partitionBy(key).orderBy("url"))
        joined = joined.withColumn("nth", nth).withColumn("refers_to", F.when((F.col("page_id") != F.col("refers_to")) | (F.col("nth") > 1), F.col("refers_to")))
    return folder, joined.select("page_id", "url", "html", "refers_to").mapInArrow(lambda x: _write(x, folder), "path string, bytes long").checkpoint()


class _Stream:
    """Decompressed bytes of an archive, a buffer at a time."""

    def __init__(self, source):
        self.source, self.data, self.inflate, self.rest = source, bytearray(), zlib.decompressobj(31), b""

    def more(self) -> bool:
        while True:
            if self.inflate.eof:
                self.rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            block = self.rest or self.inflate.unconsumed_tail or self.source.read(BUFFER)
            self.rest = b""
            if not block:
                return False
            got = self.inflate.decompress(block, CHUNK)
            if got:
                self.data += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        at = self.data.find(mark)
        while at < 0:
            if not self.more():
                if self.data.strip():
                    raise ValueError("the archive ends inside a record")
                return None
            at = self.data.find(mark)
        out = bytes(self.data[:at])
        del self.data[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        """Up to ``n`` bytes, and at least one."""
        if not self.data and not self.more():
            raise ValueError("the archive ends inside a payload")
        out = bytes(self.data[:n])
        del self.data[:n]
        return out


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _number(urn: str | None) -> int | None:
    return int(urn.strip("<>").rpartition(":")[2]) if urn else None


def records(source) -> Iterator[tuple]:
    """Rows of the chunk table from an open archive."""
    stream = _Stream(source)
    while (block := stream.until(b"\r\n\r\n")) is not None:
        head = _fields(block)
        http = stream.until(b"\r\n\r\n")
        left = int(head["content-length"]) - len(http) - 4
        size = int(_fields(http)["content-length"])
        page, kind, told = _number(head["warc-record-id"]), head["warc-type"], head["warc-payload-digest"].partition(":")[2]
        digest, done, number = hashlib.sha1(), 0, 0
        while True:
            piece = bytearray()
            while left and len(piece) < CHUNK:
                got = stream.take(min(left, CHUNK - len(piece)))
                piece += got
                left -= len(got)
            digest.update(piece)
            done += len(piece)
            found = None
            if not left:
                found = base32(digest.digest()) if kind == "response" else told
                if found != told:
                    raise ValueError(f"the payload of page {page} has the digest {found}, its record says {told}")
            yield page, number, bytes(piece), done, not left, found, kind, _number(head.get("warc-refers-to")), size
            number += 1
            if not left:
                break
        if stream.until(b"\r\n\r\n") is None:
            raise ValueError("the archive ends inside a record")


def _read(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, _ = open_folder(folder)
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with system.open_input_stream(path, compression=None, buffer_size=0) as source:
                rows, held = [], 0
                for row in records(source):
                    rows.append(row)
                    held += len(row[2]) + 100
                    if held > 4 * CHUNK:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHUNKS, strict=True)], schema=_CHUNKS)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHUNKS, strict=True)], schema=_CHUNKS)


def read(spark, folder: str, files: DataFrame) -> DataFrame:
    """The chunk table of archives: a row for each chunk, the digest with the last one of a record."""
    schema = "page_id long, chunk_no int, chunk binary, bytes_so_far long, is_last boolean, digest string, record_type string, refers_to long, payload_bytes long"
    # a task for each archive: a plain exchange of so few rows would be merged into one
    return files.select("path").repartition(max(1, files.count())).mapInArrow(lambda x: _read(x, folder), schema)


def round_trip(pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, as read back from the archives."""
    folder, files = write(pages, folder, least)
    last = read(pages.sparkSession, folder, files).where("is_last")
    size = F.when(F.col("record_type") == "response", F.col("bytes_so_far")).otherwise(F.col("payload_bytes"))
    return last.select(common.real_id("page_id"), size.alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", common.real_id("refers_to"))
