"""WARC archives as a table of chunks.

A payload is never held as one record: it travels as rows (record, chunk number,
bytes) of at most CHUNK bytes, on the way into the archives and back. The writer
opens a gzip member for the record and adds chunk after chunk; the reader
inflates a member piece by piece and gives each chunk the number of payload bytes
and the SHA-1 of the payload up to its end, so the last chunk of a record carries
the totals and nothing has to be put together.

Equal payloads are stored once: of the pages that share a digest the one with
the smallest id becomes a response, the others revisit records that name it.

Archives lie in the folder named by ``spark.checkpoint.dir``, which all executors
see. Each attempt of a task writes files of its own name and reports them; only
files reported by a finished task are ever read, so a lost executor leaves at
most an unread file. Files end after ROLL bytes, which bounds a reader's task.

Defined results: a null payload is empty; all pages of a digest that have its
smallest id are responses; a page without id is a response if no page of its
digest has an id, else a revisit; repeated rows are records of their own; control
characters in a URL are percent-encoded; an empty table gives no files and no
rows; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.functions.frames import join_unique, shared_folder, written

CHUNK = 1 << 16
ROLL = 1 << 25
END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
DATE = "2000-01-01T00:00:00Z"

READ = "page_id long, url string, record_type string, refers_to long, chunk_no int, chunk_bytes long, " \
       "payload_bytes long, payload_digest string, last boolean, data binary"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, bytes, sha1, refers_to``; ``refers_to`` is null for responses."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    known = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    digest = F.sha1("payload").alias("sha1")
    first = known.select("page_id", digest).groupBy("sha1").agg(F.min("page_id").alias("first"))
    told = join_unique(known.withColumn("sha1", F.sha1("payload")), first, "sha1")
    own = F.col("page_id").eqNullSafe(F.col("first")) | (F.octet_length("payload") < least_bytes)
    return told.select("page_id", "url", "payload", F.octet_length("payload").cast("long").alias("bytes"), "sha1",
                       F.when(~own, F.col("first")).alias("refers_to"))


def chunked(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of a response's payload, one row for a revisit, in order."""
    stored = F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(0)
    last = F.greatest(F.floor((stored - 1) / chunk), F.lit(0)).cast("int")
    numbered = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    data = F.when(F.col("refers_to").isNull(), F.substr("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)))
    return numbered.select("page_id", "url", "bytes", "sha1", "refers_to", "chunk_no",
                           (F.col("chunk_no") == last).alias("last"), data.alias("data"))


def _head(fields: list[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


class _Archive:
    """One file of gzip members, each a record."""

    def __init__(self, folder: str) -> None:
        self.name = f"{folder}/{uuid4().hex}.warc.gz"
        files, path = fs.FileSystem.from_uri(self.name)
        files.create_dir(path.rpartition("/")[0])
        self.stream, self.size, self.records = files.open_output_stream(path, compression=None), 0, 0

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self._put(self.member.compress(END) + self.member.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``chunked`` and return ``file, records, size``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, digest = None, None
        done: list[_Archive] = []

        def close() -> None:
            archive.stream.close()
            done.append(archive)

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "bytes", "sha1", "refers_to", "chunk_no", "last", "data")]
            for values in zip(*columns, strict=True):
                page, url, size, sha1, refers, number, last, data = (v.as_py() for v in values)
                if archive is None:
                    archive = _Archive(folder)
                    archive.begin(_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid4()}>"),
                                         ("WARC-Date", DATE), ("Content-Length", 0)]))
                    archive.end()
                if number == 0:
                    digest = hashlib.sha1()
                    archive.begin(_head([
                        ("WARC-Type", "response" if refers is None else "revisit"),
                        ("WARC-Record-ID", f"<urn:page:{page}>"), ("WARC-Date", DATE),
                        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")),
                        ("WARC-Refers-To", None if refers is None else f"<urn:page:{refers}>"),
                        ("WARC-Profile", None if refers is None else
                         "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Payload-Digest", f"sha1:{base32(bytes.fromhex(sha1))}"),
                        ("WARC-Payload-Length", size),
                        ("Content-Type", "application/http;msgtype=response"),
                        ("Content-Length", len(HTTP) + (size if refers is None else 0)),
                    ]) + HTTP)
                if data:
                    digest.update(data)
                    archive.add(data)
                if last:
                    if refers is None and digest.hexdigest() != sha1:
                        raise ValueError(f"page {page}: chunks do not make up the payload")
                    archive.end()
                    if archive.size >= ROLL:
                        close()
                        archive = None
        if archive:
            close()
        yield pa.RecordBatch.from_pydict({
            "file": pa.array([a.name for a in done], pa.string()),
            "records": pa.array([a.records for a in done], pa.int64()),
            "size": pa.array([a.size for a in done], pa.int64())})

    return written(chunks.mapInArrow(run, "file string, records long, size long"))


class _Member:
    """Inflates a file's gzip members one after the other, a piece at a time."""

    def __init__(self, stream) -> None:
        self.stream, self.raw, self.ready, self.inflate = stream, b"", b"", None

    def more(self, least: int) -> bool:
        """Have at least ``least`` bytes ready if the file has as many."""
        while len(self.ready) < least:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    return False
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            self.ready += self.inflate.decompress(self.raw, CHUNK)
            self.raw = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, None
        return True

    def head(self) -> dict[str, str] | None:
        while END not in self.ready:
            if not self.more(len(self.ready) + 1):
                return None
        head, _, self.ready = self.ready.partition(END)
        lines = head.decode().split("\r\n")
        return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}

    def take(self, n: int) -> bytes:
        if not self.more(n):
            raise EOFError("the archive ends within a record")
        data, self.ready = self.ready[:n], self.ready[n:]
        return data


def _page(uri: str | None) -> int | None:
    name = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def _chunks_of(stream, keep_data: bool) -> Iterator[tuple]:
    member = _Member(stream)
    while (head := member.head()) is not None:
        length, kind = int(head["content-length"]), head["warc-type"]
        if kind not in ("response", "revisit"):
            for at in range(0, length, CHUNK):
                member.take(min(CHUNK, length - at))
            member.take(len(END))
            continue
        while END not in member.ready:
            if not member.more(len(member.ready) + 1):
                raise EOFError("the archive ends within a header")
        http = member.ready.index(END) + len(END)
        member.take(http)
        left, size, digest, number = length - http, 0, hashlib.sha1(), 0
        told = _page(head["warc-record-id"]), head.get("warc-target-uri"), kind, _page(head.get("warc-refers-to"))
        if kind == "revisit":  # its payload is that of another record
            yield (*told, 0, 0, int(head["warc-payload-length"]),
                   head["warc-payload-digest"].removeprefix("sha1:"), True, None)
        else:
            while True:
                data = member.take(min(CHUNK, left))
                left, size = left - len(data), size + len(data)
                digest.update(data)
                yield (*told, number, len(data), size, base32(digest.digest()), left == 0, data if keep_data else None)
                number += 1
                if not left:
                    break
        member.take(len(END))


def read_chunks(files: DataFrame, keep_data: bool = True) -> DataFrame:
    """The chunk table of the archives in ``files(file)``; see READ.

    ``payload_bytes`` and ``payload_digest`` cover the payload up to the end of
    the chunk; where ``last`` is true, all of it.
    """
    names = [f.split()[0] for f in READ.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(),
             pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                files, path = fs.FileSystem.from_uri(name)
                with files.open_input_stream(path, compression=None) as stream:
                    rows: list[tuple] = []
                    for row in _chunks_of(stream, keep_data):
                        rows.append(row)
                        if len(rows) == 64:
                            yield _batch(rows, names, types)
                            rows = []
                    if rows:
                        yield _batch(rows, names, types)

    return files.select("file").mapInArrow(run, READ)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and return their files."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/archives-{uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1)
    return write_archives(chunked(records(pages, least_bytes)), folder)


def page_totals(chunks: DataFrame) -> DataFrame:
    """One row per record: what its last chunk says."""
    return chunks.filter("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
