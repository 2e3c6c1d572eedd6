"""WARC: write archives, normalise monolithic gzip files, read through an index.

``write_archives`` writes each task's records into whole-file gzip streams.
``normalise_archives`` inflates such a stream once, from front to end, rewrites
every record as a gzip member of its own, and writes a sidecar index of offset,
length, type and record id per record. ``read_archives`` goes through the index
and inflates one member per record. Archives lie in the shared folder, through
whatever file system its URI names; a file gets its final name when it is
complete, names hold the task's attempt, and only what Spark's own committer has
accepted is listed. So a lost or repeated task leaves no record twice.

Equal payloads are stored once: the row with the smallest id is the response, the
others are revisits that refer to it and keep the HTTP headers only. Rows that
repeat id and payload are all responses if the id is the smallest. Null payloads
are empty. Rows without id are responses, and nothing refers to them. Null
addresses are written as ``urn:unknown``; blanks and control characters in
addresses are percent-encoded. Extra columns are not carried along.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from planledger.llm.storage import new_folder, qualified, saved
from planledger.operators.joins import split_join

ARCHIVE_BYTES = 256 << 20
#: How much of a stream is read at a time.
_STEP = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
MANIFEST = "archive string, records long"
_ROW = [
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("target_uri", pa.string()), ("payload", pa.binary()),
]


def with_revisits(pages: DataFrame, key: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: for a payload of at least ``min_bytes`` that a smaller id has too, the smallest such id."""
    own = pages.withColumn("__sha", F.sha1(F.coalesce(F.col(payload), F.lit(""))))
    large = F.octet_length(F.coalesce(F.col(payload), F.lit(""))) >= min_bytes
    ids = own.filter(large & F.col(key).isNotNull()).select(F.col(key).alias("__id"), "__sha")
    firsts = ids.groupBy("__sha").agg(F.min("__id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = split_join(ids, firsts, "__sha", "inner").filter("__id <> refers_to").distinct()
    # Few columns went through the joins by payload; the payloads themselves move once, by id.
    return own.drop("refers_to").join(later.withColumnRenamed("__id", key), [key, "__sha"], "left").drop("__sha")


def _address(url: str | None) -> str:
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "urn:unknown")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, response or revisit."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_address(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    """The named fields of a header block, names in lower case."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse(data: bytes) -> dict:
    """The row of one whole record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    page = fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
    refers = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
    row = {
        "page_id": int(page) if not page.startswith("<") else None,
        "record_type": fields["warc-type"],
        "refers_to": int(refers) if refers else None,
        "target_uri": fields["warc-target-uri"],
    }
    if row["record_type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != fields["warc-payload-digest"].removeprefix("sha1:"):
            raise ValueError(f"the payload of {page} differs from its digest")
        return row | {"payload_bytes": len(payload), "payload_digest": digest, "payload": payload}
    # A revisit has no payload; its headers tell of the one it stands for.
    size = int(headers(http)["content-length"])
    return row | {"payload_bytes": size, "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"), "payload": None}


class _File:
    """A file that appears under its name when it is complete."""

    def __init__(self, folder: str, name: str) -> None:
        self.fs, path = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(path, recursive=True)
        self.path, self.uri, self.size = f"{path}/{name}", f"{folder}/{name}", 0
        self.stream = self.fs.open_output_stream(f"{self.path}.part", compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> str:
        self.stream.close()
        self.fs.move(f"{self.path}.part", self.path)
        return self.uri


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", size: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per row of ``pages``, which have ``refers_to``, into gzip streams of about
    ``size`` bytes before compression. Returns the saved manifest (archive, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        out = packer = None
        made = records = filled = 0

        def finish() -> pa.RecordBatch:
            out.write(packer.flush())
            return pa.RecordBatch.from_arrays([pa.array([out.close()]), pa.array([records])], names=["archive", "records"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for page, address, text, refers in zip(*columns, strict=True):
                if out is None:
                    out = _File(folder, f"whole-{task.partitionId():06d}-{task.taskAttemptId()}-{made}.warc.gz")
                    packer, records, filled = zlib.compressobj(1, wbits=31), 0, 0
                    made += 1
                data = record(page, address, (text or "").encode(), refers)
                out.write(packer.compress(data))
                records, filled = records + 1, filled + len(data)
                if filled >= size:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()

    rows = pages.select(F.col(key).cast("long"), F.col(url), F.col(payload), F.col("refers_to").cast("long"))
    return saved(rows.mapInArrow(write, MANIFEST), "whole")


def _inflated(stream: pa.NativeFile) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, a piece at a time."""
    unpacker = zlib.decompressobj(wbits=31)
    while data := stream.read(_STEP):
        while data:
            yield unpacker.decompress(data, 4 * _STEP)
            data = unpacker.unconsumed_tail
            if unpacker.eof:
                data = unpacker.unused_data
                unpacker = zlib.decompressobj(wbits=31)
    yield unpacker.flush()


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of a stream of bytes; holds one record at a time."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(headers(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends within a record")


def normalise_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive of ``manifest`` record by record; returns the saved new manifest.
    Beside ``x.warc.gz`` lies its index ``x.warc.gz.idx``."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(source)
                name = path.rsplit("/", 1)[-1].replace("whole-", f"records-{attempt}-")
                out, index = _File(folder, name), _File(folder, f"{name}.idx")
                records = 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for data in split_records(_inflated(stream)):
                        fields = headers(data[: data.find(b"\r\n\r\n")])
                        packer = zlib.compressobj(6, wbits=31)
                        member = packer.compress(data) + packer.flush()
                        line = [str(out.size), str(len(member)), fields["warc-type"], fields["warc-record-id"]]
                        index.write(("\t".join(line) + "\n").encode())
                        out.write(member)
                        records += 1
                index.close()
                yield pa.RecordBatch.from_arrays([pa.array([out.close()]), pa.array([records])], names=["archive", "records"])

    return saved(_dealt(manifest).mapInArrow(rewrite, MANIFEST), "records")


def _dealt(manifest: DataFrame) -> DataFrame:
    """One archive for each task, as far as hashing deals them out."""
    archives = manifest.count()
    return manifest.repartition(max(1, 2 * archives), "archive")


def read_archives(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri
    and, with ``keep_payload``, the payload (null for revisits). Checks lengths and digests."""
    fields = [f for f in _ROW if keep_payload or f[0] != "payload"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = pafs.FileSystem.from_uri(archive)
                rows, seen = [], 0
                with fs.open_input_file(path) as file, fs.open_input_stream(f"{path}.idx", compression=None) as index:
                    for line in index.read().decode().splitlines():
                        offset, length = map(int, line.split("\t")[:2])
                        file.seek(offset)
                        rows.append(parse(zlib.decompress(file.read(length), wbits=31)))
                        seen += 1
                        if len(rows) == 256:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))
                            rows = []
                if seen != records:
                    raise ValueError(f"{archive} has {seen} records of {records}")
                yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return _dealt(manifest).mapInArrow(read, ", ".join(f"{name} {kinds[kind]}" for name, kind in fields))


def archive_pages(pages: DataFrame, min_bytes: int = 0, keep_payload: bool = True) -> DataFrame:
    """Write ``pages`` (page_id, url, html), normalise the archives, and read them back."""
    folder = qualified(pages.sparkSession, new_folder(pages.sparkSession, "warc"))
    whole = write_archives(with_revisits(pages.select("page_id", "url", "html"), "page_id", "html", min_bytes), folder)
    return read_archives(normalise_archives(whole, folder), keep_payload)
