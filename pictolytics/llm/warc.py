"""WARC archives: written with one gzip member per record, read back sequentially.

The reader takes a file in portions, inflates member after member, frames records by their
content length and verifies both digests. Archives lie in the shared folder and roll over at a fixed
size, so tasks hold one record and one portion at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import landed
from pictolytics.session import shared_dir

ARCHIVE_BYTES = 64 << 20
PORTION = 1 << 20
LEVEL = 4
_NO_KEY = 1 << 127
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(key: int | None) -> str:
    """Page numbers are the record ids, so a reference can be followed without an index."""
    return f"<urn:uuid:{uuid.UUID(int=_NO_KEY if key is None else key & ((1 << 64) - 1))}>"


def _page(record_id: str | None) -> int | None:
    if record_id is None:
        return None
    n = uuid.UUID(record_id[10:-1]).int
    return None if n == _NO_KEY else n - (1 << 64) if n >> 63 else n


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in value)


def record(key: int | None, url: str | None, payload: bytes | None, size: int, sha1: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; ``payload`` is None for a revisit."""
    kind = "response" if payload is not None else "revisit"
    block = _HTTP % size + (payload or b"")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(key)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if kind == "revisit":
        head += [("WARC-Profile", _SAME), ("WARC-Refers-To", _record_id(refers_to))]
    head.append(("Content-Length", str(len(block))))
    raw = b"WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class WarcError(ValueError):
    """A record that is cut short, wrongly framed or does not fit its digests."""


def members(stream, portion: int = PORTION) -> Iterator[bytes]:
    """Inflated gzip members of a stream that is read in portions."""
    held = b""
    while True:
        held = held or stream.read(portion)
        if not held:
            return
        inflater, out = zlib.decompressobj(31), []
        while not inflater.eof:
            held = held or stream.read(portion)
            if not held:
                raise WarcError("the last member is cut short")
            out.append(inflater.decompress(held))
            held = inflater.unused_data if inflater.eof else b""
        yield b"".join(out)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; its length and block digest are verified."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise WarcError("no record header")
    fields = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
    size = int(fields.get("content-length", -1))
    if size < 0 or rest[size:] != b"\r\n\r\n":
        raise WarcError("content length and record do not agree")
    block = rest[:size]
    if fields.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise WarcError("block digest")
    return fields, block


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes | None, int]:
    """Payload (None for a revisit) and its full length, from the HTTP header; its digest is verified."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if fields["warc-type"] == "revisit":
        return None, size
    if len(payload) != size or fields["warc-payload-digest"] != f"sha1:{digest(payload)}":
        raise WarcError("payload digest")
    return payload, size


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least_revisit: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per row; returns ``path``, ``records`` and ``bytes`` of the archives.

    Of records with equal payloads of at least ``least_revisit`` bytes, that with the smallest key is the
    response and the others revisit it. A null html is an empty payload; rows with a null key revisit the
    smallest key there is, and are responses where there is none. Repeated rows with the smallest key are
    responses each. Payloads are compared by SHA-1 and length. ``folder`` must be open to all executors by a
    path that ``pyarrow.fs`` knows. A task that runs again writes under a new name; only archives of finished
    tasks are listed. An empty table writes nothing.
    """
    rows = pages.select(F.col(key).cast("long").alias("_key"), F.col(url).alias("_url"), F.coalesce(html, F.lit("")).alias("_html"))
    rows = rows.withColumns({"_sha1": F.sha1(F.encode("_html", "UTF-8")), "_size": F.octet_length("_html")})
    first = rows.where(F.col("_size") >= least_revisit).groupBy("_sha1", "_size").agg(F.min("_key").alias("_first"), F.count("*").alias("_n"))
    first = first.where("_n > 1 and _first is not null").drop("_n")
    rows = rows.join(first, ["_sha1", "_size"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_first"))
    rows = rows.select("_key", "_url", F.when(~revisit, F.col("_html")).alias("_html"), "_size", F.unhex("_sha1").alias("_sha1"), F.when(revisit, F.col("_first")).alias("_first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, size, records, out, path = TaskContext.get(), 0, 0, 0, None, ""
        store, base = _opened(folder)
        store.create_dir(base, recursive=True)

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for b in batches:
            for k, u, h, n, s, f in zip(*b.columns, strict=True):
                if out is None:
                    path = f"{base}/{task.partitionId():06d}-{number:06d}-{task.taskAttemptId()}.warc.gz"
                    out, size, records = store.open_output_stream(path), 0, 0
                html_text = h.as_py()
                payload = None if html_text is None else html_text.encode("utf-8")
                raw = record(k.as_py(), u.as_py(), payload, n.as_py(), base64.b32encode(s.as_py()).decode(), f.as_py())
                out.write(raw)
                size, records = size + len(raw), records + 1
                if size >= archive_bytes:
                    yield closed()
                    out, number = None, number + 1
        if out is not None:
            yield closed()

    return landed(rows.mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, folder: str, key: str = "page_id") -> DataFrame:
    """Records of the archives in column ``path``: key, url, payload_bytes, payload_digest, record_type, refers_to, html.

    ``html`` is null for revisits. A record that is cut short or fails a digest ends the job with ``WarcError``.
    """
    names = [key, "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()], strict=True)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(folder)
        for b in batches:
            for path in b.column(0):
                rows, held = [], 0
                with store.open_input_stream(path.as_py()) as stream:
                    for member in members(stream):
                        fields, block = parse(member)
                        payload, size = payload_of(fields, block)
                        rows.append(
                            (
                                _page(fields["warc-record-id"]), fields.get("warc-target-uri"), size, fields["warc-payload-digest"][5:],
                                fields["warc-type"], _page(fields.get("warc-refers-to")), None if payload is None else payload.decode("utf-8"),
                            )
                        )
                        held += len(block)
                        if held > 8 * PORTION:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    paths = archives.select("path").repartition(archives.sparkSession.sparkContext.defaultParallelism * 4)
    return paths.mapInArrow(read, f"`{key}` long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string")


def archive_folder(spark) -> str:
    return shared_dir(spark, "warc")
