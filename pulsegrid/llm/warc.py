"""WARC archives: a writer per partition and a sequential reader.

Every record is a gzip member of its own. The reader takes an archive as a stream of chunks,
inflates one member at a time, frames the record by its Content-Length and verifies block and
payload digests; it holds one record in memory. Archives lie in the folder all executors share.
Each attempt of a writing task makes files of its own names, and only the names that the finished
attempts returned (the manifest, a staged table) are read: a lost executor leaves at most files that
nobody lists.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import new_folder, staged

# fixed values of the WARC 1.1 format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    name = identifier.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as one gzip member."""
    head = [VERSION, *(f"{name}: {value}".encode() for name, value in fields),
            b"Content-Length: %d" % len(block)]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                date: str) -> bytes:
    """A response with the payload, or a revisit of page ``refers_to`` with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
               ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
               ("Content-Type", "application/http;msgtype=response")]
    return member(fields, block)


def members(stream: BinaryIO) -> Iterator[bytes]:
    """The inflated gzip members of a stream, one at a time."""
    data = stream.read(CHUNK)
    while data:
        inflate, parts = zlib.decompressobj(31), []
        while True:
            parts.append(inflate.decompress(data))
            if inflate.eof:
                break
            data = stream.read(CHUNK)
            if not data:
                raise ValueError("archive ends within a gzip member")
        data = inflate.unused_data or stream.read(CHUNK)
        yield b"".join(parts)


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record; digests are verified."""
    for raw in members(stream):
        head, found, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not found or not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record at the start of a member")
        fields = {name.strip().lower(): value.strip()
                  for name, _, value in (line.partition(":") for line in lines[1:])}
        size = int(fields["content-length"])
        block, tail = rest[:size], rest[size:]
        if len(block) != size or tail != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} is not framed by its length")
        if fields.get("warc-block-digest", f"sha1:{sha1_base32(block)}") != f"sha1:{sha1_base32(block)}":
            raise ValueError(f"block of {fields.get('warc-record-id')} does not match its digest")
        yield fields, block


def page_rows(stream: BinaryIO) -> Iterator[tuple]:
    """The pages of an archive as rows of ``RECORD``; a revisit has no payload of its own."""
    for fields, block in records(stream):
        kind = fields["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        length = next(int(line.partition(b":")[2]) for line in http.split(b"\r\n")
                      if line.lower().startswith(b"content-length:"))
        digest = fields["warc-payload-digest"].partition(":")[2]
        if kind == "response" and (len(payload) != length or sha1_base32(payload) != digest):
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
        yield (page_of(fields["warc-record-id"]), length, digest, kind,
               page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
               fields.get("warc-target-uri"), payload if kind == "response" else None)


def with_payload(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: of pages with equal payloads of at least ``least_bytes``
    bytes all but the one with the largest page_id refer to that one.

    Payloads are equal when length and SHA-1 are. Null html is an empty payload. Pages without an id
    refer to the largest id of their payload; where none has an id, none refers. Rows that repeat
    the largest id all stay responses.
    """
    own = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    own = own.withColumn("sha1", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    equal = staged(own.where(F.col("bytes") >= least_bytes).groupBy("sha1", "bytes").agg(
        F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "equal")
    joined = own.join(equal, ["sha1", "bytes"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 256 << 20,
                   date: str | None = None) -> DataFrame:
    """Write the records of ``with_payload`` rows below ``folder``; the staged manifest has
    ``path, records, bytes`` of every archive. An archive is closed once it passes
    ``archive_bytes``."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out = name = None
        done: list[tuple[str, int, int]] = []
        count = size = 0
        for batch in batches:
            for page in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                page_id, url, payload, refers_to = (x.as_py() for x in page)
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out, count = store.open_output_stream(f"{root}/{name}", compression=None), 0
                    size = out.write(member([
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                        ("WARC-Date", date), ("WARC-Filename", name),
                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                data = page_record(page_id, url, payload, refers_to, date)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{n}" for n, _, _ in done]), *(pa.array([x[i] for x in done], pa.int64())
                                                                    for i in (1, 2))],
                names=["path", "records", "bytes"])

    return staged(pages.mapInArrow(write, "path string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The page records (``RECORD``) of all archives in the manifest, an archive per row; without
    ``payloads`` the payloads are verified and left out."""
    names = [part.split()[0] for part in RECORD.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    wanted = len(names) - (not payloads)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = filesystem(path)
                with store.open_input_stream(name, compression=None) as stream:
                    rows, size = [], 0
                    for row in page_rows(stream):
                        rows.append(row)
                        size += 200 + (len(row[-1] or b"") if payloads else 0)
                        if size >= 8 * CHUNK:
                            yield batch_of(rows)
                            rows, size = [], 0
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:wanted], types)],
                                          names=names[:wanted])

    spread = manifest.repartition(max(manifest.sparkSession.sparkContext.defaultParallelism, 1) * 4, "path")
    return spread.mapInArrow(read, ", ".join(RECORD.split(", ")[:wanted]))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written as archives in the shared folder and read back, without their payloads. An
    empty table makes no archive and gives no rows; columns other than page_id, url and html are
    left out."""
    folder = new_folder(pages.sparkSession, "archives")
    manifest = write_archives(with_payload(pages, least_bytes), folder)
    return read_archives(manifest, payloads=False)
