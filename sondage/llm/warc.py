"""WARC archives: one gzip member for each record, written by tasks and read sequentially.

The reader inflates members step by step, frames records by content-length and verifies block and payload digests, so
its memory is one piece of input, not a record or an archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_dir, written

#: Compressed bytes after which an archive is closed, and bytes that the reader takes at a time.
ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 16
#: Payloads below this many bytes are never written as revisits.
LEAST_REVISIT = 1000
DATE = "2020-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "block_ok boolean, payload_ok boolean, archive string, error string"
)


def _b32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}|{url}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as its gzip member; a revisit has the response's head and no payload."""
    digest = _b32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_id(page_id, url)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: {digest}", f"WARC-Block-Digest: {_b32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    head += [f"Page-ID: {page_id}"] if page_id is not None else []
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"Refers-To-Page-ID: {refers_to}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


class Member:
    """A stream over one gzip member at a time."""

    def __init__(self, stream: BinaryIO) -> None:
        self.stream, self.rest, self.out, self.inflate = stream, b"", b"", None

    def begin(self) -> bool:
        """Opens the next member; false at the end of the archive."""
        if not self.rest:
            self.rest = self.stream.read(PIECE)
        self.out, self.inflate = b"", zlib.decompressobj(31)
        return bool(self.rest)

    def more(self) -> bool:
        """Inflates one more piece; false once the member has ended."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.rest or self.stream.read(PIECE)
            if not data:
                raise ValueError("truncated member")
            self.rest = b""
            got = self.inflate.decompress(data, PIECE)
            if self.inflate.eof:
                self.rest = self.inflate.unused_data
            if got:
                self.out += got
                return True
        return False

    def line_block(self) -> bytes:
        """Up to and with the next empty line."""
        while (at := self.out.find(b"\r\n\r\n")) < 0:
            if len(self.out) > 1 << 20 or not self.more():
                raise ValueError("no end of headers")
        got, self.out = self.out[: at + 4], self.out[at + 4 :]
        return got

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next n bytes."""
        while n:
            if not self.out and not self.more():
                raise ValueError("record shorter than its content-length")
            got, self.out = self.out[:n], self.out[n:]
            n -= len(got)
            yield got

    def close(self) -> None:
        while self.more():
            pass
        if self.out != b"\r\n\r\n":
            raise ValueError("record longer than its content-length")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def records(stream: BinaryIO) -> Iterator[dict]:
    """The response and revisit records of an archive in order; a damaged record ends it with an ``error`` row."""
    member = Member(stream)
    try:
        while member.begin():
            head = _fields(member.line_block())
            length, kind = int(head["content-length"]), head["warc-type"]
            block, payload, http, n = hashlib.sha1(), hashlib.sha1(), b"", 0
            head_done = kind not in ("response", "revisit")
            for piece in member.pieces(length):
                block.update(piece)
                if not head_done:
                    http += piece
                    if (at := http.find(b"\r\n\r\n")) < 0:
                        continue
                    head_done, piece, http = True, http[at + 4 :], http[: at + 4]
                payload.update(piece)
                n += len(piece)
            member.close()
            if kind not in ("response", "revisit"):
                continue
            said = base64.b32decode(head["warc-payload-digest"].partition(":")[2])
            page = head.get("page-id")
            whole = kind == "response"
            yield {
                "page_id": int(page) if page else None, "url": head.get("warc-target-uri"), "record_type": kind,
                "payload_bytes": n if whole else int(_fields(http)["content-length"]), "payload_digest": payload.hexdigest() if whole else said.hex(),
                "refers_to": None if whole else int(head["refers-to-page-id"]), "block_ok": _b32(block.digest()) == head["warc-block-digest"],
                "payload_ok": not whole or payload.digest() == said, "error": None,
            }
    except (ValueError, KeyError, zlib.error) as e:
        yield dict.fromkeys(("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "block_ok", "payload_ok")) | {"error": str(e)}


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, refers_to``: of equal payloads of ``LEAST_REVISIT`` bytes or more, the largest page_id is
    stored and the others refer to it; rows that repeat the largest page_id are stored too. Rows without a page_id
    refer to it as well, and are stored if the whole group has none.

    Only digests that occur twice or more meet the pages, after a partial aggregation, so a group of copies of any size
    is one row there.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_digest", F.when(F.octet_length("html") >= LEAST_REVISIT, F.sha1(F.encode("html", "UTF-8"))))
    stored = rows.where("_digest is not null").groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("_stored")).where("_n > 1 and _stored is not null")
    # rows below the limit have no digest: they stay beside the join, which a null key would crowd into one task
    alone = rows.where("_digest is null").withColumn("_stored", F.lit(None).cast("long")).drop("_digest")
    out = rows.where("_digest is not null").join(stored.drop("_n"), "_digest", "left").drop("_digest").unionByName(alone)
    same = F.col("_stored") == F.col("page_id")
    return out.select("page_id", "url", "html", F.when(~F.coalesce(same, F.lit(False)), F.col("_stored")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    """Writes ``page_id, url, html, refers_to`` rows as archives under ``path``; returns the table of archives.

    The rows are written where they lie, without another shuffle, or dealt to ``parts`` partitions. A task writes its
    archives under names of its own and renames each once it is whole; a task that runs again writes the same bytes to
    the same names, as its rows are sorted.
    """
    rows = pages.repartition(parts, F.xxhash64("page_id", "url")) if parts else pages
    rows = rows.sortWithinPartitions("page_id", "url", "html").withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        out, name, size, n, seq, done = None, "", 0, 0, 0, []

        def close() -> None:
            out.close()
            store.move(name, final := f"{root}/pages-{part:06d}-{seq:04d}.warc.gz")
            done.append((f"{path}/{final.rpartition('/')[2]}", n, size))

        for rb in batches:
            part = rb.column("part")[0].as_py()
            for page_id, url, html, refers in zip(*(rb.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    name = f"{root}/.{uuid.uuid4().hex}"
                    out, size, n = store.open_output_stream(name, compression=None), 0, 0
                member = record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers.as_py())
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    out, seq = None, seq + 1
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in zip(("path", "records", "bytes"), map(list, zip(*done, strict=True)), strict=True)})

    return written(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


def list_archives(spark, path: str) -> DataFrame:
    """The archives under a folder: ``path``; their content isn't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", True).load(path).select("path")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row for each response or revisit record of the archives in column ``path``, digests verified."""
    names = [x.strip().split(" ")[0] for x in RECORDS.split(",")]
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[k]) for n, k in (x.strip().split(" ") for x in RECORDS.split(","))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for path in rb.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                rows = []
                with store.open_input_stream(name, compression=None) as stream:
                    for row in records(stream):
                        rows.append(row | {"archive": path.rpartition("/")[2]})
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist([{k: r[k] for k in names} for r in rows], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([{k: r[k] for k in names} for r in rows], schema=schema)

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(parts, "path").mapInArrow(run, RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """All pages written as archives in the shared folder, then read back and verified (see ``read_archives``)."""
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(with_revisits(pages), path))
