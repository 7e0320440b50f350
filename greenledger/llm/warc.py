"""WARC archives and their chunked record table.

Writing: payloads are cut into chunks of at most ``CHUNK_BYTES`` by Spark's own functions, so a
writer handles a record chunk by chunk and never allocates a whole one. Each task streams its records
into one gzip-per-record archive in the shared folder; the file's name holds a fresh id and only
archives named by the tasks that committed are read, so lost or repeated attempts leave no trace.

Reading: each archive is streamed into rows (record, chunk number) that carry the digest of the
record's bytes so far; the last chunk's digest is the payload's.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm.common import scratch, stored

CHUNK_BYTES = 1 << 20
#: Bytes of input, about, that one archive holds.
ARCHIVE_BYTES = 64 << 20
#: Rows and bytes per Arrow batch that the reader hands over.
_BATCH_BYTES = 8 << 20
_READ_BYTES = 1 << 18
_DATE = "1970-01-01T00:00:00Z"
#: Fixed: the HTTP head before each payload in a response record.
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK_SCHEMA = (
    "record_id string, page_id long, record_type string, refers_to long, declared_digest string, "
    "chunk int, start long, length long, digest_so_far string, last boolean, data binary"
)


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, digest, refers_to)`` for each different (page_id, payload) of ``pages(page_id, html)``.

    Of equal payloads of at least ``min_bytes`` bytes the smallest page_id answers for the others, whose
    ``refers_to`` names it; everything else has ``refers_to`` null. Rows with the answering page_id are
    all responses; null ids refer to the smallest id that is not null, if there is one.
    """
    narrow = pages.select("page_id", _payload().alias("payload")).select(
        "page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("n")
    )
    narrow = stored(narrow.distinct(), "warc-pages")
    least = narrow.where(F.col("n") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("least"), F.count(F.lit(1)).alias("copies")
    )
    least = least.where("copies > 1").drop("copies")
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("least")), F.col("least"))
    return narrow.join(least, "digest", "left").select("page_id", "digest", revisit.alias("refers_to"))


def _payload():
    return F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` under ``path``; returns ``(archive, records, bytes)``.

    ``path`` is a folder that driver and executors share, by any scheme pyarrow's file systems know
    (file, hdfs, s3, gs). Null html: empty payload; null url: no target. Repeated rows get a record
    each. An empty table writes no archive.
    """
    plan = plan_records(pages, min_bytes).select(
        F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "refers_to"
    )
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), _payload().alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows = rows.join(plan, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("digest") == F.col("_d")))
    n = F.octet_length("payload")
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    rows = rows.select(
        "page_id",
        "url",
        "refers_to",
        F.sha1("payload").alias("sha1"),
        n.cast("long").alias("size"),
        body.alias("payload"),
    )
    rows = rows.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.octet_length("payload") / CHUNK_BYTES) - 1)))
    )
    data = F.substring("payload", (F.col("chunk") * CHUNK_BYTES + 1).cast("int"), F.lit(CHUNK_BYTES))
    chunks = rows.select("page_id", "url", "refers_to", "sha1", "size", "chunk", data.alias("data"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Archive(path)
        for batch in batches:
            for row in batch.to_pylist():
                out.add(row)
        yield out.close()

    return chunks.mapInArrow(write, "archive string, records long, bytes long").where("records > 0")


class _Archive:
    """One archive, open from its first record on; every record is a gzip member of its own."""

    def __init__(self, folder: str):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.uri = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
        self.file, self.zip, self.left, self.records, self.bytes = None, None, 0, 0, 0

    def add(self, row: dict) -> None:
        """Takes the chunks of a record one after the other."""
        if row["chunk"] == 0:
            self._begin(row)
        self._put(row["data"])
        self.left -= len(row["data"])
        if self.left == 0:
            self._put(b"\r\n\r\n")
            self._raw(self.zip.flush())
            self.zip = None

    def _begin(self, row: dict) -> None:
        if self.zip is not None:
            raise ValueError("a record began before the last one's chunks were complete")
        if self.file is None:
            self.store.create_dir(self.folder, recursive=True)
            self.file = self.store.open_output_stream(f"{self.folder}/{self.uri.rpartition('/')[2]}", compression=None)
        revisit = row["refers_to"] is not None
        self.left = 0 if revisit else row["size"]
        page = "null" if row["page_id"] is None else row["page_id"]
        url = "".join((row["url"] or "").split())
        head = [
            "WARC/1.1",
            f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
            f"WARC-Date: {_DATE}",
            *([f"WARC-Target-URI: {url}"] if url else []),
            f"WARC-Payload-Digest: sha1:{base32_sha1(bytes.fromhex(row['sha1']))}",
            f"X-Page-ID: {page}",
            *([f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {row['refers_to']}"] if revisit else []),
            "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(_HTTP) + self.left}",
        ]
        self.zip = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.records += 1
        self._put("\r\n".join(head).encode() + b"\r\n\r\n" + _HTTP)

    def _put(self, data: bytes) -> None:
        self._raw(self.zip.compress(data))

    def _raw(self, data: bytes) -> None:
        self.bytes += len(data)
        self.file.write(data)

    def close(self) -> pa.RecordBatch:
        if self.zip is not None:
            raise ValueError("the last record's chunks are not complete")
        if self.file is not None:
            self.file.close()
        return pa.RecordBatch.from_pydict({"archive": [self.uri], "records": [self.records], "bytes": [self.bytes]})


def _inflate(stream) -> Iterator[bytes]:
    """Plain bytes of a file of gzip members, in pieces of bounded size."""
    member = zlib.decompressobj(31)
    while data := stream.read(_READ_BYTES):
        while data:
            yield member.decompress(data, CHUNK_BYTES)
            data = member.unconsumed_tail
            if member.eof:
                data, member = member.unused_data, zlib.decompressobj(31)


class _Lines:
    """Reads heads and exact numbers of bytes from a stream of pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def more(self) -> bool:
        for piece in self.pieces:
            if piece:
                self.held += piece
                return True
        return False

    def head(self) -> bytes | None:
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends within a record's head")
                return None
        out, self.held = self.held[:at], self.held[at + 4 :]
        return out

    def take(self, n: int) -> bytes:
        """At least one byte and at most n."""
        if not self.held and not self.more():
            raise ValueError("the archive ends within a record")
        out, self.held = self.held[:n], self.held[n:]
        return out

    def exactly(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            out += self.take(n - len(out))
        return out


def _records(stream) -> Iterator[dict]:
    """Chunk rows of an archive."""
    lines = _Lines(_inflate(stream))
    while (head := lines.head()) is not None:
        first, *fields = head.decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        field = {k.lower(): v for k, _, v in (x.partition(": ") for x in fields)}
        left = int(field["content-length"])
        http = lines.head()
        left -= len(http) + 4
        page = field["x-page-id"]
        same = {
            "record_id": field["warc-record-id"],
            "page_id": None if page == "null" else int(page),
            "record_type": field["warc-type"],
            "refers_to": int(field["x-refers-to-page-id"]) if "x-refers-to-page-id" in field else None,
            "declared_digest": field["warc-payload-digest"].removeprefix("sha1:"),
        }
        digest, chunk, start = hashlib.sha1(), 0, 0
        while True:
            data = lines.exactly(min(left, CHUNK_BYTES))
            digest.update(data)
            left -= len(data)
            yield same | {
                "chunk": chunk,
                "start": start,
                "length": len(data),
                "digest_so_far": base32_sha1(digest.digest()),
                "last": left == 0,
                "data": data,
            }
            chunk, start = chunk + 1, start + len(data)
            if left == 0:
                break
        if lines.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def read_warc(archives: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunked record table of ``archives(archive)``: one row per record and chunk, see CHUNK_SCHEMA.

    ``digest_so_far`` is the bare base32 SHA-1 of the record's payload up to the end of the chunk. A
    revisit record has one empty chunk. ``with_data=False`` leaves ``data`` null.
    """
    schema = pa.schema(
        [
            ("record_id", pa.string()),
            ("page_id", pa.int64()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("declared_digest", pa.string()),
            ("chunk", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("digest_so_far", pa.string()),
            ("last", pa.bool_()),
            ("data", pa.binary()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(uri)
                with store.open_input_stream(path, compression=None) as stream:
                    for row in _records(stream):
                        if not with_data:
                            row["data"] = None
                        rows.append(row)
                        held += row["length"] * with_data + 200
                        if held >= _BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("archive").mapInArrow(read, CHUNK_SCHEMA)


def page_records(chunks: DataFrame) -> DataFrame:
    """Per record of the chunked table: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest are those read from the chunks; a revisit takes the length of the response it
    refers to, found by page id and digest.
    """
    records = chunks.groupBy("record_id").agg(
        F.first("page_id").alias("page_id"),
        F.first("record_type").alias("record_type"),
        F.first("refers_to").alias("refers_to"),
        F.first("declared_digest").alias("declared"),
        F.sum("length").alias("bytes"),
        F.max_by("digest_so_far", "chunk").alias("digest"),
    )
    records = stored(records, "warc-records")
    whole = records.where("record_type = 'response'").select(
        F.col("page_id").alias("_p"), F.col("digest").alias("_d"), F.col("bytes").alias("_bytes")
    )
    back = records.where("record_type = 'revisit'").join(
        whole.distinct(), (F.col("refers_to") == F.col("_p")) & (F.col("declared") == F.col("_d"))
    )
    back = back.select("page_id", F.col("_bytes").alias("payload_bytes"), F.col("_d").alias("payload_digest"), "record_type", "refers_to")
    own = records.where("record_type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
    return own.unionByName(back)


def archive_pages(spark: SparkSession, pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives (under ``path``, or a fresh shared folder) and return the list of them, committed."""
    archives = stored(write_warc(pages, path or scratch(spark, "warc"), min_bytes), "warc-archives")
    return archives.repartition(max(1, archives.count()), "archive")
