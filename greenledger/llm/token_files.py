"""Token-id files with Elias-Fano document boundaries.

A file is one concatenated id array followed by its index and a footer, so it is written in one pass:

    ids (little-endian unsigned 16- or 32-bit) | boundaries | document ids | footer (JSON) | footer length | magic

Boundaries (0, then the end of each document) and the ascending document ids are monotone sequences
and stored in Elias-Fano form: ``low`` bits of each value packed, the rest as a unary bit vector, and
a sample of where every ``SAMPLE``-th one bit lies. ``select`` looks one value up from a sample and
the bits after it; a value takes 2 + log2(universe / count) bits instead of 64.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenledger.llm.common import scratch, stored
from greenledger.llm.tokens import ROOMY, encoder, in_batches

MAGIC = b"EFTOKEN1"
SAMPLE = 256
#: Ids that a reader holds at a time, about.
_READ_IDS = 4_000_000


class EliasFano:
    """A monotone sequence of non-negative integers."""

    def __init__(self, count: int, low: int, lows: np.ndarray, upper: np.ndarray, samples: np.ndarray):
        self.count, self.low, self.lows, self.upper, self.samples = count, low, lows, upper, samples

    @classmethod
    def encode(cls, values) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (top // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[ones] = 1
        return cls(
            n,
            low,
            np.packbits(bits.ravel(), bitorder="little"),
            np.packbits(unary, bitorder="little"),
            ones[::SAMPLE].astype("<u4" if len(unary) < 2**32 else "<u8"),
        )

    def _lows(self, start: int, stop: int) -> np.ndarray:
        if not self.low:
            return np.zeros(stop - start, dtype=np.uint64)
        first, last = start * self.low, stop * self.low
        bits = np.unpackbits(self.lows[first // 8 : -(-last // 8)], bitorder="little")[first % 8 :][: last - first]
        weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
        return (bits.reshape(-1, self.low).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Values start..stop-1; reads from the sample before ``start`` on."""
        if stop <= start:
            return np.empty(0, dtype=np.uint64)
        block = start // SAMPLE
        begin = int(self.samples[block]) // 8
        end_block = -(-stop // SAMPLE)
        end = int(self.samples[end_block]) // 8 + 1 if end_block < len(self.samples) else len(self.upper)
        ones = np.flatnonzero(np.unpackbits(self.upper[begin:end], bitorder="little")) + begin * 8
        ones = ones[np.searchsorted(ones, int(self.samples[block])) :]
        at = ones[start - block * SAMPLE :][: stop - start]
        high = (at - np.arange(start, stop)).astype(np.uint64)
        return (high << np.uint64(self.low)) | self._lows(start, stop)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        return int(self.slice(i, i + 1)[0])

    def parts(self) -> list[bytes]:
        return [self.lows.tobytes(), self.upper.tobytes(), self.samples.tobytes()]

    def meta(self) -> dict:
        return {"count": self.count, "low": self.low, "sample": self.samples.dtype.str, "sizes": [len(x) for x in self.parts()]}

    @classmethod
    def decode(cls, meta: dict, data: bytes) -> EliasFano:
        a, b, _ = meta["sizes"]
        lows, upper = np.frombuffer(data[:a], np.uint8), np.frombuffer(data[a : a + b], np.uint8)
        return cls(meta["count"], meta["low"], lows, upper, np.frombuffer(data[a + b :], meta["sample"]))


class _Writer:
    def __init__(self, folder: str, width: int):
        self.store, path = fs.FileSystem.from_uri(folder)
        name = f"part-{uuid.uuid4().hex}.ids"
        self.uri, self.width = f"{folder}/{name}", width
        self.store.create_dir(path, recursive=True)
        self.file = self.store.open_output_stream(f"{path}/{name}", compression=None)
        self.ends, self.ids, self.nulls, self.total = [0], [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Documents come in ascending id order, null ids first."""
        if doc_id is None:
            self.nulls += 1
        else:
            self.ids.append(doc_id)
        if len(ids) and int(ids.max()) >= 1 << 8 * self.width:
            raise ValueError(f"token id {int(ids.max())} does not fit in {self.width} bytes; use a larger width")
        self.file.write(ids.astype(f"<u{self.width}").tobytes())
        self.total += len(ids)
        self.ends.append(self.total)

    def close(self) -> dict:
        base = self.ids[0] if self.ids else 0
        bounds = EliasFano.encode(self.ends)
        names = EliasFano.encode([x - base for x in self.ids])
        for part in (*bounds.parts(), *names.parts()):
            self.file.write(part)
        foot = {"width": self.width, "ids": self.total, "nulls": self.nulls, "base": base}
        foot = json.dumps(foot | {"bounds": bounds.meta(), "names": names.meta()}).encode()
        self.file.write(foot + len(foot).to_bytes(4, "little") + MAGIC)
        self.file.close()
        return {"file": self.uri, "docs": len(self.ends) - 1, "n_ids": self.total}


class TokenFile:
    """Reader: ``ids(i)`` of the i-th document, ``doc_id(i)``, ``span(i)``."""

    def __init__(self, uri: str):
        store, path = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = self._at(size - 12, 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        length = int.from_bytes(tail[:4], "little")
        foot = json.loads(self._at(size - 12 - length, length))
        self.width, self.nulls, self.base, self.total = foot["width"], foot["nulls"], foot["base"], foot["ids"]
        at, self.index = self.total * self.width, []
        for meta in (foot["bounds"], foot["names"]):
            self.index.append(EliasFano.decode(meta, self._at(at, sum(meta["sizes"]))))
            at += sum(meta["sizes"])
        self.bounds, self.names = self.index
        self.docs = self.bounds.count - 1

    def _at(self, start: int, n: int) -> bytes:
        return self.file.read_at(n, start)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.names.select(i - self.nulls) + self.base

    def span(self, i: int) -> tuple[int, int]:
        start, end = self.bounds.slice(i, i + 2).tolist()
        return start, end

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids start..end-1 of the file as unsigned 32-bit integers."""
        raw = self._at(start * self.width, (end - start) * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4", copy=False)

    def ids(self, i: int) -> np.ndarray:
        return self.read(*self.span(i))

    def close(self) -> None:
        self.file.close()


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 2,
) -> DataFrame:
    """Encode every text, append ``end_id`` and write token files in ascending document order.

    Returns the committed files: ``(file, part, docs, n_ids, start)``, ``start`` being the ids in all
    files before. ``path`` is a folder that driver and executors share (fresh if not given);
    ``tokenizer_path`` must exist on every executor; ``width`` is 2 for vocabularies up to 65,536, else
    4, and an id that does not fit is an error. Null text: empty, so the end id alone. Null document
    ids come first. Rows with the same id keep a document each, side by side. Other columns are
    ignored; an empty table writes no file.
    """
    folder = path or scratch(docs.sparkSession, "token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tie = F.xxhash64("text")  # splits rows of one id over tasks, and orders them
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part = None, TaskContext.get().partitionId()
        for batch in batches:
            names = batch.column(0).to_pylist()
            for at, texts in in_batches(batch.column(1).to_pylist()):
                out = out or _Writer(folder, width)
                for doc_id, ids in zip(names[at:], encoder(tokenizer_path, ROOMY).encode(texts), strict=False):
                    out.add(doc_id, np.frombuffer(ids + end, "<u4"))
        if out:
            yield pa.RecordBatch.from_pylist([out.close() | {"part": part}])

    files = rows.mapInArrow(write, "file string, docs long, n_ids long, part long")
    files = stored(files, "token-file-list")  # one row a file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, read from ``files(file, start)``.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                f = TokenFile(row["file"])
                at = 0
                while at < f.docs:
                    # so many documents that their ids fit in memory; one at least
                    ends = f.bounds.slice(at, min(at + 10_000, f.docs) + 1).astype(np.int64)
                    n = max(1, int(np.searchsorted(ends, ends[0] + _READ_IDS, side="right")) - 1)
                    ends = ends[: n + 1]
                    data = memoryview(f.read(int(ends[0]), int(ends[-1])).tobytes())
                    cuts = ((ends - ends[0]) * 4).tolist()
                    known = f.names.slice(max(0, at - f.nulls), max(0, at + n - f.nulls)).astype(np.int64) + f.base
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array([None] * (n - len(known)) + known.tolist(), pa.int64()),
                            "start": pa.array(ends[:-1] + row["start"], pa.int64()),
                            "n_tokens": pa.array(np.diff(ends), pa.int64()),
                            "ids_crc32": pa.array(
                                [zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.int64()
                            ),
                        }
                    )
                    at += n
                f.close()

    spread = files.select("file", "start").repartition(max(1, files.count()), "file")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
