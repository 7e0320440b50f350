"""Which tokens of two tokenizers cover the same bytes: interval coalescing over token byte ranges.

All tokens of both sides are sorted by start (``lexsort``), the running maximum of their ends is taken
(``maximum.accumulate``), and a group breaks where a start reaches it. Within a group the overlapping
pairs are expanded from each A token's range of B tokens.

Neither tokenizer merges across a space that follows a non-space, so both end a token there and no group
reaches over it. Texts are cut into *units* at these places, a batch of documents aligns each different
unit once, and a document is the sequence of its units. Batches keep unit codes and the links of their
units in a stored table; the corpus-wide counts of id pairs come from one row per batch and pair, and
return to the batch by a join, so nothing depends on how many pairs there are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenledger.llm.common import stored
from greenledger.llm.tokens import Encoder

#: A batch ends with the document that brings it to so many different units, characters of them, or units in all.
BATCH_UNITS, BATCH_CHARS, BATCH_TOTAL = 150_000, 8_000_000, 6_000_000
#: Characters of a text that are cut into units at a time, and units aligned at a time.
SLICE, ALIGN_UNITS = 1 << 20, 20_000
_CUT = re.compile(r"(?<=\S)(?= )")
_ODD = re.compile(r"\s ")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
#: What marks a space in a piece.
_SPACE = "▁"


class Aligner:
    """Tokens of both sides, and their alignment. A unit is a text that both sides read with a space before it."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Encoder(path_a, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {v: k for k, v in self.a.letters.items()}
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        spelled_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            spelled_a[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        spelled_b = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(x)) else x.replace(_SPACE, " ").encode() for x in pieces]
        self.spelled = [spelled_a, spelled_b]
        self.lengths = [np.array([len(x) for x in s], np.int64) for s in self.spelled]
        # cuts hold if no piece goes on with a space after something else, and nothing is normalized
        probe = "a  ﬁ ①\n b "
        same = b"".join([spelled_b[i] for i in self.b.encode(probe)]) == (" " + probe).encode()
        self.cuts = self.a.rule == "space" and same and not any(_SPACE in x.lstrip(_SPACE) for x in pieces)
        self.lone = [i for i, x in enumerate(pieces) if x == _SPACE]
        ids = range(max(map(len, self.spelled)))
        self.width = len(ids)
        self.texts = np.array([f"{i}{sep}".encode() for sep in ("", ",", "|", ";") for i in ids], dtype=object)

    def units(self, text: str) -> Iterator[list[str]]:
        """The units of a text, slice by slice."""
        at = 0
        while at <= len(text):
            cut = _CUT.search(text, at + SLICE) if self.cuts and at + SLICE < len(text) else None
            end = cut.start() if cut else len(text)
            part = text[at:end]
            if not self.cuts:
                yield [part]
            elif _ODD.search(part) or part[:1] == " ":
                yield [x[1:] for x in _CUT.split(" " + part)]
            else:
                yield part.split(" ")
            at = end + 1

    def tokens(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per side: the ids of all units and the number of each."""
        a = self.a.encode_words(units)
        b = self.b.encode(units, num_threads=1)
        for k, x in enumerate(units):
            if not x:  # nothing but the space that the tokenizer adds to what is not empty
                b[k] = self.lone
        counts = (np.fromiter((len(x) // 4 for x in a), np.int64, len(a)), np.fromiter(map(len, b), np.int64, len(b)))
        ids = (np.frombuffer(b"".join(a), "<u4").astype(np.int64), np.fromiter(chain.from_iterable(b), np.int64))
        return list(zip(ids, counts, strict=True))

    def _spelled_right(self, units: list[str], sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Units whose bytes both sides give back."""
        raw = [b" " + x.encode() for x in units]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        good = np.ones(len(raw), bool)
        for (ids, n), spelled, length in zip(sides, self.spelled, self.lengths, strict=True):
            ends = np.cumsum(n)
            reach = np.concatenate(([0], np.cumsum(length[ids])))
            words = [spelled[i] for i in ids.tolist()]
            if (reach[ends] - reach[ends - n] == size).all() and b"".join(words) == b"".join(raw):
                continue
            for k, (x, e, m) in enumerate(zip(raw, ends.tolist(), n.tolist(), strict=True)):
                good[k] &= b"".join(words[e - m : e]) == x
        return good

    def align(self, units: list[str]) -> dict:
        """Per unit ``good`` (both sides spell it), ``n_a, n_b, n_groups, n_links, groups`` as text; all ids linked."""
        sides = self.tokens(units)
        good = self._spelled_right(units, sides)
        ids, start, end, of = [], [], [], []
        for (every, n), length in zip(sides, self.lengths, strict=True):
            unit = np.repeat(np.arange(len(units)), n)
            keep = good[unit]
            stop = np.cumsum(length[every[keep]])  # the tokens of good units tile their bytes, unit after unit
            ids.append(every[keep]), of.append(unit[keep]), end.append(stop), start.append(stop - length[every[keep]])
        group = _coalesced(start, end)
        total = lambda at: np.bincount(at, minlength=len(units)).astype(np.int64)
        first = np.searchsorted(end[1], start[0], side="right")
        n = np.searchsorted(start[1], end[0], side="left") - first
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return {
            "good": good,
            "n_a": total(of[0]),
            "n_b": total(of[1]),
            "n_groups": total(of[0][np.diff(group[0], prepend=-1) > 0]),
            "n_links": total(np.repeat(of[0], n)),
            "pair": np.repeat(ids[0], n) << 32 | ids[1][np.repeat(first, n) + step],
            "groups": self._written(ids, group, of, len(units)),
        }

    def _written(self, ids: list, group: list, of: list, units: int) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of every unit."""
        side = np.repeat([0, 1], [len(ids[0]), len(ids[1])])
        every, groups, unit = (np.concatenate(x) for x in (ids, group, of))
        order = np.lexsort((side, groups))  # stable: ids of a side stay in order
        every, groups, unit, side = every[order], groups[order], unit[order], side[order]
        sep = np.zeros(len(every), np.int64)
        same = groups[1:] == groups[:-1]
        sep[:-1] = np.where(same, np.where(side[1:] == side[:-1], 1, 2), np.where(unit[1:] == unit[:-1], 3, 0))
        parts = self.texts[sep * self.width + every].tolist()
        ends = np.cumsum(np.bincount(unit, minlength=units)).tolist()
        return [b"".join(parts[s:e]) for s, e in zip([0, *ends], ends, strict=False)]


def _coalesced(start: list[np.ndarray], end: list[np.ndarray]) -> list[np.ndarray]:
    """Group numbers of either side's tokens: a group ends where the next start reaches the running maximum of ends."""
    starts, ends = np.concatenate(start), np.concatenate(end)
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.zeros(len(order), np.int64)
    group[order[1:]] = np.cumsum(starts[order][1:] >= reach[:-1])
    return np.split(group, [len(start[0])])


class _Codes(dict):
    """Numbers of units in the order they are met."""

    chars = 0

    def __missing__(self, unit: str) -> int:
        code = self[unit] = len(self)
        self.chars += len(unit)
        return code


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(x.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(x, decompressed_size=4 * n, codec="zstd", asbytes=True), "<i4")


#: A row per document (``codes``: its units), and one per batch (``links`` of each unit, ``slots`` of each link in ``pairs``).
_BATCH = pa.schema(
    [("batch", pa.int64()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("codes", pa.binary()), ("size", pa.int64())]
    + [("links", pa.binary()), ("slots", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)


def _batch_rows(aligner: Aligner, batch: int, docs: list[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch: ``docs`` of (id, unit codes or None)."""
    found = [aligner.align(names[i : i + ALIGN_UNITS]) for i in range(0, max(1, len(names)), ALIGN_UNITS)]
    unit = {k: np.concatenate([x[k] for x in found]) for k in found[0] if k != "groups"}
    groups = list(chain.from_iterable(x["groups"] for x in found))
    rows: list[tuple] = []
    times = np.zeros(len(names), np.int64)
    for doc_id, codes in docs:
        if codes is not None and not unit["good"][codes].all():
            # a side spells a unit otherwise: the whole text, as one unit, decides
            text = " ".join(map(names.__getitem__, codes.tolist()))
            one = aligner.align([text])
            codes = np.array([len(groups)], np.int32) if one["good"][0] else None
            if codes is not None:
                unit = {k: np.append(v, one[k]) for k, v in unit.items()}
                groups.append(one["groups"][0])
                names.append(text)
                times = np.append(times, 0)
        if codes is None:
            rows.append((batch, doc_id, 0, 0, 0, 0, "", None, 0, None, None, None, None))
            continue
        digest = hashlib.sha256(groups[codes[0]])
        for i in range(1, len(codes), SLICE):
            digest.update(b";" + b";".join(map(groups.__getitem__, codes[i : i + SLICE].tolist())))
        sums = [int(unit[k][codes].sum()) for k in ("n_a", "n_b", "n_groups", "n_links")]
        times += np.bincount(codes, minlength=len(times))
        rows.append((batch, doc_id, *sums, digest.hexdigest(), _packed(codes), len(codes), None, None, None, None))
    pairs, slot = np.unique(unit["pair"], return_inverse=True)
    used = np.bincount(slot, weights=np.repeat(times, unit["n_links"]), minlength=len(pairs)).astype(np.int64)
    sizes = (_packed(unit["n_links"]), _packed(slot), pairs, used)
    rows.append((batch, None, 0, 0, 0, 0, None, None, len(unit["n_links"]), *sizes))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BATCH.types, strict=True)]
    yield pa.RecordBatch.from_arrays(columns, schema=_BATCH)


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)  # its memory goes with the task
        batch = TaskContext.get().partitionId() << 32
        codes, docs, total = _Codes(), [], 0
        for some in batches:
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                units = None
                if text:
                    parts = (np.fromiter(map(codes.__getitem__, u), np.int32, len(u)) for u in aligner.units(text))
                    units = np.concatenate(list(parts))
                    total += len(units)
                docs.append((doc_id, units))
                if len(codes) >= BATCH_UNITS or codes.chars >= BATCH_CHARS or total + len(docs) >= BATCH_TOTAL:
                    yield from _batch_rows(aligner, batch, docs, list(codes))
                    codes, docs, total, batch = _Codes(), [], 0, batch + 1
        if docs:
            yield from _batch_rows(aligner, batch, docs, list(codes))

    return run


def _scored(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a batch with the sums over their links."""
    count = np.zeros(pairs.num_rows, np.int64)
    best = np.zeros(pairs.num_rows, np.int64)
    slot = pairs["slot"].to_numpy()
    count[slot], best[slot] = pairs["count"].to_numpy(), pairs["best"].to_numpy()
    is_head = pc.is_valid(docs["links"])
    head = docs.filter(is_head).to_pylist()[0]
    n = _unpacked(head["links"], head["size"])
    slots = _unpacked(head["slots"], int(n.sum()))
    ends = np.concatenate(([0], np.cumsum(n)))
    best, count = (np.concatenate(([0], np.cumsum(x[slots]))) for x in (best, count))
    best, count = (x[ends[1:]] - x[ends[:-1]] for x in (best, count))  # per unit
    rows = docs.filter(pc.invert(is_head)).drop_columns(["batch", "links", "slots"])
    sums = [(0, 0)] * rows.num_rows
    for i, (codes, size) in enumerate(zip(rows["codes"], rows["size"].to_pylist(), strict=True)):
        if size:
            units = _unpacked(codes.as_py(), size)
            sums[i] = int(best[units].sum()), int(count[units].sum())
    n_best, count_sum = zip(*sums, strict=True) if sums else ((), ())
    rows = rows.drop_columns(["codes", "size"])
    return rows.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)``: the alignment of tokenizer A (byte-level BPE, JSON) and B (a sentencepiece model).

    A reads a space and the text, B the text (it adds the space). ``documents``: ``doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256``, one row per input row. ``pairs``: ``a, b,
    count, best``, every linked pair of ids with its links in all documents and whether no other A id has
    more with that B id. A null or empty text, or one that a side does not give back byte for byte, has
    no tokens. Null ids, repeated rows and an empty table are like any others; other columns are not
    looked at; a long text is cut in slices. Both files must exist on every executor.
    """
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = (
        "batch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, "
        "size long, links binary, slots binary, pairs array<long>, times array<long>"
    )
    batches = stored(rows.mapInArrow(_aligned(path_a, path_b), schema), "alignment")
    heads = batches.where(F.col("links").isNotNull())
    used = heads.select("batch", F.posexplode(F.arrays_zip("pairs", "times")).alias("slot", "x"))
    used = used.select("batch", "slot", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    counts = used.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b", b)
    most = F.max("count").over(Window.partitionBy("b"))
    counts = stored(counts.withColumn("best", F.col("count") == most), "pair-counts")
    back = used.drop("times").join(counts.select("pair", "count", F.col("best").cast("long").alias("best")), "pair")
    back = back.select(F.col("batch").alias("of"), "slot", "count", "best")
    parts = batches.drop("pairs", "times").groupBy("batch").cogroup(back.groupBy("of"))
    out = parts.applyInArrow(
        _scored,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long",
    )
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    pairs = counts.where("count > 0").select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("b").cast("int"), "count", "best")
    return out.select(*columns), pairs
