"""Repeated passages by a sparse suffix array.

A passage of ``passage`` words holds ``passage - gram + 1`` word ``gram``-grams; the least of them by hash
(its minimiser) depends on the passage's words alone, so two copies of a passage choose the same place.
Only suffixes that begin at such places are retained.

1. Retained suffixes are brought together by the hash of their first ``gram`` words, and a suffix
   without an equal neighbour is dropped: no passage around it is repeated.
2. The others are extended to the left and to the right: each window of ``passage`` words whose
   minimiser survived is a candidate, candidates are brought together by hash, and those with an equal
   neighbour are repeated. Overlapping windows of a document join to maximal passages.

Any total order that puts equal prefixes side by side finds the same neighbours; the order of 64-bit
hashes is the one that is even. Equal neighbours are found by grouped minimum and maximum, combined
before the shuffle, so a passage that a third of the documents share costs each task a row.
The result is exact: a window is reported if and only if the same words stand elsewhere too (up to
collisions of 64-bit hashes among candidates). Equal texts are found by SHA-256 first and one of each
is searched.

Words are runs of bytes other than space and x09-x0D, compared as they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from greenledger.llm.common import giving_back, stored

PASSAGE, GRAM = 50, 14
#: Texts whose suffixes a worker holds at a time.
SCAN_ROWS = 1000
#: Bytes of a text that are hashed at a time, about.
_PART = 1 << 22
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NULL_ID = -(2**63)
_LETTER, _TOKEN = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as they were needed."""

    def __init__(self, base: int):
        self.pairs = [(base, np.ones(1, np.uint64)), (pow(base, -1, 2**64), np.ones(1, np.uint64))]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        for i, (base, known) in enumerate(self.pairs):
            while len(known) < n:
                known = np.concatenate([known, known * np.uint64(pow(base, len(known), 2**64))])
            self.pairs[i] = (base, known)
        return self.pairs[0][1][:n], self.pairs[1][1][:n]


_OF_LETTERS, _OF_TOKENS = _Powers(_LETTER), _Powers(_TOKEN)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Polynomial hashes of values[start:end]: equal for equal content, wherever it stands."""
    up, down = powers.upto(len(values) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)])
    return _mix((total[ends] - total[starts]) * down[starts])


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's words; the text is hashed part by part."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + _PART)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        data = np.frombuffer(text, np.uint8, end - at, at)
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        out.append(_ranges(data.astype(np.uint64) + np.uint64(1), edges[::2], edges[1::2], _OF_LETTERS))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows."""
    starts = np.arange(max(0, len(hashes) - n + 1))
    return _ranges(hashes, starts, starts + n, _OF_TOKENS)


def least_of(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n neighbouring values."""
    width = 1
    while width < n:
        step = min(width, n - width)
        values = np.minimum(values[:-step], values[step:])
        width += step
    return values


def _suffixes(text: bytes, passage: int, gram: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, prefix hashes of the retained suffixes, and those of them that occur twice in the text."""
    words = word_hashes(text)
    if len(words) < passage:
        return len(words), np.empty(0, np.uint64), np.empty(0, np.uint64)
    every = grams(words, gram)
    kept = np.unique(least_of(every, passage - gram + 1))
    every.sort()
    twice = np.searchsorted(every, kept, side="right") - np.searchsorted(every, kept, side="left") > 1
    return len(words), kept, kept[twice]


def _windows(text: bytes, wanted: np.ndarray, passage: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the windows whose minimiser is wanted, and whether the same stands earlier in the text."""
    words = word_hashes(text)
    at = np.flatnonzero(np.isin(least_of(grams(words, gram), passage - gram + 1), wanted))
    hashes = _ranges(words, at, at + passage, _OF_TOKENS)
    _, first = np.unique(hashes, return_index=True)
    again = np.ones(len(at), dtype=bool)
    again[first] = False
    return at, hashes, again


def _runs(places: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last word of the runs of overlapping windows at sorted places."""
    cut = np.flatnonzero(np.diff(places) > passage) + 1
    return places[np.concatenate([[0], cut])], places[np.concatenate([cut, [len(places)]]) - 1] + passage


def _text_bytes(x: str | None) -> bytes:
    return (x or "").encode("utf-8", "surrogatepass")


def text_key(text: Column) -> Column:
    """64 bits of a text's SHA-256; null counts as empty."""
    return F.xxhash64(_digest(F.coalesce(text.cast("string"), F.lit(""))))


def _digest(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


def repeated_passages(
    docs: DataFrame, passage: int = PASSAGE, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, start_word, n_words, duplicate, first_doc_id, text_key)``: passages that stand elsewhere too.

    A window of ``passage`` words has its first place in the smallest document id that holds it, and
    there at the earliest word. ``duplicate`` rows cover the windows whose first place is another;
    rows with ``duplicate`` false cover the first places of windows that are repeated. Of equal texts
    the smallest id is searched, and the others are one duplicate passage each. ``first_doc_id`` is
    the smallest document that holds a window of the row.

    Texts under ``passage`` words, empty and null ones have no rows. Rows of one id and one text are
    one document; rows of one id with different texts, or without an id, are told apart by
    ``text_key`` (:func:`text_key`), and the lowest key comes first. A null id counts as the smallest.
    Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("d"),
        _digest(text).alias("th"),
        text.alias("text"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SCAN_ROWS) for b in batches for at in range(0, b.num_rows, SCAN_ROWS)):
            found = [_suffixes(_text_bytes(x.as_py()), passage, gram) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([k.view(np.int64) for _, k, _ in found], pa.list_(pa.int64())),
                    pa.array([t.view(np.int64) for _, _, t in found], pa.list_(pa.int64())),
                ],
                names=["d", "th", "n", "ks", "twice"],
            )

    long_texts = texts.mapInArrow(giving_back(scan), "d long, th binary, n long, ks array<long>, twice array<long>")
    rows = stored(long_texts.where(F.col("n") >= passage), "suffixes")

    # One document of each text; the others are copies.
    heads = rows.groupBy("th").agg(F.min("d").alias("head"), F.max("d").alias("tail"))
    heads = stored(heads, "suffix-heads")
    copied = heads.where("head != tail").select("th", "head")
    one = F.col("d") == F.col("head")
    copies = rows.select("d", "th", "n").join(copied, "th").select(
        "d", F.lit(0).cast("long").alias("start_word"), F.col("n").alias("n_words"), (~one).alias("duplicate"), F.col("head").alias("first"), F.xxhash64("th").alias("t")
    )

    # 1. Suffixes with an equal neighbour in another text, or in their own.
    mine = rows.join(heads.select("th", F.col("head").alias("d")), ["th", "d"]).select("d", "th", "ks", "twice")
    each = mine.select("d", "th", F.explode("ks").alias("k"))
    side = F.xxhash64("th")
    shared = each.groupBy("k").agg(F.min(side).alias("a"), F.max(side).alias("b")).where("a != b").select("k")
    wanted = each.join(shared, "k").groupBy("d", "th").agg(F.collect_set("k").alias("ks"))
    own = mine.where(F.size("twice") > 0).select("d", "th", F.col("twice").alias("ks"))
    wanted = wanted.unionByName(own).groupBy("d", "th").agg(F.array_distinct(F.flatten(F.collect_list("ks"))).alias("ks"))

    # 2. Windows around them.
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, x, ks, t in zip(*(batch.column(i) for i in range(4)), strict=True):
                want = ks.values.to_numpy(zero_copy_only=False).view(np.uint64)
                at, hashes, again = _windows(_text_bytes(x.as_py()), want, passage, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), d.as_py()), pa.int64()),
                        pa.array(np.full(len(at), t.as_py()), pa.int64()),
                        pa.array(at.astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(again),
                    ],
                    names=["d", "t", "p", "h", "again"],
                )

    around = texts.join(wanted, ["d", "th"]).select("d", "text", "ks", F.xxhash64("th").alias("t"))
    windows = stored(around.mapInArrow(giving_back(extend), "d long, t long, p int, h long, again boolean"), "suffix-windows")
    place = F.struct("d", "t")
    least = windows.groupBy("h").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.max("again").alias("self"))
    least = least.where("x != y OR self").select("h", F.col("x.d").alias("first"), F.col("x.t").alias("a"))
    elsewhere = F.col("again") | (F.col("d") != F.col("first")) | (F.col("t") != F.col("a"))
    least = stored(least, "suffix-repeated")  # a join of two shuffles: a hot window can be split
    hits = windows.join(least, "h").select("d", "t", "p", "first", elsewhere.alias("dup"))
    per_doc = hits.groupBy("d", "t", "dup").agg(F.collect_list(F.struct("p", "first")).alias("hits"))

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ends = batch.column(3).values, batch.column(3).offsets.to_numpy()
            places, firsts = (found.field(c).to_numpy(zero_copy_only=False) for c in ("p", "first"))
            row, start, size, low = [], [], [], []
            for i, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                order = np.argsort(places[x:y], kind="stable")
                p, first = places[x:y][order].astype(np.int64), firsts[x:y][order]
                for a, b in zip(*_runs(p, passage), strict=True):
                    inside = first[np.searchsorted(p, a) : np.searchsorted(p, b - passage, side="right")]
                    row.append(i)
                    start.append(a)
                    size.append(b - a)
                    low.append(inside.min())
            same = [batch.column(i).take(pa.array(row, pa.int64())) for i in range(3)]
            numbers = [pa.array(x, pa.int64()) for x in (start, size, low)]
            yield pa.RecordBatch.from_arrays([*same, *numbers], names=["d", "t", "duplicate", "start_word", "n_words", "first"])

    per_doc = per_doc.select("d", "t", "dup", "hits")
    spans = per_doc.mapInArrow(
        giving_back(join_up), "d long, t long, duplicate boolean, start_word long, n_words long, first long"
    )
    named = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return spans.unionByName(copies.distinct()).select(
        named("d").alias("doc_id"), "start_word", "n_words", "duplicate", named("first").alias("first_doc_id"), F.col("t").alias("text_key")
    )


@F.pandas_udf(StringType())
def _without(text: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the words of the spans and the white space after them; null texts stay."""
    out = []
    for t, cuts in zip(text, spans, strict=True):
        if t is None or cuts is None:
            out.append(t)
            continue
        starts = [m.start() for m in _WORD.finditer(t)] + [len(t)]
        kept, at = [], 0
        for start, n in sorted((x["start_word"], x["n_words"]) for x in cuts):
            a, b = starts[min(start, len(starts) - 1)], starts[min(start + n, len(starts) - 1)]
            kept.append(t[at : max(at, a)])
            at = max(at, b)
        out.append("".join(kept) + t[at:])
    return pd.Series(out, dtype=object)


def remove_passages(
    docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None
) -> DataFrame:
    """``docs`` without the duplicate passages of ``spans``; a document left without a word goes.

    Columns stay; ``length_col`` gets the new number of characters where a text got shorter. Only
    affected texts go through Python. Rows are matched by id (null too) and text.
    """
    cuts = spans.where("duplicate").groupBy(F.col("doc_id").alias("_gl_id"), F.col("text_key").alias("_gl_key")).agg(
        F.collect_list(F.struct("start_word", "n_words")).alias("_gl_cuts")
    )
    same = docs[id_col].eqNullSafe(F.col("_gl_id")) & (text_key(docs[text_col]) == F.col("_gl_key"))
    joined = docs.join(cuts, same, "left")
    hit = F.col("_gl_cuts").isNotNull()
    joined = joined.withColumn("_gl_new", _without(F.when(hit, F.col(text_col)), F.col("_gl_cuts")))
    joined = joined.where(~hit | F.col("_gl_new").rlike(r"[^\x20\x09-\x0D]"))
    new = {text_col: F.col("_gl_new")}
    if length_col:
        new[length_col] = F.length("_gl_new").cast(docs.schema[length_col].dataType)
    return joined.select([F.when(hit, new[c]).otherwise(docs[c]).alias(c) if c in new else docs[c] for c in docs.columns])
