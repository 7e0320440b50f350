"""Best-two-fit packing of token sequences.

Only lengths matter to packing and there are at most ``capacity`` of them, so Spark counts pieces by
length, the driver packs the counts (a bin's pattern is applied as often as the counts allow), and
Spark gives each piece its place from its rank among the pieces of its length. What the driver holds
is bounded by the capacity, whatever the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import gapless_index, giving_back, stored
from greenledger.llm.tokens import BATCH_CHARS, encoder, forget_encoders, in_batches

#: Pieces, about, that share one (length, sub) group when ranks are made.
SUB_ROWS = 50_000


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ``([(length, times), ...], bins)`` that use up ``counts`` exactly.

    A bin is filled greedily, largest fitting length first; then its smallest document gives way to the
    two unpacked ones that fill its place and the gap best, if they fill more than it did. The same
    pattern is used for as many bins as the counts allow.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return out
        used: dict[int, int] = {}
        free, gap = left.copy(), capacity
        lengths = np.flatnonzero(free)
        while (at := np.searchsorted(lengths, gap, side="right")) > 0:
            x = int(lengths[at - 1])
            n = int(min(free[x], gap // x))
            used[x] = used.get(x, 0) + n
            free[x] -= n
            gap -= x * n
            lengths = lengths[:at] if free[x] else np.delete(lengths[:at], at - 1)
        small = min(used)
        if gap and (pair := _two(free, gap + small, small)):
            used[small] -= 1
            for x in pair:
                used[x] = used.get(x, 0) + 1
        used = {x: n for x, n in used.items() if n}
        bins = min(int(left[x]) // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= n * bins
        out.append((sorted(used.items(), reverse=True), bins))


def _two(free: np.ndarray, room: int, more_than: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum in (more_than, room]."""
    lengths = np.flatnonzero(free[: room + 1])
    if not len(lengths):
        return None
    at = np.searchsorted(lengths, room - lengths, side="right") - 1
    alone = (at >= 0) & (lengths[at] == lengths) & (free[lengths] < 2)  # a length that is there once pairs with a smaller one
    at = at - alone
    total = np.where(at >= 0, lengths + lengths[at], 0)
    best = int(np.argmax(total))
    return (int(lengths[best]), int(lengths[at[best]])) if total[best] > more_than else None


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
    forget: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: documents cut only where longer than ``capacity``."""
    end = np.array([end_id], dtype="<u4").tobytes()
    chars = BATCH_CHARS // 2 if forget else BATCH_CHARS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for at, texts in in_batches((x.as_py() for x in batch.column(1)), chars):
                rows = []
                for doc_id, ids in zip(names[at:], encoder(tokenizer_path).encode(texts), strict=False):
                    ids += end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        rows.append((doc_id, k, start // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, names=fields)
        if forget:
            forget_encoders()

    fields = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(giving_back(cut), schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
    forget: bool = False,
) -> DataFrame:
    """Pack every document's ids (and ``end_id``) into sequences of at most ``capacity`` tokens.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, with ``keep_ids``,
    ``ids`` (little-endian unsigned 32-bit). Null text: empty, so the end id alone. Repeated rows and
    null ids are packed like any others; an empty table gives no row. ``tokenizer_path`` must exist on
    every executor. Other columns are ignored. ``forget`` ends a task's memory of words with the task
    and encodes half as much text at a time, where other work shares the session's workers.
    """
    cut = pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, keep_ids, forget)
    columns = cut.columns
    # Pieces are numbered as written, so that equal ones can be told apart and spread.
    cut = stored(cut.withColumn("_gl_row", F.monotonically_increasing_id()), "pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = best_two_fit(counts, capacity)
    runs = {x: [] for x in counts}  # per length: rank from, first sequence, times in a bin, offset in the bin
    used, base = dict.fromkeys(counts, 0), 0
    for pattern, bins in plan:
        offset = 0
        for x, n in pattern:
            runs[x].append((used[x], base, n, offset))
            used[x] += n * bins
            offset += x * n
        base += bins
    runs = {x: np.array(r, dtype=np.int64) for x, r in runs.items()}

    # Ids are most of a row: they meet the places in the end, and neither ranks nor workers see them.
    through = ["_gl_row"] if keep_ids else columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(length[order]) != 0]) if len(order) else []
            for rows in np.split(order, starts[1:]) if len(order) else []:
                x = int(length[rows[0]])
                run = runs[x][np.searchsorted(runs[x][:, 0], rank[rows], side="right") - 1]
                bin_no, slot = np.divmod(rank[rows] - run[:, 0], run[:, 2])
                sequence[rows], offset[rows] = run[:, 1] + bin_no, run[:, 3] + slot * x
            kept = [batch.column(c) for c in through]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*through, "sequence_id", "offset"])

    subs = max(1, cut.count() // SUB_ROWS)
    spread = cut.drop("ids").withColumn("sub", F.pmod(F.xxhash64("_gl_row"), F.lit(subs)))
    order = [F.col("doc_id"), F.col("piece"), F.col("_gl_row")]
    ranked = gapless_index(spread, "length", "sub", order, "rank").select(*dict.fromkeys([*through, "length"]), "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*through).schema)
    placed = ranked.mapInArrow(giving_back(place), f"{schema}, sequence_id long, offset long")
    return cut.join(placed, "_gl_row").select(*columns, "sequence_id", "offset") if keep_ids else placed


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, doc_ids, ids)``: the sequences of :func:`pack_documents` with ``keep_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    hexed = F.array_join(F.transform("parts", lambda x: F.hex(x["ids"])), "")
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
        .select("sequence_id", "n_tokens", F.col("parts.doc_id").alias("doc_ids"), F.unhex(hexed).alias("ids"))
    )
