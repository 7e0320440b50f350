"""Sharding by longest-processing-time scheduling over groups that stay together.

Groups (equal texts) go, largest first, to the least-loaded shard. LPT only looks at sizes, so groups
of one size class are interchangeable: Spark counts the classes, the driver deals the classes out
through a heap (classes are bounded by construction, see :func:`size_class`), and Spark ranks the
groups within their class and looks each rank up in the class's cuts. Neither documents nor groups
pass through the driver or one task.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from greenledger.llm.common import gapless_index, stored

#: Leading bits of a group's bytes that make its class: exact below 2**BITS, within 2**(1 - BITS) above.
#: At most 2**BITS + 2**(BITS - 1) * (63 - BITS) classes exist, about 110,000.
BITS = 12
#: Rows, about, that share one (key, sub) group when indices are made.
SUB_ROWS = 50_000


def size_class(size: Column) -> Column:
    """``size`` with all but its leading BITS bits cleared."""
    low = F.greatest(F.lit(0), F.length(F.bin(size)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", size, low), low)


def deal(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """LPT over ``(class, count, bytes)``: per class, how many of its groups shards 0..i hold together.

    Equal items are dealt by water level; what the level leaves over goes through the heap one by one.
    """
    load = [0.0] * shards
    out = []
    for cls, count, size in sorted(classes, reverse=True):
        each = size / count
        given = [0] * shards
        if count > shards:
            low, high = 0.0, max(load) + size
            for _ in range(100):
                level = (low + high) / 2
                if sum(max(0, int((level - x) // each)) for x in load) <= count:
                    low = level
                else:
                    high = level
            given = [max(0, int((low - x) // each)) for x in load]
        heap = [(x + n * each, i) for i, (x, n) in enumerate(zip(load, given, strict=True))]
        heapq.heapify(heap)
        for _ in range(count - sum(given)):
            x, i = heap[0]
            given[i] += 1
            heapq.heapreplace(heap, (x + each, i))
        total, cuts = 0, []
        for i, n in enumerate(given):
            load[i] += n * each
            total += n
            cuts.append(total)
        out.append((cls, cuts))
    return out


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """``(doc_id, size, text_crc32, group_key, shard, slot)``: one row per row of ``docs``.

    Size is the text's UTF-8 bytes plus 1. Equal texts share a shard; null texts form one group of
    their own, apart from empty texts. ``slot`` numbers a shard's rows from 0 without gaps. Repeated
    rows and null ids are rows like any others; other columns of ``docs`` are ignored.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32)), F.lit(b"")).alias("group_key"),
    )
    # Rows are numbered as written, so that rows of one id, or equal rows, can be told apart and spread.
    rows = stored(rows.withColumn("_gl_row", F.monotonically_increasing_id()), "shard-rows")
    sized = rows.groupBy("group_key").agg(F.sum("size").alias("bytes"))
    n_rows = rows.count()
    subs = max(1, n_rows // SUB_ROWS)
    groups = stored(
        sized.select(
            "group_key",
            "bytes",
            size_class(F.col("bytes")).alias("cls"),
            F.pmod(F.xxhash64("group_key"), F.lit(subs)).alias("sub"),
        ),
        "shard-groups",
    )
    classes = groups.groupBy("cls").agg(F.count(F.lit(1)), F.sum("bytes")).collect()  # bounded: see BITS
    schema = StructType([StructField("cls", LongType()), StructField("cuts", ArrayType(LongType()))])
    plan = rows.sparkSession.createDataFrame(deal([tuple(x) for x in classes], shards), schema)
    ranked = gapless_index(groups, "cls", "sub", [F.col("group_key")], "rank")
    placed = ranked.join(F.broadcast(plan), "cls").select(
        "group_key", F.expr("size(filter(cuts, x -> x <= rank))").alias("shard")
    )
    assigned = stored(
        rows.join(placed, "group_key").withColumn("sub", F.pmod(F.xxhash64("_gl_row"), F.lit(subs))), "shard-assigned"
    )
    order = [F.col("doc_id"), F.col("group_key"), F.col("_gl_row")]
    return gapless_index(assigned, "shard", "sub", order, "slot").drop("sub", "_gl_row")


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` as parquet, one folder ``shard=<n>`` per shard, rows in slot order within each file.

    ``placed`` is the result of :func:`shard_documents`; ids must be unique and not null.
    """
    where = placed.select(F.col("doc_id").alias("_id"), "shard", "slot")
    out = docs.join(where, docs[id_col] == F.col("_id")).drop("_id")
    files = F.floor(F.col("slot") / SUB_ROWS)
    out.repartition("shard", files).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
