"""Helpers shared by the training-data operators.

Intermediate tables go to the folder that all executors share (``spark.checkpoint.dir``), so a
lost executor recomputes from the last written table and never from another machine's disk.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from greenledger.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read back (schema kept, empty tables too)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return memory that this process has freed, but still holds, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries do so by themselves
    if trim:
        trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` of a ``mapIn...``, whose tasks end by giving back what they have freed.

    Workers outlive their tasks: what an idle one holds is missing to the JVM beside it.
    """

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()

    return run


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a *stored* narrow table of at most ``max_rows`` rows; beyond that a shuffle join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def gapless_index(df: DataFrame, key: str, sub: str, order: list[Column], out: str) -> DataFrame:
    """0-based gapless index within ``key``, without one task per key.

    ``sub`` spreads each key over bounded sub-groups: rows are ranked inside (key, sub), and the
    sub-groups' offsets come from one small count table. ``df`` should be stored: it is read twice.
    """
    before = Window.partitionBy(key).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(key, sub)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, sub, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    rank = F.row_number().over(Window.partitionBy(key, sub).orderBy(*order)) - 1
    return df.join(offsets, [key, sub]).withColumn(out, (F.col("_off") + rank).cast("long")).drop("_off")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges(a, b)``; component = smallest node.

    Alternating large-star and small-star rounds: each round is a grouped minimum (combined before
    the shuffle) and a join, written to the shared folder. Labels only ever shrink, and the loop
    ends when a round changes nothing. Empty edges give an empty table; loops (a = a) are ignored.
    """
    a, b = F.col("a"), F.col("b")
    current = stored(
        edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), f"{name}-edges"
    )
    mark = _signature(current)
    while mark[0]:
        both = current.unionByName(current.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(b > a).join(low, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(low, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        current = stored(rest.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), f"{name}-round")
        now = _signature(current)
        if now == mark:
            break
        mark = now
    roots = current.select(b.alias("node"), b.alias("component")).distinct()
    return current.select(a.alias("node"), b.alias("component")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
