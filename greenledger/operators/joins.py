"""Left joins of position-sized data with attribute tables whose keys are unique.

Attributes are never repeated per salt and positions are never hashed whole. Without statistics a join
is a plain one: Spark broadcasts an attribute table that is small by its file statistics, and adaptive
execution splits the partition of a hot or null key (``OptimizeSkewedJoin``, left side of a left join).

With a table of *heavy hitters* (grouped counts of a stored key column, see :func:`heavy_hitters`) the
positions are routed before anything is shuffled:

- null keys match nothing and pass by, without a shuffle;
- hot keys join a broadcast slice of the attributes, at most one row per heavy hitter, without a shuffle;
- cold keys, none of which holds more than its share, shuffle once with the attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A heavy hitter holds at least one in so many rows, so there are no more of them than this.
HEAVY_SHARE = 1024


def heavy_hitters(stored: DataFrame, key: str, share: int = HEAVY_SHARE) -> DataFrame:
    """``(key, rows)`` of the keys with at least one in ``share`` rows of ``stored``, at most ``share`` of them.

    Give a written table: only its key column is read, and combined before the shuffle. Lazy: runs with
    the join that uses it. Null is not a heavy hitter, it never joins.
    """
    counts = stored.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = stored.agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col(key).isNotNull() & (F.col("rows") * F.lit(share) >= total.scalar()))


def join_attributes(positions: DataFrame, attrs: DataFrame, key: str, heavy: DataFrame | None = None) -> DataFrame:
    """Left join on ``key``; every position stays. ``heavy``: the heavy hitters of the positions' key, if known."""
    columns = [key, *[c for c in positions.columns if c != key], *[c for c in attrs.columns if c != key]]
    if heavy is None:
        return positions.join(attrs, key, "left").select(*columns)
    # both are bounded by the number of heavy hitters
    hot_keys = F.broadcast(heavy.select(F.col(key).alias("_hot")))
    hot_attrs = F.broadcast(attrs.join(hot_keys, F.col(key) == F.col("_hot"), "left_semi"))
    routed = positions.join(hot_keys, F.col(key) == F.col("_hot"), "left")
    known = F.col(key).isNotNull()
    hot = routed.where(F.col("_hot").isNotNull()).drop("_hot").join(hot_attrs, key, "left")
    cold = routed.where(F.col("_hot").isNull() & known).drop("_hot").join(attrs, key, "left")
    nothing = [F.lit(None).cast(attrs.schema[c].dataType).alias(c) for c in attrs.columns if c != key]
    none = positions.where(~known).select("*", *nothing)
    return hot.select(*columns).unionByName(cold.select(*columns)).unionByName(none.select(*columns))
