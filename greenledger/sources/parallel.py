"""Keep CPU-heavy stages parallel when an input arrives in too few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when it is smaller than one scan split per core.

    Only the optimizer's size estimate is looked at, so no job runs.

    A single huge row group or an unsplittable (gzip) extract is read by one
    task, which then also does all the per-row parsing before the first
    shuffle. Round-robin (not hash) distribution cannot be skewed by a hot key
    or by a block of identical copies; Spark sorts each input partition before
    distributing, so a retried task sends the same rows to the same place.
    ``keys`` only document the grain. Inputs that already have enough splits,
    i.e. any large table on a cluster, are returned unchanged.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = int(df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df if size >= want * split else df.repartition(want)
