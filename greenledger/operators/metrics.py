"""Row accounting per step: rows in, rows out, rejected, de-duplicated, flagged.

``step_counts`` builds the table as one union of tiny aggregates (a query).
``observe_step`` is the zero-extra-pass form for runs that write tables:
the counts ride along the write as Spark observed metrics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

METRICS = ("input_rows", "output_rows", "rejected_rows", "duplicate_rows", "flagged_rows")


def metric(df: DataFrame, step: str, values: Mapping[str, Column] | None = None) -> DataFrame:
    """One-row frame for ``step`` with the given metric aggregates (default: ``input_rows`` = row count).

    Metrics not given are 0, so rows of the same step can be summed.
    """
    values = values or {"input_rows": F.count(F.lit(1))}
    aggs = [F.coalesce(v, F.lit(0)).cast("bigint").alias(k) for k, v in values.items()]
    out = df.agg(*aggs)
    return out.select(
        F.lit(step).alias("step"),
        *[F.col(m) if m in values else F.lit(0).cast("bigint").alias(m) for m in METRICS],
    )


def rows(name: str) -> dict[str, Column]:
    return {name: F.count(F.lit(1))}


def step_counts(parts: Sequence[DataFrame]) -> DataFrame:
    """Combine metric rows into one row per step."""
    union = reduce(DataFrame.unionByName, parts)
    return union.groupBy("step").agg(*[F.sum(m).cast("bigint").alias(m) for m in METRICS])


def observe_step(df: DataFrame, step: str, flagged: Column | None = None) -> tuple[DataFrame, Observation]:
    """Attach row counts to ``df``; read them with ``obs.get`` after the action that writes it."""
    obs = Observation(step)
    exprs = [F.count(F.lit(1)).alias("rows")]
    if flagged is not None:
        exprs.append(F.count_if(flagged).alias("flagged"))
    return df.observe(obs, *exprs), obs
