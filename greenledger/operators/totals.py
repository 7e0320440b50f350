"""Grouped totals that are exact whatever the order of rows: terms formed once, summed as limbs, rounded once.

Each step is a projection or an aggregate of its own, so that a term or a total is computed once however
often the next step names it (Catalyst does not merge projections where that would repeat work).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from greenledger.functions.exact import accumulate, merge, rounded


def accumulated(df: DataFrame, keys: Sequence[str], terms: Mapping[str, Column], *others: Column) -> DataFrame:
    """``keys``, the accumulator of every term under its name, and ``others`` (further aggregates of ``df``)."""
    hidden = {f"_term_{name}": term.cast("double") for name, term in terms.items()}
    sums = [accumulate(f"_term_{name}").alias(name) for name in terms]
    return df.withColumns(hidden).groupBy(*keys).agg(*sums, *others)


def merged(parts: DataFrame, keys: Sequence[str], names: Sequence[str], *others: Column) -> DataFrame:
    """Accumulators rolled up to coarser ``keys``; what they hold stays exact."""
    return parts.groupBy(*keys).agg(*[merge(n).alias(n) for n in names], *others)


def as_doubles(frame: DataFrame, *names: str) -> DataFrame:
    """``frame`` with the named accumulators replaced by the doubles nearest to them."""
    return frame.withColumns({n: rounded(n) for n in names})


def totals(df: DataFrame, keys: Sequence[str], terms: Mapping[str, Column], *others: Column) -> DataFrame:
    """As :func:`accumulated`, rounded to doubles; a total without a value is null."""
    return as_doubles(accumulated(df, keys, terms, *others), *terms)
