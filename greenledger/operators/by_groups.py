"""BY groups: the number of a row in its group, first./last. flags, and the match-merge of two tables.

A window over a group puts the whole group into one task. Here numbers come from two levels: rows are dealt by
ranges of the sort order, so a hot group spreads over neighbouring ranges; windows number the rows of a group within
one range; the counts of earlier ranges, a row per group and range, are added. The ranges are written before they
are read, so a retried task cannot deal rows differently.

Rows are sorted by the BY columns, ``order``, then every other column (ascending, nulls first), so numbers are the same
on every run. Rows equal in all columns are counted before they are sorted and become rows again at the end, in
slices of at most ``SLICE``, so that copies spread as well. Null is a BY value like any other. Columns must be
of types that can be sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.sources.tables import materialize

#: Copies of one row that are numbered together.
SLICE = 100_000
NUMBER, ROWS = "by_number", "by_rows"


def same(left: DataFrame, right: DataFrame, by: Sequence[str]) -> Column:
    """Null-safe equality of the BY columns."""
    cond = F.lit(True)
    for c in by:
        cond = cond & left[c].eqNullSafe(right[f"_{c}"])
    return cond


def renamed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_{c}" for c in by})


def _ranges(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Different rows with their copies, dealt by ranges of the sort order (``_range``), written; and that order."""
    rest = [c for c in df.columns if c not in (*by, *order)]
    sort = [*by, *order, *rest, "_start"]
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_all"))
    sliced = copies.withColumn("_start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_all") - 1, F.lit(SLICE).cast("bigint"))))
    sliced = sliced.withColumn("_n", F.least(F.lit(SLICE), F.col("_all") - F.col("_start"))).drop("_all")
    dealt = sliced.repartitionByRange(*[F.col(c).asc_nulls_first() for c in sort])
    return materialize(dealt.withColumn("_range", F.spark_partition_id()), "by-ranges"), sort


def _groups(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group and range: rows in earlier ranges (``_earlier``) and in the whole group (``by_rows``)."""
    part = ranges.groupBy(*by, "_range").agg(F.sum("_n").alias("_here"))
    group = Window.partitionBy(*by)
    earlier = F.sum("_here").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    return part.select(
        *by, "_range", F.coalesce(earlier, F.lit(0)).alias("_earlier"), F.sum("_here").over(group).alias(ROWS)
    )


def _number(ranges: DataFrame, sort: Sequence[str], by: Sequence[str], groups: DataFrame) -> DataFrame:
    within = Window.partitionBy(*by, "_range").orderBy(*[F.col(c).asc_nulls_first() for c in sort])
    before = F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, -1))
    placed = ranges.withColumn("_before", F.coalesce(before, F.lit(0)))
    right = renamed(groups, [*by, "_range"])
    out = placed.join(right, same(placed, right, [*by, "_range"])).drop(*[f"_{c}" for c in by], "__range")
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))
    numbered = out.withColumn("_copy", copy).withColumn(NUMBER, F.col("_earlier") + F.col("_before") + F.col("_copy"))
    return numbered.drop("_start", "_n", "_range", "_earlier", "_before", "_copy")


def by_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Every row with its number in its BY group (``by_number``, from 1) and the group's size (``by_rows``)."""
    ranges, sort = _ranges(df, by, order)
    return _number(ranges, sort, by, _groups(ranges, by)).select(*df.columns, NUMBER, ROWS)


def by_flags(df: DataFrame, by: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """:func:`by_numbers` and, for each BY column, ``first_<column>`` and ``last_<column>``.

    A column's flag marks the first (last) row of the group made by it and the BY columns before it.
    """
    ranges, sort = _ranges(df, by, order)
    groups = _groups(ranges, by)
    ends = []
    for i in range(1, len(by)):
        head, tail = list(by[:i]), F.struct(*by[i:])
        edge = renamed(groups.groupBy(*head).agg(F.min(tail).alias("_lo"), F.max(tail).alias("_hi")), head)
        lo, hi = f"_at_first_{by[i - 1]}", f"_at_last_{by[i - 1]}"
        joined = groups.join(edge, same(groups, edge, head))
        joined = joined.withColumns({lo: tail.eqNullSafe(F.col("_lo")), hi: tail.eqNullSafe(F.col("_hi"))})
        groups = joined.drop("_lo", "_hi", *[f"_{c}" for c in head])
        ends.append((by[i - 1], F.col(lo), F.col(hi)))
    ends.append((by[-1], F.lit(True), F.lit(True)))
    first, last = F.col(NUMBER) == 1, F.col(NUMBER) == F.col(ROWS)
    flags = [f.alias(n) for c, lo, hi in ends for f, n in ((first & lo, f"first_{c}"), (last & hi, f"last_{c}"))]
    return _number(ranges, sort, by, groups).select(*df.columns, NUMBER, ROWS, *flags)


def merge_by(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_order: Sequence[str] = (), right_order: Sequence[str] = ()
) -> DataFrame:
    """Match-merge: rows of a BY group are paired by number, and the shorter side's last row meets what is left.

    ``in_left`` and ``in_right`` tell whether the group has rows on that side; columns of a side without any are
    null. Columns other than ``by`` need different names on the two sides. Only rows past the shorter side join by
    the group alone, and they meet one row there, so no group is multiplied; a hot group's pairs spread by number.
    """
    clash = (set(left.columns) & set(right.columns)) - set(by)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    l_cols, r_cols = [c for c in left.columns if c not in by], [c for c in right.columns if c not in by]
    # numbered once each: sizes, pairs and leftovers all read these tables
    a = materialize(by_numbers(left, by, left_order), "merge-left")
    b = materialize(by_numbers(right, by, right_order), "merge-right")
    at, end = F.col(NUMBER), F.col(NUMBER) == F.col(ROWS)
    a_last, b_last = renamed(a.where(end).drop(NUMBER), by), renamed(b.where(end).drop(NUMBER), by)
    b_pair = renamed(b, by).withColumnRenamed(NUMBER, "_number").drop(ROWS)
    pairs = a.join(b_pair, same(a, b_pair, by) & (at == F.col("_number")))
    sides = lambda l, r: [l.alias("in_left"), r.alias("in_right")]
    yes = F.lit(True)
    out = pairs.select(*by, at, *l_cols, *r_cols, *sides(yes, yes))
    b_rest, a_rest = b_last.withColumnRenamed(ROWS, "_rows"), a_last.withColumnRenamed(ROWS, "_rows")
    over_a = a.join(b_rest, same(a, b_rest, by), "left").where(at > F.coalesce("_rows", F.lit(0)))
    over_b = b.join(a_rest, same(b, a_rest, by), "left").where(at > F.coalesce("_rows", F.lit(0)))
    matched = F.col("_rows").isNotNull()
    out = out.unionByName(over_a.select(*by, at, *l_cols, *r_cols, *sides(yes, matched)))
    return out.unionByName(over_b.select(*by, at, *l_cols, *r_cols, *sides(matched, yes)))
