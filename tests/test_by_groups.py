"""BY groups against plain Python: numbers, first./last., match-merge, copies, nulls, a hot group."""

import random
from collections import defaultdict
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from greenledger.operators import by_groups
from greenledger.operators.by_groups import by_flags, by_numbers, merge_by

SCHEMA = "a string, b int, v double, w string"


def low(x):
    """Sort key of a value: null first."""
    return (x is not None, 0 if x is None else x)


def some_rows(seed, n=240):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    rows = [(pick("p", "q", None), pick(1, 2, None), pick(1.5, -2.0, None), pick("x", "y")) for _ in range(n)]
    return rows + [("hot", 1, float(i), "z") for i in range(n // 2)] + [("p", 1, 1.5, "x")] * 40


@pytest.mark.parametrize("slice_rows", [7, 100_000])
def test_numbers_and_flags_of_two_by_columns(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(by_groups, "SLICE", slice_rows)  # copies of a row in several slices
    rows = some_rows(1)
    want = []
    ordered = sorted(rows, key=lambda r: tuple(low(r[i]) for i in (0, 1, 3, 2)))
    for _, head in groupby(ordered, key=lambda r: r[0]):
        head = list(head)
        at = 0
        for _, group in groupby(head, key=lambda r: r[1]):
            group = list(group)
            for i, r in enumerate(group):
                at += 1
                want.append((*r, i + 1, len(group), at == 1, at == len(head), i == 0, i + 1 == len(group)))
    got = by_flags(spark.createDataFrame(rows, SCHEMA).repartition(3), ("a", "b"), ("w",))
    assert got.columns[4:] == ["by_number", "by_rows", "first_a", "last_a", "first_b", "last_b"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_empty_table_has_numbers_and_flags(spark):
    out = by_flags(spark.createDataFrame([], SCHEMA), ("a",))
    assert out.count() == 0 and out.columns == ["a", "b", "v", "w", "by_number", "by_rows", "first_a", "last_a"]


def test_a_hot_group_is_dealt_over_many_tasks(spark):
    """A third of the rows in one group, another third copies of one row: no range holds much more than its share."""
    n = 6000
    case = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN 'copy' ELSE concat('k', id) END"
    df = spark.range(n).selectExpr(f"{case} AS a", "CASE WHEN id % 3 = 1 THEN -1 ELSE id END AS v")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges, sort = by_groups._ranges(df, ("a",), ("v",))
        dealt = ranges.groupBy("a", "_range").agg(F.sum("_n").alias("n"))
        biggest = dealt.where("a <> 'copy'").agg(F.max("n")).first()[0]
        assert biggest <= 1000 and dealt.where("a = 'hot'").count() >= 3  # of 2,000 rows
        assert ranges.where("a = 'copy'").count() == 1  # 2,000 copies are sorted as one row
        out = by_numbers(df, ("a",), ("v",))
        numbers = [r.v for r in out.where("a = 'hot'").orderBy("by_number").select("v").collect()]
        assert numbers == sorted(numbers) and len(numbers) == n // 3
        assert out.where("a = 'copy'").select("by_number").distinct().count() == n // 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_match_merge(spark):
    """Groups on one side only, of unequal sizes either way, with a null BY value; the last row is kept on."""
    left = [("p", 1), ("p", 2), ("p", 3), ("q", 1), ("l", 5), ("l", 6), (None, 7), ("one", 1), ("s", 1), ("s", 1)]
    right = [("p", "a"), ("q", "b"), ("q", "c"), ("q", "c"), ("r", "d"), (None, "e"), (None, "f"), ("s", "g"), ("s", "h")]
    right += [("one", f"m{i:03}") for i in range(150)]
    sides = defaultdict(lambda: ([], []))
    for i, rows in enumerate((left, right)):
        for k, v in rows:
            sides[k][i].append(v)
    want = []
    for k, (xs, ys) in sides.items():
        xs, ys = sorted(xs), sorted(ys)
        at = lambda rows, i: rows[min(i, len(rows) - 1)] if rows else None
        want += [(k, i + 1, at(xs, i), at(ys, i), bool(xs), bool(ys)) for i in range(max(len(xs), len(ys)))]
    a, b = spark.createDataFrame(left, "k string, x int"), spark.createDataFrame(right, "k string, y string")
    got = merge_by(a, b, ("k",), ("x",), ("y",))
    assert got.columns == ["k", "by_number", "x", "y", "in_left", "in_right"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    with pytest.raises(ValueError, match="both sides"):
        merge_by(a, a, ("k",))
    nothing = merge_by(a.limit(0), b.limit(0), ("k",))
    assert nothing.count() == 0
