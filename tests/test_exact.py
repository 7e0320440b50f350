"""Exactly rounded sums against Python's fractions."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from greenledger.functions import exact, numeric


def nearest(values):
    total = sum((Fraction(v) for v in values), Fraction(0))
    try:
        return float(total)  # correctly rounded
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def sums(spark, groups, places=exact.AMOUNTS, partitions=5):
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double").repartition(partitions)
    got = df.groupBy("k").agg(exact.accumulate("x", places).alias("t")).select("k", exact.rounded("t", places).alias("s"))
    return {r.k: r.s for r in got.collect()}


def groups_of(rng, low, high, n=12):
    def one():
        return rng.choice([-1, 1, 1]) * rng.random() * 10.0 ** rng.uniform(low, high)

    out = {f"g{i}": [one() for _ in range(rng.choice([1, 2, 7, 60]))] for i in range(n)}
    out["cancel"] = [v for x in out["g0"] for v in (x, -x)]
    out["cancel to little"] = [*out["cancel"], 10.0**low]
    return out


def test_amounts_equal_fractions(spark):
    rng = random.Random(1)
    groups = groups_of(rng, -12, 20, 30)
    groups |= {
        "tenths": [0.1] * 10,
        "cents": [1e13, 0.01, 0.02, -1e13],
        "half ulp to even": [float(2**53), 1.0],
        "half ulp and a little": [float(2**53), 1.0, 2.0**-80],
        "half ulp less a little": [float(2**53), 1.0, -(2.0**-80)],
        "odd half ulp": [float(2**53 + 2), 1.0],
        "negative": [-(2.0**53), -1.0, -(2.0**-80)],
        "zero": [0.0, -0.0],
        "ends": [2.0**142, 2.0**-92, -(2.0**142)],
        "big": [2.0**142] * 7 + [1.0],
    }
    assert sums(spark, groups) == {k: nearest(v) for k, v in groups.items()}


def test_every_double_equals_fractions(spark):
    rng = random.Random(2)
    groups = groups_of(rng, -320, 307, 25)
    groups |= {
        "least": [5e-324] * 3,
        "subnormal": [2.0**-1050, -(2.0**-1060), 5e-324],
        "largest": [1.7976931348623157e308, -1.0, 5e-324],
        "wide": [1e308, 1e-308, -1e308],
        "beyond": [1.7976931348623157e308] * 2,
        "minus beyond": [-1.7976931348623157e308] * 2,
        "edge of normal": [2.2250738585072014e-308, -5e-324],
    }
    assert sums(spark, groups, exact.DOUBLES) == {k: nearest(v) for k, v in groups.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=9))
def test_any_finite_doubles(spark, values):
    assert sums(spark, {"k": values}, exact.DOUBLES, 2) == {"k": nearest(values)}


def test_nulls_merging_and_windows(spark):
    rows = [("a", 1, 0.1), ("a", 1, None), ("a", 2, 1e17), ("a", 2, 0.7), ("b", 1, None), ("b", 3, -0.3), ("c", 1, None)]
    df = spark.createDataFrame(rows, "k string, p int, x double")
    parts = df.groupBy("k", "p").agg(exact.accumulate("x").alias("t"))
    got = {r.k: r.s for r in parts.groupBy("k").agg(exact.merge("t").alias("t")).select("k", exact.rounded("t").alias("s")).collect()}
    assert got == {"a": nearest([0.1, 1e17, 0.7]), "b": -0.3, "c": None}
    over = parts.select(exact.merge("t", over="PARTITION BY 1").alias("t")).select(exact.rounded("t").alias("s"))
    assert {r.s for r in over.collect()} == {nearest([0.1, 1e17, 0.7, -0.3])}
    assert df.limit(0).agg(exact.rounded_total("x").alias("s")).first().s is None


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), 2.0**144, 1e-40])
def test_what_amounts_cannot_hold_is_an_error(spark, odd):
    with pytest.raises(Exception, match="not a number that sums of amounts hold|OVERFLOW"):
        spark.createDataFrame([(odd,), (1.0,)], "x double").agg(exact.rounded_total("x")).collect()


def test_weights_of_any_precision(spark):
    rng = random.Random(4)
    rows = [(rng.random() * 10.0 ** rng.randrange(0, 16), round(rng.random(), rng.randrange(7, 18))) for _ in range(500)]
    df = spark.createDataFrame(rows, "x double, share double")
    got = df.agg(numeric.sum_double("x", "share").alias("s")).first().s
    assert got == nearest([x * s for x, s in rows])


def test_rounding_of_large_numbers_changes_nothing(spark):
    row = spark.createDataFrame([(1e25, 2.675, -2.675, 9007199254740993.0)], "a double, b double, c double, d double")
    assert tuple(row.select(*[numeric.round_half_up(c, 2) for c in "abcd"]).first()) == (1e25, 2.68, -2.68, 9007199254740992.0)
