"""Reconciliation by digests of key buckets finds the same breaks and leaves equal buckets out."""

import random

import pytest

from greenledger.operators.recon import differing, recon_summary, reconcile
from greenledger.plans.specs import ReconSpec

SPEC = ReconSpec("T", ("a", "b"), ("x", "y"), 0.5, 0.001)
SCHEMA = "a string, b string, x double, y string"


def breaks(new, base):
    return sorted(map(repr, reconcile(new, base, SPEC).collect()))


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_same_breaks_as_the_whole_join(spark, buckets):
    rng = random.Random(buckets)
    new = {(f"k{i}", rng.choice("uv")): (float(i), rng.choice(["t", "", None, "2.5"])) for i in range(200)}
    base = [(*k, *v) for k, v in new.items() if k[0] != "k7"]
    base[3] = (*base[3][:2], base[3][2] + 0.1, base[3][3])  # within the tolerance
    base[5] = (*base[5][:2], base[5][2] + 100, base[5][3])
    base += [base[9], ("only", "here", 1.0, "t"), (None, "z", 1.0, "t"), ("nan", "n", float("nan"), "t")]
    rows = [(*k, *v) for k, v in new.items()] + [(None, "z", 1.0, "t"), ("", "z", 1.0, "t"), ("nan", "n", float("nan"), "t")]
    n, b = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(base, SCHEMA)
    some_n, some_b, rest = differing(n, b, SPEC, buckets)
    want = breaks(n, b)
    assert len(want) >= 6 and breaks(some_n, some_b) == want
    equal = rest.first().n
    assert equal == len(rows) - some_n.count() == len(base) - some_b.count()
    assert equal == 0 if buckets == 1 else equal > 100 if buckets == 4096 else True
    if buckets == 4096:
        whole, skipped = (recon_summary({"T": (n, b)}, {"T": SPEC}, skip_equal=s).collect() for s in (False, True))
        assert [r.asDict() for r in whole] == [r.asDict() for r in skipped]


def test_equal_and_empty_tables(spark):
    rows = spark.createDataFrame([("p", "q", 1.0, None), ("r", "s", None, "t")], SCHEMA)
    some_n, some_b, rest = differing(rows, rows, SPEC)
    assert some_n.count() == some_b.count() == 0 and rest.first().n == 2
    some_n, some_b, rest = differing(rows.limit(0), rows, SPEC)
    assert some_n.count() == 0 and some_b.count() == 2 and rest.first().n == 0
    none = recon_summary({"T": (rows.limit(0), rows.limit(0))}, {"T": SPEC}, skip_equal=True).first()
    assert (none.status, none.rows_new, none.rows_base) == ("PASS", 0, 0)
