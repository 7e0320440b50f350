"""One routed pass per source: same clean rows, ledger and counts as the lazy contract, typed once, unique rows unsorted."""

import random

import pytest
from pyspark.sql import functions as F

from greenledger.operators.metrics import step_counts
from greenledger.operators.quality import CleanSpec, clean_rows, ledger_rows, typed_frame
from greenledger.operators.routing import route, route_all
from greenledger.plans.specs import SOURCES
from tests.test_plans import plan_of

SPEC = CleanSpec(
    name="positions",
    columns=("k", "day", "amount", "line"),
    key=("k", "day"),
    doubles=("amount",),
    ints=("line",),
    iso_dates=("day",),
    rules=(("negative", lambda: F.col("amount") < 0),),
    order=(("amount", False),),
)


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def same_as_lazy(raw, spec):
    routed, typed = route(raw, spec), typed_frame(raw, spec)
    assert sorted(routed.clean().columns) == sorted(clean_rows(typed, spec).columns)
    assert rows_of(routed.clean()) == rows_of(clean_rows(typed, spec))
    assert rows_of(routed.ledger()) == rows_of(ledger_rows(typed, spec))
    (counts,) = [r.asDict() for r in step_counts(routed.counts("s")).collect()]
    assert counts["input_rows"] == raw.count() == counts["output_rows"] + counts["rejected_rows"] + counts["duplicate_rows"]
    assert counts["output_rows"] == routed.clean().count()
    return routed


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, "k string, day string, amount string, line string")


@pytest.mark.parametrize("spec", SOURCES, ids=lambda s: s.name)
def test_every_source_of_the_book_routes_as_the_lazy_contract(fixture_extracts, spec):
    same_as_lazy(fixture_extracts[spec.name], spec)


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_with_a_hot_key(spark, seed):
    """Brute force in plain Python: nulls, blanks, ties, equal rows, NaN, a third of rows on one key."""
    rng = random.Random(seed)
    days, amounts = ["2024-06-30", "2024-12-31", "no day", None], ["1", "2.5", "-3", "NaN", "x", None, " 2.5 "]
    rows = [
        ("hot" if i % 3 == 0 else rng.choice(["a|", "a", " a ", "", None, f"k{i}"]), rng.choice(days[: 2 + (i % 7 == 0) * 2]),
         rng.choice(amounts), str(rng.randrange(3)))
        for i in range(600)
    ]
    routed = same_as_lazy(raw_rows(spark, rows), SPEC)

    def number(x):
        try:
            return None if x is None else float(x)
        except ValueError:
            return None

    want = {}
    for k, day, amount, line in rows:
        k, amount = None if k is None else k.strip(), number(amount)
        if day in (None, "no day") or not k or amount != amount or (amount is not None and amount < 0):
            continue
        # descending amounts, null first, then all columns ascending (null first)
        rank = (amount is not None, -(amount or 0), int(line))
        want.setdefault((k, day), []).append((rank, amount, int(line)))
    got = {(r.k, str(r.day)): (r.amount, r.line) for r in routed.clean().collect()}
    assert got == {key: min(v)[1:] for key, v in want.items()}
    dropped = {r.business_key: r.rejected_rows for r in routed.ledger().where("reject_reason = 'duplicate_key'").collect()}
    assert dropped == {f"{k.replace('|', chr(92) + '|')}|{d}": len(v) - 1 for (k, d), v in want.items() if len(v) > 1}


def test_empty_extract_and_source_without_dedupe(spark):
    routed = same_as_lazy(raw_rows(spark, []), SPEC)
    assert routed.clean().count() == 0 and routed.ledger().count() == 0
    plain = CleanSpec(name="plain", columns=SPEC.columns, doubles=("amount",), dedupe=False)
    routed = same_as_lazy(raw_rows(spark, [("a", "d", "1", "1"), ("a", "d", "1", "1"), ("b", None, "NaN", None)]), plain)
    assert routed.duplicated is None and routed.clean().count() == 2


def test_only_rejects(spark):
    routed = same_as_lazy(raw_rows(spark, [("a", "2024-06-30", "-1", "1")] * 3), SPEC)
    assert routed.clean().count() == 0 and routed.ledger().count() == 3


def test_clean_rows_meet_no_sort_and_no_shuffle_where_duplicates_are_few(spark):
    rows = [(f"k{i}", "2024-06-30", "1", "1") for i in range(300)] + [("k1", "2024-06-30", "2", "1")]
    routed = route(raw_rows(spark, rows), SPEC)
    plan = plan_of(routed.clean())
    assert "SortAggregate" not in plan and "Sort [" not in plan and "hashpartitioning" not in plan
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert plan_of(routed.ledger()).count("hashpartitioning") == 0


def test_a_source_is_read_once(spark):
    """The written tables are all that clean rows, ledger and counts read."""
    seen = spark.sparkContext.accumulator(0)

    raw = raw_rows(spark, [("a", "2024-06-30", "1", "1"), ("a", "2024-06-30", "2", "1"), ("b", "x", "1", "1")])
    counted = spark.createDataFrame(raw.rdd.map(lambda r: (seen.add(1), r)[1]), raw.schema)
    routed = route_all({"positions": counted}, {"positions": SPEC})["positions"]
    for df in (routed.clean(), routed.ledger(), step_counts(routed.counts("s"))):
        df.collect()
    assert seen.value == 3


def test_unsorted_survivor_choice_over_shuffled_keys(spark):
    """Where nothing may be broadcast, the join on key hashes gives the same rows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(f"k{i % 40}", "2024-06-30", str(i), "1") for i in range(60)]
        same_as_lazy(raw_rows(spark, rows), SPEC)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
