"""Unit tests of the column functions and operators on tiny frames."""

import functools
import math
import operator

import pytest
from pyspark.sql import functions as F

from greenledger.functions import cleaning, numeric, pcaf
from greenledger.operators import quality, recon
from greenledger.plans import specs


def test_date9_and_iso_parse(spark):
    df = spark.createDataFrame([("31dec2025",), ("31DEC2024",), ("2025-12-31",), (None,)], "d string")
    got = [r[0] for r in df.select(cleaning.parse_date9("d")).collect()]
    assert [str(x) if x else None for x in got] == ["2025-12-31", "2024-12-31", None, None]
    got = [r[0] for r in df.select(cleaning.parse_iso_date("d")).collect()]
    assert [str(x) if x else None for x in got] == [None, None, "2025-12-31", None]


def test_blank_to_null_and_casts(spark):
    df = spark.createDataFrame([("  ", " 2.5 ", "x"), ("a", "", "7")], "s string, d string, i string")
    rows = df.select(cleaning.blank_to_null("s"), cleaning.to_double(F.trim("d")), cleaning.to_int("i")).collect()
    assert rows[0][0] is None and rows[0][1] == 2.5 and rows[0][2] is None
    assert rows[1][0] == "a" and rows[1][1] is None and rows[1][2] == 7


def test_round_half_up_in_decimal_domain(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-0.125,), (None,)], "x double")
    got = [r[0] for r in df.select(numeric.round_half_up("x", 2)).collect()]
    assert got == [1.01, 2.68, -0.13, None]


def test_exact_sum_is_order_independent(spark):
    values = [9e11] + [0.1] * 10 + [-9e11]
    assert functools.reduce(operator.add, values) != 1.0  # a plain double sum in this order drifts
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    assert df.agg(numeric.sum_double("x")).first()[0] == 1.0


def test_exact_sum_domain(spark):
    total = lambda values: spark.createDataFrame([(v,) for v in values], "x double").agg(numeric.sum_double("x")).first()[0]
    for values in ([1.5e13] * 4, [4e-7] * 5, [1e19, 1e-9, -1e19], [1e30, 1.0]):
        assert total(values) == math.fsum(values)
    with pytest.raises(Exception):  # beyond 1e43 in a row: fails loudly (ANSI) instead of rounding
        total([1e45])


PCAF_ROWS = [
    # status, source, s1, s2, s3 -> score
    ("mapped", "verified", 1.0, 1.0, 1.0, 1),
    ("mapped", "verified", 1.0, 1.0, None, 5),
    ("mapped", "reported", 1.0, 1.0, 1.0, 2),
    ("mapped", "reported", 1.0, 1.0, None, 3),
    ("mapped", "estimated", None, None, None, 4),
    ("unmapped_issuer", "verified", 1.0, 1.0, 1.0, 5),
    (None, "estimated", 1.0, 1.0, 1.0, 4),
    (None, None, None, None, None, 5),
]


def test_pcaf_score_rules(spark):
    df = spark.createDataFrame(
        [r[:5] for r in PCAF_ROWS],
        "coverage_status string, emission_data_source string, scope1_tco2e double, scope2_tco2e double, scope3_tco2e double",
    )
    assert [r[0] for r in df.select(pcaf.pcaf_score()).collect()] == [r[5] for r in PCAF_ROWS]
    em = [r[0] for r in df.select(pcaf.issuer_emissions()).collect()]
    assert em[1] == 2.0 and em[5] is None and em[6] is None


def test_attribution_factor_and_gap_cause(spark):
    df = spark.createDataFrame(
        [
            ("listed_equity", 10.0, 100.0, 1000.0),
            ("corporate_bond", 10.0, 0.0, 1000.0),
            ("business_loan", 10.0, 0.0, 1000.0),
            ("business_loan", 10.0, 5.0, None),
        ],
        "asset_class string, exposure_eur double, evic_eur double, total_assets_eur double",
    )
    assert [r[0] for r in df.select(pcaf.attribution_factor()).collect()] == [0.1, None, 0.01, None]
    g = spark.createDataFrame(
        [("unmapped_issuer", 0.1, None), ("orphan_provider", 0.1, None), ("mapped", None, None),
         (None, 0.1, None), ("mapped", 0.1, 5.0)],
        "coverage_status string, attribution_factor double, financed_emissions_tco2e double",
    )
    assert [r[0] for r in g.select(pcaf.gap_cause()).collect()] == [
        "unmapped_issuer", "orphan_provider", "zero_or_missing_denominator", "missing_esg_data", "mapped"]


def test_dedupe_is_deterministic_and_handles_a_hot_key(spark):
    # One key holds most rows, spread over many partitions; survivor = highest value, then lowest tie-breaker.
    rows = [("hot", float(i % 50), i) for i in range(5000)] + [("cold", 1.0, 1), ("cold", 1.0, 1)]
    df = spark.createDataFrame(rows, "k string, v double, t int").repartition(16)
    kept, dropped = quality.dedupe_keep_one(df, ["k"], [("v", False), ("t", True)], "x")
    got = {r["k"]: (r["v"], r["t"]) for r in kept.collect()}
    assert got == {"hot": (49.0, 49), "cold": (1.0, 1)}
    assert {r["business_key"]: r["rejected_rows"] for r in dropped.collect()} == {"hot": 4999, "cold": 1}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side combine before the shuffle


def test_split_is_total(spark):
    spec = specs.LOANS
    raw = spark.createDataFrame(
        [("L1", "I1", "2025-12-31", "10", "EUR", "p"), ("L2", "I1", "2025-12-31", "-1", "EUR", "p"),
         ("L3", "I1", "2025-12-31", None, "EUR", "p"), ("L4", "I1", "31/12/2025", "5", "EUR", "p"),
         (None, "I1", "2025-12-31", "5", "EUR", "p"), ("L1", "I1", "2025-12-31", "10", "EUR", "p")],
        ", ".join(f"{c} string" for c in spec.columns),
    )
    good, ledger = quality.clean_table(raw, spec)
    reasons = sorted((r["reject_reason"], r["rejected_rows"]) for r in ledger.collect())
    assert reasons == [("duplicate_key", 1), ("missing_key", 1), ("missing_outstanding_amount", 1),
                       ("negative_outstanding_amount", 1), ("unparseable_date", 1)]
    assert good.count() + sum(n for _, n in reasons) == raw.count()


@pytest.mark.parametrize(
    "new,old,ok",
    [(100.0, 100.4, True), (100.0, 100.6, False), (10000.0, 10009.0, True), (10000.0, 10011.0, False),
     (None, None, True), (None, 1.0, False), (1.0, None, False)],
)
def test_recon_tolerance(spark, new, old, ok):
    spec = specs.ReconSpec("RX", ("k",), ("v",), 0.5, 0.001)
    a = spark.createDataFrame([("a", new)], "k string, v double")
    b = spark.createDataFrame([("a", old)], "k string, v double")
    assert (recon.reconcile(a, b, spec).count() == 0) == ok


def test_recon_missing_and_duplicate_keys(spark):
    spec = specs.ReconSpec("RX", ("k",), ("v",), 0.5, 0.001)
    a = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("d", 1.0), ("d", 1.0)], "k string, v double")
    b = spark.createDataFrame([("a", 1.0), ("c", 1.0), ("d", 1.0)], "k string, v double")
    got = {r["key_text"]: r["break_type"] for r in recon.reconcile(a, b, spec).collect()}
    assert got == {"b": "missing_in_baseline", "c": "missing_in_new", "d": "duplicate_key"}


def test_recon_nan_text_and_every_differing_column(spark):
    spec = specs.ReconSpec("RX", ("k",), ("v", "w"), 0.5, 0.001)
    nan = float("nan")
    a = spark.createDataFrame([("a", nan, "x"), ("b", 5.0, "x"), ("c", 1.0, "n/a"), ("d", 1.0, ""), ("e", 9.0, "x")], "k string, v double, w string")
    b = spark.createDataFrame([("a", nan, "x"), ("b", nan, "y"), ("c", 1.2, "n/a"), ("d", 1.0, None), ("e", 1.0, "7")], "k string, v double, w string")
    rows = recon.reconcile(a, b, spec).collect()
    assert sorted((r["key_text"], r["column_name"]) for r in rows) == [
        ("a", "v"), ("b", "v"), ("b", "w"), ("e", "v"), ("e", "w")]
    texts = {(r["key_text"], r["column_name"]): (r["new_text"], r["old_text"], r["old_value"]) for r in rows}
    assert texts["b", "w"] == ("x", "y", None) and texts["e", "w"] == ("x", None, 7.0)
    top = recon.top_breaks([recon.compared(a, b, spec)], 2).collect()
    assert sorted((r["key_text"], r["break_rank"]) for r in top) == [("a", 1), ("b", 2), ("b", 2)]


def test_blank_keys_and_non_finite_amounts_are_rejected(spark):
    spec = specs.LOANS
    raw = spark.createDataFrame(
        [("  ", "I", "2025-12-31", "1", "EUR", "p"), ("", "I", "2025-12-31", "2", "EUR", "p"),
         ("A", "I", "2025-12-31", "NaN", "EUR", "p"), ("B", "I", "2025-12-31", "-Infinity", "EUR", "p"),
         ("C", "I", "2025-12-31", "3", "EUR", "p"), ("C", "I", "2024-12-31", "4", "EUR", "p")],
        ", ".join(f"{c} string" for c in spec.columns),
    )
    good, ledger = quality.clean_table(raw, spec)
    assert sorted(r["outstanding_amount"] for r in good.collect()) == [3.0, 4.0]
    assert sorted((r["reject_reason"], r["business_key"]) for r in ledger.collect()) == [
        ("missing_key", "|2025-12-31"), ("missing_key", "|2025-12-31"),
        ("non_finite_number", "A|2025-12-31"), ("non_finite_number", "B|2025-12-31")]


def test_different_keys_have_different_texts(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a\\", "|b|c"), ("a\\|", "b|c"), ("x", None)]
    got = [r[0] for r in spark.createDataFrame(rows, "k string, l string").select(quality.business_key(("k", "l"))).collect()]
    assert len(set(got)) == len(rows) and got[-1] == "x|"


def test_ledger_details_keep_their_types(spark):
    df = spark.createDataFrame([("n", 2.5, 7, None)], "k string, amount double, year int, lei string")
    row = df.select(quality.row_json(df.columns).alias("details"))
    got = row.select(
        quality.detail("amount", "double").alias("a"), quality.detail("year", "int").alias("y"),
        quality.detail("lei", "string").alias("l"), quality.detail("nothing", "date").alias("n"), quality.detail("k", "int").alias("k"),
    ).first()
    assert tuple(got) == (2.5, 7, None, None, None)
