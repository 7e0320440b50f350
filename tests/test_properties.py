"""Property tests: cleaning is total and deterministic, reconciliation of a table with itself is clean."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from greenledger.operators import quality, recon
from greenledger.plans import specs

amounts = st.one_of(st.none(), st.just(""), st.just("  "), st.just("abc"),
                    st.integers(-5, 5).map(str), st.floats(-1e6, 1e6, allow_nan=False).map(repr))
dates = st.sampled_from(["2025-12-31", "2024-12-31", " 2025-12-31 ", "31DEC2025", "", None])
ids = st.sampled_from(["L1", "L2", "L3", " L1", None])
loan_rows = st.lists(st.tuples(ids, st.just("I1"), dates, amounts, st.just("EUR"), st.just("p")), max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=loan_rows)
def test_loan_cleaning_is_total(spark, rows):
    spec = specs.LOANS
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in spec.columns))
    good, ledger = quality.clean_table(raw, spec)
    kept = good.collect()
    entries = ledger.collect()
    assert len(kept) + sum(r["rejected_rows"] for r in entries) == len(rows)
    assert len({(r["loan_id"], r["as_of_date"]) for r in kept}) == len(kept)  # one row per key
    assert all(r["outstanding_amount"] is not None and r["outstanding_amount"] >= 0 for r in kept)
    counts = quality.clean_counts(quality.typed_frame(raw, spec), spec).first()
    assert counts["input_rows"] == len(rows)
    assert counts["output_rows"] == len(kept)
    assert counts["rejected_rows"] + counts["duplicate_rows"] == sum(r["rejected_rows"] for r in entries)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.floats(-1e9, 1e9))),
                     max_size=12, unique_by=lambda r: r[0]))
def test_recon_of_a_table_with_itself_is_clean(spark, rows):
    spec = specs.ReconSpec("RX", ("k",), ("v",), 0.5, 0.001)
    df = spark.createDataFrame(rows, "k string, v double")
    assert recon.reconcile(df, df, spec).count() == 0
