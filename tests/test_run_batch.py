"""The layer-by-layer batch run writes every table once and reproduces the report numbers."""

import tempfile

from greenledger.plans.run import run_batch
from greenledger.sources.tables import TableStore
from tests import book_fixture as fx
from tests.conftest import FIXTURE_AS_OF, FIXTURE_LOAN_PORTFOLIO, rows_by


def test_run_batch_writes_layers(spark, fixture_extracts):
    base = tempfile.mkdtemp(prefix="greenledger-run-")
    store = TableStore(f"{base}/tables")
    metrics = run_batch(
        spark, fixture_extracts, store, FIXTURE_AS_OF, FIXTURE_LOAN_PORTFOLIO, report_csv_dir=f"{base}/csv"
    )
    counts = {r["step"]: r["output_rows"] for r in metrics.collect()}
    assert counts["bronze.holdings"] == len(fx.rows("holdings"))
    assert counts["silver.holdings"] == len(fx.rows("holdings")) - 4  # three rejected, one duplicate
    assert counts["silver._rejects"] == len(fx.LEDGER) - 1 and counts["restricted._rejects"] == 1
    assert counts["gold.financed_emissions"] == counts["gold.coverage"] == len(fx.positions())
    want = fx.expected()
    assert all(counts[f"report.{rid}"] == len(want[rid]) for rid in want)
    r01 = rows_by(store.read(spark, "gold", "r01"), "portfolio_id", "issuer_id")
    assert r01[("ALPHA", "N1")]["financed_emissions_tco2e"] == want["R01"]["ALPHA", "N1"]["financed_emissions_tco2e"]
    # a duplicate vendor row is the vendor's data: nothing of it in the open tables
    opened = store.read(spark, "silver", "_rejects").collect()
    assert not any(r["source_table"] == "vendor_emissions" or "scope1" in r["details"] for r in opened)
    assert {r["source_table"] for r in store.read(spark, "restricted", "_rejects").collect()} == {"vendor_emissions"}
    assert "scope1_tco2e" not in store.read(spark, "gold", "coverage").columns
    assert "restricted" in store.path("restricted", "vendor_emissions")
    open_cols = store.read(spark, "gold", "financed_emissions").columns
    assert "scope1_tco2e" not in open_cols and "esg_rating" not in open_cols
    assert "financed_emissions_tco2e" in open_cols and "pcaf_score" in open_cols
    assert "scope1_tco2e" in store.read(spark, "restricted", "financed_emissions_full").columns
    # a second run reconciles against the first as baseline: everything matches
    store2 = TableStore(f"{base}/tables2")
    run_batch(spark, fixture_extracts, store2, FIXTURE_AS_OF, FIXTURE_LOAN_PORTFOLIO, baselines=store)
    summary = store2.read(spark, "gold", "recon_summary").collect()
    assert len(summary) == 9 and all(r["status"] == "PASS" for r in summary)


def test_missing_baseline_is_a_fail(spark, fixture_extracts):
    base = tempfile.mkdtemp(prefix="greenledger-run-")
    empty_baselines = TableStore(f"{base}/nothing-here")
    store = TableStore(f"{base}/tables")
    run_batch(spark, fixture_extracts, store, FIXTURE_AS_OF, FIXTURE_LOAN_PORTFOLIO, baselines=empty_baselines)
    summary = {r["report_id"]: r for r in store.read(spark, "gold", "recon_summary").collect()}
    assert len(summary) == 9 and all(r["status"] == "FAIL" for r in summary.values())
    assert summary["R01"]["rows_new"] == len(fx.expected()["R01"]) and summary["R02"]["unexpected_fail"]
