"""Our own small book, from CSV extracts to reports, against the plain-Python model."""

import pytest
from pyspark.sql import functions as F

from greenledger.functions import pcaf
from tests import book_fixture as fx
from tests.conftest import rows_by


def test_bronze_audit_columns(fixture_extracts):
    row = fixture_extracts["holdings"].where("instrument_id = 'Q1'").first()
    assert (row["_source_file"], row["_batch_id"]) == ("holdings.csv", f"batch-{fx.AS_OF}")
    assert row["_ingested_at"] is not None


def test_a_short_line_does_not_stop_the_load(fixture_extracts, book):
    holdings = fixture_extracts["holdings"]
    assert holdings.count() == len(holdings.collect()) == len(fx.rows("holdings"))
    assert [r["instrument_id"] for r in holdings.where("_malformed_line IS NOT NULL").collect()] == ["Q3"]
    assert "_malformed_line" not in book.silver("holdings").columns


def test_cleaning_trims_types_and_flags(book):
    assert rows_by(book.silver("instruments"), "instrument_id")[("Q1",)]["isin"] == "ZZ00Q1"
    issuers = rows_by(book.silver("issuers"), "issuer_id")
    assert {k[0]: r["lei_missing_flag"] for k, r in issuers.items() if r["lei_missing_flag"]} == {"N3": 1, "N5": 1}
    assert rows_by(book.silver("portfolios"), "portfolio_id")[("ALPHA",)]["legal_entity"] == "Harbor Fund"
    assert rows_by(book.silver("vendor_emissions"), "provider_entity_id", "fiscal_year")[("V3", 2024)]["esg_rating"] is None
    assert {r["currency"] for r in book.silver("fx_rates").collect()} == {"EUR", "CHF", "usd"}
    loans = rows_by(book.silver("loans"), "loan_id", "as_of_date")
    assert sorted((k[0], str(k[1])) for k in loans if k[0] == "K1") == [("K1", "2023-06-30"), ("K1", "2024-06-30")]


def test_reject_ledger(book):
    ledger = book.reject_ledger.collect()
    got = sorted((r["source_table"], r["reject_reason"], r["business_key"], r["rejected_rows"]) for r in ledger)
    assert got == fx.LEDGER
    detail = next(r["details"] for r in ledger if r["reject_reason"] == "missing_market_value")
    assert '"market_value":null' in detail


def test_entity_map(book):
    status = {r["issuer_id"]: r["coverage_status"] for r in book.entity_map.collect()}
    assert status == {f"N{i}": fx.STATUS.get(f"N{i}", "mapped") for i in range(1, 9)}


def test_positions(book):
    got = book.financed_emissions.collect()
    assert len(got) == len(fx.positions())
    assert sum(r["fx_missing_flag"] for r in got) == 1  # XYZ has no rate


@pytest.mark.parametrize("report_id", sorted(fx.KEYS))
def test_report(book, report_id):
    want = fx.expected()[report_id]
    got = rows_by(book.report(report_id), *fx.KEYS[report_id])
    assert set(got) == set(want)
    for key, values in want.items():
        for column, value in values.items():
            have = got[key][column]
            assert have == value if value is None else have == pytest.approx(value, rel=1e-12, abs=1e-9), (key, column)


def test_attribution_anchor(spark):
    """Fixed value: the published example of one holding, 2,312.5 tCO2e."""
    row = spark.range(1).select(
        F.lit("listed_equity").alias("asset_class"),
        F.lit(25_000_000.0).alias("exposure_eur"),
        F.lit(40_000_000_000.0).alias("evic_eur"),
        F.lit(None).cast("double").alias("total_assets_eur"),
        F.lit("mapped").alias("coverage_status"),
        F.lit(500_000.0).alias("scope1_tco2e"),
        F.lit(200_000.0).alias("scope2_tco2e"),
        F.lit(3_000_000.0).alias("scope3_tco2e"),
    )
    assert row.select(pcaf.attribution_factor() * pcaf.issuer_emissions()).first()[0] == 2312.5


def test_reports_above_a_trillion(spark, fixture_extracts, book):
    """Every report takes positions of 5e12; AUM of one portfolio is beyond 1e13."""
    from greenledger.plans.pipeline import REPORT_IDS, Book

    extracts = dict(fixture_extracts)
    big = F.when(F.col("market_value").rlike("^[0-9.]+$"), F.lit("5000000000000.25")).otherwise(F.col("market_value"))
    extracts["holdings"] = extracts["holdings"].withColumn("market_value", big)
    large = Book(spark, extracts, fx.AS_OF, fx.LOAN_BOOK)
    for rid in REPORT_IDS:
        assert large.report(rid).count() == book.report(rid).count()
    assert rows_by(large.report("R05"), "portfolio_id")[("ALPHA",)]["aum_eur"] == 4 * 5000000000000.25 + 0.05 * 5000000000000.25


def test_row_accounting(book):
    metrics = {r["step"]: r for r in book.step_metrics().collect()}
    for step, r in metrics.items():
        if step.startswith("silver."):
            assert r["input_rows"] == r["output_rows"] + r["rejected_rows"] + r["duplicate_rows"], r
    fact = metrics["gold.financed_emissions"]
    assert fact["input_rows"] == fact["output_rows"] == len(fx.positions())
