"""Declarative specs: source cleaning contracts, report keys and tolerances."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from greenledger.operators.quality import CleanSpec

# Reject reasons of the table rules.
MISSING_MARKET_VALUE = "missing_market_value"
UNPARSEABLE_DATE = "unparseable_date"
MISSING_OUTSTANDING = "missing_outstanding_amount"
NEGATIVE_OUTSTANDING = "negative_outstanding_amount"
MISSING_TAXONOMY_SHARE = "missing_taxonomy_share"
ALIGNED_GT_ELIGIBLE = "aligned_gt_eligible"
UNPARSEABLE_DATE9 = "unparseable_sas_date9"

PORTFOLIOS = CleanSpec(
    name="portfolios",
    columns=("portfolio_id", "portfolio_name", "legal_entity", "asset_class_scope", "currency"),
    key=("portfolio_id",),
)
INSTRUMENTS = CleanSpec(
    name="instruments",
    columns=("instrument_id", "isin", "instrument_type", "issuer_id", "currency"),
    key=("instrument_id",),
    upper=("isin",),
)
ISSUERS = CleanSpec(
    name="issuers",
    columns=("issuer_id", "lei", "issuer_name", "country", "nace_sector"),
    key=("issuer_id",),
    blank_to_null=("lei",),
    flags={"lei_missing_flag": "lei"},
)


def holdings_spec(tie_breakers: tuple[tuple[str, str], ...] = ()) -> CleanSpec:
    """Holdings; ``tie_breakers`` are extra (column, type) pairs that order duplicates after value desc."""
    extra_cols = tuple(c for c, _ in tie_breakers)
    return CleanSpec(
        name="holdings",
        columns=("portfolio_id", "instrument_id", "as_of_date", "quantity", "market_value", "currency", *extra_cols),
        key=("portfolio_id", "instrument_id", "as_of_date"),
        iso_dates=("as_of_date",),
        doubles=("quantity", "market_value"),
        longs=tuple(c for c, t in tie_breakers if t == "bigint"),
        ints=tuple(c for c, t in tie_breakers if t == "int"),
        rules=(
            (MISSING_MARKET_VALUE, lambda: F.col("market_value").isNull()),
            (UNPARSEABLE_DATE, lambda: F.col("as_of_date").isNull()),
        ),
        order=(("market_value", False), *((c, True) for c in extra_cols)),
    )


HOLDINGS = holdings_spec()
LOANS = CleanSpec(
    name="loans",
    columns=("loan_id", "borrower_issuer_id", "as_of_date", "outstanding_amount", "currency", "loan_purpose"),
    key=("loan_id", "as_of_date"),
    iso_dates=("as_of_date",),
    doubles=("outstanding_amount",),
    rules=(
        (MISSING_OUTSTANDING, lambda: F.col("outstanding_amount").isNull()),
        (NEGATIVE_OUTSTANDING, lambda: F.col("outstanding_amount") < 0),
        (UNPARSEABLE_DATE, lambda: F.col("as_of_date").isNull()),
    ),
)
COMPANY_FINANCIALS = CleanSpec(
    name="company_financials",
    columns=("issuer_id", "fiscal_year", "evic_eur", "total_assets_eur", "revenue_eur"),
    key=("issuer_id", "fiscal_year"),
    ints=("fiscal_year",),
    doubles=("evic_eur", "total_assets_eur", "revenue_eur"),
)
VENDOR_EMISSIONS = CleanSpec(
    name="vendor_emissions",
    columns=(
        "provider_entity_id",
        "fiscal_year",
        "scope1_tco2e",
        "scope2_tco2e",
        "scope3_tco2e",
        "emission_data_source",
        "esg_rating",
        "fossil_fuel_flag",
    ),
    key=("provider_entity_id", "fiscal_year"),
    ints=("fiscal_year", "fossil_fuel_flag"),
    doubles=("scope1_tco2e", "scope2_tco2e", "scope3_tco2e"),
    blank_to_null=("esg_rating",),
    restricted=True,
)
TAXONOMY = CleanSpec(
    name="taxonomy_data",
    columns=("issuer_id", "fiscal_year", "taxonomy_eligible_share", "taxonomy_aligned_share"),
    key=("issuer_id", "fiscal_year"),
    ints=("fiscal_year",),
    doubles=("taxonomy_eligible_share", "taxonomy_aligned_share"),
    rules=(
        (
            MISSING_TAXONOMY_SHARE,
            lambda: F.col("taxonomy_eligible_share").isNull() | F.col("taxonomy_aligned_share").isNull(),
        ),
        (ALIGNED_GT_ELIGIBLE, lambda: F.col("taxonomy_aligned_share") > F.col("taxonomy_eligible_share")),
    ),
)
FX_RATES = CleanSpec(
    name="fx_rates",
    columns=("currency", "as_of_date", "rate_to_eur"),
    key=("currency", "as_of_date"),
    date9_dates=("as_of_date",),
    doubles=("rate_to_eur",),
    rules=((UNPARSEABLE_DATE9, lambda: F.col("as_of_date").isNull()),),
)
CROSSWALK = CleanSpec(
    name="crosswalk",
    columns=("issuer_id", "provider_entity_id"),
    key=("issuer_id",),
    blank_to_null=("provider_entity_id",),
)

SOURCES = (
    PORTFOLIOS,
    INSTRUMENTS,
    ISSUERS,
    HOLDINGS,
    LOANS,
    COMPANY_FINANCIALS,
    VENDOR_EMISSIONS,
    TAXONOMY,
    FX_RATES,
    CROSSWALK,
)


@dataclass(frozen=True)
class ReconSpec:
    report_id: str
    keys: tuple[str, ...]
    values: tuple[str, ...]
    abs_tol: float
    rel_tol: float


# Reconciliation keys, compared columns and tolerances per report.
RECON_SPECS = {
    "R01": ReconSpec("R01", ("portfolio_id", "issuer_id"), ("financed_emissions_tco2e",), 0.5, 0.001),
    "R02": ReconSpec("R02", ("portfolio_id", "issuer_id"), ("financed_emissions_tco2e",), 0.5, 0.001),
    "R03": ReconSpec("R03", ("portfolio_id", "issuer_id"), ("financed_emissions_tco2e",), 0.5, 0.001),
    "R04": ReconSpec("R04", ("portfolio_id", "asset_class"), ("weighted_pcaf_score",), 0.05, 0.01),
    "R05": ReconSpec("R05", ("portfolio_id",), ("waci_tco2e_per_m_eur",), 0.5, 0.001),
    "R06": ReconSpec("R06", ("legal_entity", "pai_indicator"), ("pai_value",), 0.5, 0.001),
    "R07": ReconSpec("R07", ("portfolio_id",), ("fossil_fuel_exposure_pct",), 0.05, 0.001),
    "R08": ReconSpec("R08", ("portfolio_id",), ("aligned_share_of_eligible_pct",), 0.05, 0.001),
    "R09": ReconSpec("R09", ("gap_cause",), ("row_count", "share_of_aum_pct"), 0.05, 0.001),
}
