"""Financed emissions per position (PCAF attribution x issuer emissions)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.functions.numeric import round_half_up
from greenledger.functions.pcaf import attribution_factor, issuer_emissions, pcaf_score
from greenledger.operators.joins import join_attributes
from greenledger.operators.positions import POSITION_COLUMNS, holding_positions, loan_positions, with_legal_entity

# Published column names.
ISSUER_ATTRS = (
    "fiscal_year",
    "evic_eur",
    "total_assets_eur",
    "revenue_eur",
    "issuer_name",
    "provider_entity_id",
    "coverage_status",
    "lei_missing_flag",
    "scope1_tco2e",
    "scope2_tco2e",
    "scope3_tco2e",
    "emission_data_source",
    "esg_rating",
    "fossil_fuel_flag",
)
TAXONOMY_ATTRS = ("taxonomy_eligible_share", "taxonomy_aligned_share")
# Columns that are the vendor's licensed data (they stay in the restricted layer).
VENDOR_ATTRS = (
    "provider_entity_id",
    "scope1_tco2e",
    "scope2_tco2e",
    "scope3_tco2e",
    "emission_data_source",
    "esg_rating",
    "fossil_fuel_flag",
)
FINANCED_EMISSIONS_COLUMNS = (
    *POSITION_COLUMNS,
    *ISSUER_ATTRS,
    "attribution_factor",
    "issuer_emissions_tco2e",
    "financed_emissions_tco2e",
    "pcaf_score",
    "as_of_date",
)


def issuer_profile(
    financials: DataFrame,
    entity_map: DataFrame,
    vendor: DataFrame,
    taxonomy: DataFrame | None,
    fiscal_year: int,
) -> DataFrame:
    """Everything known about an issuer for one fiscal year, one row per issuer.

    Entity map + vendor emissions (joined on the vendor id), financials and
    taxonomy shares (joined on the issuer id, full outer so that a position
    sees each side exactly as separate left joins would). All inputs are
    issuer-grain, so this never touches the position-sized data.
    """
    fy = F.lit(fiscal_year)
    vend = vendor.where(F.col("fiscal_year") == fy).select(*VENDOR_ATTRS)
    emap = entity_map.select(
        "issuer_id", "issuer_name", "provider_entity_id", "coverage_status", "lei_missing_flag"
    ).join(vend, "provider_entity_id", "left")
    fin = financials.where(F.col("fiscal_year") == fy).select(
        "issuer_id", "fiscal_year", "evic_eur", "total_assets_eur", "revenue_eur"
    )
    profile = fin.join(emap, "issuer_id", "full")
    if taxonomy is not None:
        tax = taxonomy.where(F.col("fiscal_year") == fy).select("issuer_id", *TAXONOMY_ATTRS)
        profile = profile.join(tax, "issuer_id", "full")
    return profile


def attribute(positions: DataFrame, as_of: str) -> DataFrame:
    """Factor x emissions on unrounded factors, score, then the published rounding."""
    scored = positions.withColumns(
        {
            "attribution_factor": attribution_factor(),
            "issuer_emissions_tco2e": issuer_emissions(),
        }
    ).withColumns(
        {
            "financed_emissions_tco2e": F.col("attribution_factor") * F.col("issuer_emissions_tco2e"),
            "pcaf_score": pcaf_score(),
            "as_of_date": F.lit(as_of).cast("date"),
        }
    )
    return scored.withColumns(
        {
            "financed_emissions_tco2e": round_half_up("financed_emissions_tco2e", 6),
            "attribution_factor": round_half_up("attribution_factor", 10),
        }
    )


def financed_emissions(
    holdings: DataFrame,
    instruments: DataFrame,
    loans: DataFrame,
    fx: DataFrame,
    portfolios: DataFrame | None,
    financials: DataFrame,
    entity_map: DataFrame,
    vendor: DataFrame,
    as_of: str,
    loan_portfolio: str,
    taxonomy: DataFrame | None = None,
    heavy: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Position-level financed emissions; unattributed positions stay, with nulls.

    Plan shape: the issuer profile is built at issuer grain and pushed onto
    the instrument master, so holdings join once (on instrument_id) and loans
    join once (on issuer_id). ``heavy`` gives the heavy hitters (see
    :mod:`greenledger.operators.joins`) of written ``holdings`` by instrument, of
    ``loans`` by issuer and of ``instruments`` by issuer. With ``portfolios``
    the legal entity is attached (the published table); without it the fact
    stays at portfolio level, which is all the marts and reports need. With
    ``taxonomy`` the taxonomy shares ride along (columns ``taxonomy_*``), so
    the taxonomy mart aggregates without another pass over the positions.
    """
    fiscal_year = int(as_of[:4])
    profile = issuer_profile(financials, entity_map, vendor, taxonomy, fiscal_year)
    tax_cols = TAXONOMY_ATTRS if taxonomy is not None else ()
    extra = ISSUER_ATTRS + tax_cols
    heavy = heavy or {}
    instrument_attrs = join_attributes(
        instruments.select("instrument_id", "issuer_id", "instrument_type"), profile, "issuer_id", heavy.get("instruments")
    )
    positions = holding_positions(
        holdings, instrument_attrs, fx, None, as_of, extra, heavy.get("holdings")
    ).unionByName(loan_positions(loans, fx, None, as_of, loan_portfolio, profile, extra, heavy.get("loans")))
    out = attribute(positions, as_of)
    columns = FINANCED_EMISSIONS_COLUMNS
    if portfolios is not None:
        out = with_legal_entity(out, portfolios)
    else:
        columns = tuple(c for c in columns if c != "legal_entity")
    return out.select(*columns, *tax_cols)


def open_projection(fe: DataFrame) -> DataFrame:
    """The fact without the vendor's licensed columns, for the open gold layer (derived values stay)."""
    return fe.drop(*[c for c in VENDOR_ATTRS if c in fe.columns])
