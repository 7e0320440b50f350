"""The nine published reports, each ``where -> groupBy -> agg -> select``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.functions.exact import merge
from greenledger.functions.numeric import round_half_up
from greenledger.functions.pcaf import BUSINESS_LOAN, CORPORATE_BOND, LISTED_EQUITY
from greenledger.operators.marts import intensities
from greenledger.operators.totals import accumulated, as_doubles, totals

# Report notes and SFDR indicator labels.
R05_COVERAGE_NOTE = "WACI uses positions with emissions and revenue; footprint uses full AUM"
R08_SIMPLIFICATION_NOTE = "SIMPLIFIED: issuer-level shares weighted by exposure; no turnover/CapEx split"
PAI1 = "PAI1_ghg_emissions_tco2e"
PAI2 = "PAI2_carbon_footprint_tco2e_per_m_eur"
PAI3 = "PAI3_ghg_intensity_tco2e_per_m_eur"


def financed_report(fe: DataFrame, asset_class: str, value_name: str) -> DataFrame:
    """R01-R03: one asset class at portfolio x issuer grain, in one aggregate.

    The quality columns (average score, emissions flag) are conditional
    aggregates of the same pass, not a second aggregate joined back.
    """
    rows = fe.where(F.col("asset_class") == F.lit(asset_class))
    fe_col = F.col("financed_emissions_tco2e")
    keys = ("as_of_date", "portfolio_id", "issuer_id", "issuer_name")
    sums = totals(
        rows,
        keys,
        {value_name: F.col("exposure_eur"), "emissions": fe_col},
        F.max("attribution_factor").alias("factor"),
        F.avg("pcaf_score").alias("score"),
        F.max(F.when(fe_col.isNotNull(), F.lit(1)).otherwise(F.lit(0))).alias("has_emissions_flag"),
    )
    return sums.select(
        *keys,
        round_half_up(value_name, 2).alias(value_name),
        round_half_up("emissions", 6).alias("financed_emissions_tco2e"),
        round_half_up("factor", 10).alias("attribution_factor"),
        round_half_up("score", 4).alias("pcaf_score"),
        "has_emissions_flag",
    )


def r01_equity(fe: DataFrame) -> DataFrame:
    return financed_report(fe, LISTED_EQUITY, "market_value_eur")


def r02_bonds(fe: DataFrame) -> DataFrame:
    return financed_report(fe, CORPORATE_BOND, "market_value_eur")


def r03_loans(fe: DataFrame) -> DataFrame:
    return financed_report(fe, BUSINESS_LOAN, "outstanding_eur")


def r04_quality(dq: DataFrame) -> DataFrame:
    return dq.select("as_of_date", "portfolio_id", "asset_class", "weighted_pcaf_score", "coverage_pct", "exposure_eur")


def r05_waci(ci: DataFrame) -> DataFrame:
    return ci.select(
        "as_of_date",
        "portfolio_id",
        "waci_tco2e_per_m_eur",
        "carbon_footprint_tco2e_per_m_eur",
        "financed_emissions_tco2e",
        "aum_eur",
        F.lit(R05_COVERAGE_NOTE).alias("coverage_note"),
    )


def r06_pai(summary: DataFrame, portfolios: DataFrame, as_of: str) -> DataFrame:
    """SFDR PAI 1-3 per legal entity, long form, from one aggregate.

    ``summary`` is the exact per-portfolio aggregate of the fact
    (``marts.portfolio_summary``). Every PAI is computed in the same
    per-entity aggregate over it, so the fact is scanned once: the
    accumulators are merged exactly (PAI1 = rounded total financed
    emissions; PAI2 from the rounded PAI1 and rounded AUM), and PAI3 is the
    AUM-weighted rounded WACI over the entity's portfolios that have a usable
    position. An entity without such a portfolio has no PAI3 row.
    """
    entity = portfolios.select("portfolio_id", "legal_entity")
    usable = F.col("usable_rows") > 0
    weighted = {"_pai3_num": F.when(usable, F.col("waci") * F.col("aum")), "_pai3_den": F.when(usable, F.col("aum"))}
    per_entity = accumulated(
        intensities(summary).join(entity, "portfolio_id", "left"),
        ("legal_entity",),
        weighted,
        merge("emissions").alias("emissions"),
        merge("exposure").alias("exposure"),
        F.count_if(usable).alias("_usable_portfolios"),
    )
    per_entity = as_doubles(per_entity, "emissions", "exposure", *weighted)
    per_entity = per_entity.withColumns({"pai1": round_half_up("emissions", 6), "aum_eur": round_half_up("exposure", 2)})
    wide = per_entity.select(
        "legal_entity",
        "_usable_portfolios",
        F.col("pai1").alias(PAI1),
        round_half_up(F.try_divide(F.col("pai1"), F.col("aum_eur") / 1_000_000.0), 6).alias(PAI2),
        round_half_up(F.try_divide(F.col("_pai3_num"), F.col("_pai3_den")), 6).alias(PAI3),
    )
    long = wide.unpivot(["legal_entity", "_usable_portfolios"], [PAI1, PAI2, PAI3], "pai_indicator", "pai_value")
    return long.where((F.col("pai_indicator") != PAI3) | (F.col("_usable_portfolios") > 0)).select(
        "legal_entity", "pai_indicator", "pai_value", F.lit(as_of).cast("date").alias("as_of_date")
    )


def r07_fossil(fe: DataFrame) -> DataFrame:
    """Fossil-fuel exposure per portfolio; percentages from the rounded euro amounts."""
    x = F.col("exposure_eur")
    flag = F.col("fossil_fuel_flag")
    terms = {
        "aum_eur": x,
        "fossil_fuel_market_value_eur": F.when(flag == 1, x).otherwise(F.lit(0.0)),
        "flagged_exposure_eur": F.when(flag.isNotNull(), x).otherwise(F.lit(0.0)),
    }
    agg = totals(fe, ("as_of_date", "portfolio_id"), terms)
    agg = agg.withColumns({c: round_half_up(c, 2) for c in ("aum_eur", "fossil_fuel_market_value_eur")})
    return agg.select(
        "as_of_date",
        "portfolio_id",
        "aum_eur",
        "fossil_fuel_market_value_eur",
        round_half_up(F.try_divide(100.0 * F.col("fossil_fuel_market_value_eur"), F.col("aum_eur")), 6).alias(
            "fossil_fuel_exposure_pct"
        ),
        "flagged_exposure_eur",
        round_half_up(F.try_divide(100.0 * F.col("flagged_exposure_eur"), F.col("aum_eur")), 4).alias(
            "flag_coverage_pct"
        ),
    )


def r08_taxonomy(ta: DataFrame) -> DataFrame:
    return ta.select(
        "as_of_date",
        "portfolio_id",
        "eligible_share_pct",
        "aligned_share_of_eligible_pct",
        "aligned_share_of_aum_pct",
        "aum_eur",
        F.lit(R08_SIMPLIFICATION_NOTE).alias("simplification_note"),
    )


def r09_coverage(coverage: DataFrame, as_of: str) -> DataFrame:
    """Rows and exposure by gap cause with the share of total AUM.

    The total is a window sum over the tiny per-cause aggregate (at most five
    rows), so nothing goes through the driver.
    """
    per_cause = accumulated(coverage, ("gap_cause",), {"exposure": F.col("exposure_eur")}, F.count(F.lit(1)).alias("row_count"))
    per_cause = per_cause.withColumn("total", merge("exposure", over="PARTITION BY 1"))
    per_cause = as_doubles(per_cause, "exposure", "total").withColumn("market_value_eur", round_half_up("exposure", 2))
    total = F.col("total")
    return per_cause.select(
        "gap_cause",
        "row_count",
        "market_value_eur",
        round_half_up(F.try_divide(100.0 * F.col("market_value_eur"), total), 6).alias("share_of_aum_pct"),
        F.lit(as_of).cast("date").alias("as_of_date"),
    )
