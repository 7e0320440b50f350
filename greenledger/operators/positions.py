"""Holdings and loans as one position table in EUR."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.functions.pcaf import BUSINESS_LOAN, asset_class_of
from greenledger.operators.joins import join_attributes

POSITION_COLUMNS = (
    "portfolio_id",
    "legal_entity",
    "issuer_id",
    "position_id",
    "position_kind",
    "asset_class",
    "instrument_type",
    "exposure_eur",
    "native_amount",
    "native_currency",
    "fx_missing_flag",
)
def fx_for_date(fx: DataFrame, as_of: str) -> DataFrame:
    """Rates of the as-of date keyed by ``fx_currency``, any code that parsed; one row per currency."""
    return (
        fx.where(F.col("as_of_date") == F.lit(as_of).cast("date"))
        .groupBy(F.col("currency").alias("fx_currency"))
        .agg(F.min("rate_to_eur").alias("rate_to_eur"))
    )


def with_legal_entity(positions: DataFrame, portfolios: DataFrame) -> DataFrame:
    return join_attributes(positions, portfolios.select("portfolio_id", "legal_entity"), "portfolio_id")


def _with_rate(positions: DataFrame, fx: DataFrame, as_of: str) -> DataFrame:
    rates = fx_for_date(fx, as_of).withColumnRenamed("fx_currency", "native_currency")
    return join_attributes(positions, rates, "native_currency")


def _in_eur(df: DataFrame, amount: str) -> DataFrame:
    """``exposure = amount x rate``; a missing rate counts as 1.0 and is flagged."""
    return df.withColumns(
        {
            "exposure_eur": F.col(amount) * F.coalesce(F.col("rate_to_eur"), F.lit(1.0)),
            "fx_missing_flag": F.col("rate_to_eur").isNull().cast("int"),
        }
    )


def _columns(portfolios: DataFrame | None) -> tuple[str, ...]:
    return POSITION_COLUMNS if portfolios is not None else tuple(c for c in POSITION_COLUMNS if c != "legal_entity")


def holding_positions(
    holdings: DataFrame,
    instrument_attrs: DataFrame,
    fx: DataFrame,
    portfolios: DataFrame | None,
    as_of: str,
    extra: Sequence[str] = (),
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Holdings of the as-of date with instrument, FX and (optionally) portfolio attributes.

    ``instrument_attrs`` is the instrument master, optionally already enriched
    with issuer attributes (``extra`` names them), so the big holdings side is
    shuffled once, on ``instrument_id``; ``heavy`` are the heavy hitters among
    the holdings' instruments, if known.
    """
    h = holdings.where(F.col("as_of_date") == F.lit(as_of).cast("date")).select(
        "portfolio_id", "instrument_id", "market_value", F.col("currency").alias("native_currency")
    )
    inst = instrument_attrs.select("instrument_id", "issuer_id", "instrument_type", *extra)
    joined = _with_rate(join_attributes(h, inst, "instrument_id", heavy), fx, as_of)
    if portfolios is not None:
        joined = with_legal_entity(joined, portfolios)
    joined = _in_eur(joined, "market_value").withColumns(
        {
            "asset_class": asset_class_of("instrument_type"),
            "position_id": F.col("instrument_id"),
            "position_kind": F.lit("holding"),
            "native_amount": F.col("market_value"),
        }
    )
    return joined.select(*_columns(portfolios), *extra)


def loan_positions(
    loans: DataFrame,
    fx: DataFrame,
    portfolios: DataFrame | None,
    as_of: str,
    loan_portfolio: str,
    issuer_attrs: DataFrame | None = None,
    extra: Sequence[str] = (),
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Business loans of the as-of date, all booked to ``loan_portfolio``."""
    lo = loans.where(F.col("as_of_date") == F.lit(as_of).cast("date")).select(
        F.lit(loan_portfolio).alias("portfolio_id"),
        F.col("borrower_issuer_id").alias("issuer_id"),
        F.col("loan_id").alias("position_id"),
        F.col("outstanding_amount").alias("native_amount"),
        F.col("currency").alias("native_currency"),
    )
    if issuer_attrs is not None:
        lo = join_attributes(lo, issuer_attrs.select("issuer_id", *extra), "issuer_id", heavy)
    joined = _with_rate(lo, fx, as_of)
    if portfolios is not None:
        joined = with_legal_entity(joined, portfolios)
    joined = _in_eur(joined, "native_amount").withColumns(
        {
            "asset_class": F.lit(BUSINESS_LOAN),
            "instrument_type": F.lit(BUSINESS_LOAN),
            "position_kind": F.lit("loan"),
        }
    )
    return joined.select(*_columns(portfolios), *extra)


def positions_in_eur(
    holdings: DataFrame,
    instruments: DataFrame,
    loans: DataFrame,
    fx: DataFrame,
    portfolios: DataFrame | None,
    as_of: str,
    loan_portfolio: str,
) -> DataFrame:
    """UNION ALL of holding and loan positions, converted to EUR at the as-of rate."""
    positions = holding_positions(holdings, instruments, fx, None, as_of).unionByName(
        loan_positions(loans, fx, None, as_of, loan_portfolio)
    )
    return with_legal_entity(positions, portfolios).select(*POSITION_COLUMNS)
