"""Column-expression builders (no DataFrames in, Columns out)."""

from greenledger.functions.cleaning import (
    blank_to_null,
    missing_flag,
    parse_date9,
    parse_iso_date,
    to_double,
    to_int,
    trimmed,
)
from greenledger.functions.pcaf import (
    asset_class_of,
    attribution_factor,
    gap_cause,
    issuer_emissions,
    pcaf_score,
)

__all__ = [
    "asset_class_of",
    "attribution_factor",
    "blank_to_null",
    "gap_cause",
    "issuer_emissions",
    "missing_flag",
    "parse_date9",
    "parse_iso_date",
    "pcaf_score",
    "to_double",
    "to_int",
    "trimmed",
]
