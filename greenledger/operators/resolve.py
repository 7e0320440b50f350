"""Issuer -> vendor entity resolution with a coverage status on every issuer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.functions.pcaf import MAPPED, ORPHAN_PROVIDER, UNMAPPED_ISSUER

ENTITY_MAP_COLUMNS = (
    "issuer_id",
    "lei",
    "issuer_name",
    "country",
    "nace_sector",
    "lei_missing_flag",
    "provider_entity_id",
    "coverage_status",
)


def resolve_entities(issuers: DataFrame, crosswalk: DataFrame, vendor: DataFrame, fiscal_year: int) -> DataFrame:
    """Every issuer kept; status ``unmapped_issuer`` / ``orphan_provider`` / ``mapped``.

    The vendor check is an existence join against the distinct vendor ids of
    the fiscal year (a partial aggregate, so vendor duplicates cannot fan out).
    """
    providers = (
        vendor.where(F.col("fiscal_year") == F.lit(fiscal_year))
        .select("provider_entity_id")
        .distinct()
        .withColumn("_provider_found", F.lit(True))
    )
    mapped = issuers.join(crosswalk.select("issuer_id", "provider_entity_id"), "issuer_id", "left")
    resolved = mapped.join(providers, "provider_entity_id", "left")
    status = (
        F.when(F.col("provider_entity_id").isNull(), F.lit(UNMAPPED_ISSUER))
        .when(F.col("_provider_found").isNull(), F.lit(ORPHAN_PROVIDER))
        .otherwise(F.lit(MAPPED))
    )
    return resolved.withColumn("coverage_status", status).select(*ENTITY_MAP_COLUMNS)
