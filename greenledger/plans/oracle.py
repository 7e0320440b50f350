"""SQL twins of the Spark queries, for DuckDB over the driver tables.

The cleaning contract is written out by hand below; joins, marts and reports are
written out in the plain shape of the original batch job (sequential left
joins, separate aggregates), so they check the fused Spark plans
independently. Only used for verification, never on the Spark path.
"""

from __future__ import annotations

from greenledger.plans import specs
from greenledger.sources import driver

AS_OF = driver.AS_OF
FY = int(AS_OF[:4])
D = f"DATE '{AS_OF}'"

def xsum(e: str, *factors: str) -> str:
    """Exact sum of doubles, as double: whole parts and the parts below them (in 2**-96) are added as integers."""
    term = "(" + " * ".join([f"({e})", *(f"CAST({x} AS DOUBLE)" for x in factors)]) + ")"
    whole = f"sum(CAST(floor({term}) AS HUGEINT))"
    below = f"sum(CAST(({term} - floor({term})) * {UNIT} AS HUGEINT))"
    return f"(CAST({whole} + {below} // {UNIT}::HUGEINT AS DOUBLE) + CAST({below} % {UNIT}::HUGEINT AS DOUBLE) / {UNIT})"


#: 2**96
UNIT = "79228162514264337593543950336.0"


def rsum(e: str, n: int) -> str:
    """Exact sum rounded half-up to n places, as double."""
    return f"CAST(CAST(round(CAST(CAST({xsum(e)} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS VARCHAR) AS DOUBLE)"


def rnd(e: str, n: int) -> str:
    """Half-up rounding in the decimal domain, as double."""
    return f"CAST(CAST(round(CAST({e} AS DECIMAL(38,18)), {n}) AS VARCHAR) AS DOUBLE)"


LANDING_SQL = f"""
nsupp AS (SELECT count(*) AS n FROM supplier),
l_portfolios AS (
  SELECT seg AS portfolio_id, lower(seg) AS portfolio_name,
    CASE WHEN seg = 'BUILDING' THEN 'ENTITY_A '
         WHEN seg IN ('BUILDING', 'MACHINERY') THEN 'ENTITY_A' ELSE 'ENTITY_B' END AS legal_entity,
    CASE WHEN seg = '{driver.LOAN_PORTFOLIO}' THEN 'business_loans' ELSE 'mixed' END AS asset_class_scope,
    'EUR' AS currency
  FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer) s),
l_instruments AS (
  SELECT CAST(p_partkey AS VARCHAR) AS instrument_id, ' ' || lower(p_brand) || ' ' AS isin,
    CASE WHEN p_type IN ('PROMO', 'ECONOMY', 'SMALL') THEN 'equity' ELSE 'corporate_bond' END AS instrument_type,
    CAST(p_partkey % (SELECT n FROM nsupp) AS VARCHAR) AS issuer_id, 'EUR' AS currency
  FROM part),
l_issuers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS issuer_id,
    CASE WHEN s_suppkey % 9 = 2 THEN '   ' ELSE 'LEI' || CAST(s_suppkey AS VARCHAR) END AS lei,
    s_name || '  ' AS issuer_name, CAST(s_nationkey AS VARCHAR) AS country,
    'C' || CAST(s_nationkey % 33 AS VARCHAR) AS nace_sector
  FROM supplier WHERE s_suppkey % 25 <> 24),
l_holdings AS (
  SELECT c_mktsegment AS portfolio_id, CAST(l_partkey AS VARCHAR) AS instrument_id,
    CAST(make_date(year(l_shipdate), 12, 31) AS VARCHAR) AS as_of_date,
    CAST(l_quantity AS VARCHAR) AS quantity,
    CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_extendedprice AS VARCHAR) END AS market_value,
    CASE WHEN l_linenumber % 2 = 0 THEN cur || ' ' ELSE cur END AS currency,
    CAST(l_orderkey AS VARCHAR) AS src_order_key, CAST(l_linenumber AS VARCHAR) AS src_line_no
  FROM (SELECT l.*, o.o_custkey,
          CASE l_suppkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'SEK' WHEN 2 THEN 'GBP' ELSE 'XXX' END AS cur
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) li
  JOIN customer c ON li.o_custkey = c.c_custkey),
l_loans AS (
  SELECT CASE WHEN o_orderkey % 40 = 11 THEN '  ' ELSE CAST(o_orderkey AS VARCHAR) END AS loan_id,
    CAST(o_custkey % (SELECT n FROM nsupp) AS VARCHAR) AS borrower_issuer_id,
    CAST(make_date(year(o_orderdate) + later, 12, 31) AS VARCHAR) AS as_of_date,
    CASE WHEN o_orderkey % 40 = 7 THEN CAST(-o_totalprice AS VARCHAR)
         WHEN o_orderkey % 40 = 8 THEN NULL WHEN o_orderkey % 40 = 9 THEN 'NaN'
         WHEN o_orderkey % 40 = 10 THEN '-Infinity' WHEN o_orderkey % 1000 = 500 THEN '2500000000000.5'
         ELSE CAST(o_totalprice AS VARCHAR) END AS outstanding_amount,
    CASE WHEN o_orderkey % 40 = 12 THEN 'usd' WHEN o_orderkey % 40 = 13 THEN 'USDT'
         WHEN o_orderkey % 3 = 0 THEN 'EUR' WHEN o_orderkey % 3 = 1 THEN 'GBP' ELSE 'SEK' END AS currency,
    o_orderpriority AS loan_purpose
  FROM orders, (SELECT unnest([0, 1]) AS later) twice WHERE later = 0 OR o_orderkey % 10 = 3),
l_company_financials AS (
  SELECT CAST(k AS VARCHAR) AS issuer_id, CAST(y AS VARCHAR) AS fiscal_year,
    CASE WHEN k % 5 = 1 THEN '0' ELSE CAST(v * 1000 AS VARCHAR) END AS evic_eur,
    CAST(v * 1500 AS VARCHAR) AS total_assets_eur, CAST(v * 100 AS VARCHAR) AS revenue_eur
  FROM (SELECT l_suppkey AS k, year(l_shipdate) AS y, sum(CAST(l_extendedprice AS DECIMAL(15, 2))) AS v
        FROM lineitem GROUP BY 1, 2) f),
l_vendor_emissions AS (
  SELECT CAST(s_suppkey + 1000000 AS VARCHAR) AS provider_entity_id, CAST(fy AS VARCHAR) AS fiscal_year,
    CAST((s_suppkey % 50 + 1) * 1000 * scale AS VARCHAR) AS scope1_tco2e,
    CAST((s_suppkey % 20 + 1) * 250 AS VARCHAR) AS scope2_tco2e,
    CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST((s_suppkey % 30 + 1) * 4000 AS VARCHAR) END AS scope3_tco2e,
    CASE s_suppkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'reported' ELSE 'estimated' END AS emission_data_source,
    CASE WHEN s_suppkey % 11 = 3 THEN '  '
         ELSE CASE s_suppkey % 7 WHEN 0 THEN 'AAA' WHEN 1 THEN 'AA' WHEN 2 THEN 'A' WHEN 3 THEN 'BBB'
                                 WHEN 4 THEN 'BB' WHEN 5 THEN 'B' ELSE 'CCC' END END AS esg_rating,
    CASE WHEN s_suppkey % 6 = 2 THEN '1' ELSE '0' END AS fossil_fuel_flag
  FROM supplier, (SELECT {FY} AS fy, 1 AS scale UNION ALL SELECT {FY - 1}, 2) years),
l_taxonomy_data AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS issuer_id, '{FY}' AS fiscal_year,
    '0.' || CAST(s_suppkey % 10 AS VARCHAR) || lpad(CAST(CAST(s_suppkey AS BIGINT) * 829348951 % 10000000000000 AS VARCHAR), 13, '0') AS taxonomy_eligible_share,
    CASE WHEN s_suppkey % 8 = 6 THEN '0.95' WHEN s_suppkey % 8 = 7 THEN NULL
         ELSE '0.' || CAST(s_suppkey % 10 // 2 AS VARCHAR)
           || lpad(CAST(CAST(s_suppkey AS BIGINT) * 829348951 % 10000000000000 AS VARCHAR), 13, '0') END AS taxonomy_aligned_share
  FROM supplier),
fx_years AS (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders),
l_fx_rates AS (
  SELECT 'EUR' AS currency, '31dec' || y AS as_of_date, '1.0' AS rate_to_eur FROM fx_years
  UNION ALL SELECT 'SEK', '31dec' || y, '0.087' FROM fx_years
  UNION ALL SELECT 'GBP', '31dec' || y, '1.18' FROM fx_years
  UNION ALL SELECT 'usd', '31dec' || y, '0.92' FROM fx_years
  UNION ALL SELECT 'USDT', '31dec' || y, '0.91' FROM fx_years
  UNION ALL SELECT 'NOK', y || '-12-31', '0.085' FROM fx_years),
l_crosswalk AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS issuer_id,
    CASE WHEN s_suppkey % 7 = 5 THEN '-1' WHEN s_suppkey % 49 = 6 THEN '  '
         ELSE CAST(s_suppkey + 1000000 AS VARCHAR) END AS provider_entity_id
  FROM supplier WHERE s_suppkey % 7 <> 3)"""


# The cleaning contract written out for the check, apart from the specs that Spark uses:
# source -> (key, order before all columns, columns as "name:kind").
CONTRACT = {
    "portfolios": ("portfolio_id", "", "portfolio_id portfolio_name legal_entity asset_class_scope currency"),
    "instruments": ("instrument_id", "", "instrument_id isin:upper instrument_type issuer_id currency"),
    "issuers": ("issuer_id", "", "issuer_id lei:blank issuer_name country nace_sector lei_missing_flag:flag_lei"),
    "holdings": (
        "portfolio_id instrument_id as_of_date",
        "-market_value ASC NULLS FIRST, src_order_key, src_line_no,",
        "portfolio_id instrument_id as_of_date:iso quantity:double market_value:double currency src_order_key:bigint src_line_no:int",
    ),
    "loans": (
        "loan_id as_of_date", "",
        "loan_id borrower_issuer_id as_of_date:iso outstanding_amount:double currency loan_purpose",
    ),
    "company_financials": (
        "issuer_id fiscal_year", "",
        "issuer_id fiscal_year:int evic_eur:double total_assets_eur:double revenue_eur:double",
    ),
    "vendor_emissions": (
        "provider_entity_id fiscal_year", "",
        "provider_entity_id fiscal_year:int scope1_tco2e:double scope2_tco2e:double scope3_tco2e:double "
        "emission_data_source esg_rating:blank fossil_fuel_flag:int",
    ),
    "taxonomy_data": (
        "issuer_id fiscal_year", "",
        "issuer_id fiscal_year:int taxonomy_eligible_share:double taxonomy_aligned_share:double",
    ),
    "fx_rates": ("currency as_of_date", "", "currency as_of_date:date9 rate_to_eur:double"),
    "crosswalk": ("issuer_id", "", "issuer_id provider_entity_id:blank"),
}
KINDS = {
    "": "trim({c})",
    "upper": "upper(trim({c}))",
    "blank": "nullif(trim({c}), '')",
    "flag_lei": "CAST(nullif(trim(lei), '') IS NULL AS INTEGER)",
    "double": "TRY_CAST(trim({c}) AS DOUBLE)",
    "int": "TRY_CAST(trim({c}) AS INTEGER)",
    "bigint": "TRY_CAST(trim({c}) AS BIGINT)",
    "iso": "CAST(try_strptime(trim({c}), '%Y-%m-%d') AS DATE)",
    "date9": "CAST(try_strptime(upper(trim({c})), '%d%b%Y') AS DATE)",
}
RULES = {
    "holdings": (("missing_market_value", "market_value IS NULL"), ("unparseable_date", "as_of_date IS NULL")),
    "loans": (
        ("missing_outstanding_amount", "outstanding_amount IS NULL"),
        ("negative_outstanding_amount", "outstanding_amount < 0"),
        ("unparseable_date", "as_of_date IS NULL"),
    ),
    "taxonomy_data": (
        ("missing_taxonomy_share", "taxonomy_eligible_share IS NULL OR taxonomy_aligned_share IS NULL"),
        ("aligned_gt_eligible", "taxonomy_aligned_share > taxonomy_eligible_share"),
    ),
    "fx_rates": (("unparseable_sas_date9", "as_of_date IS NULL"),),
}


def _clean_ctes(n: str) -> str:
    keys, order, columns = CONTRACT[n]
    keys = keys.split()
    kinds = {c: k for c, _, k in (x.partition(":") for x in columns.split())}
    typed = ", ".join(f"{KINDS[k].format(c=c)} AS {c}" for c, k in kinds.items())
    odd = " OR ".join(f"NOT isfinite({c})" for c, k in kinds.items() if k == "double")
    whens = [f"WHEN {odd} THEN 'non_finite_number'"] if odd else []
    whens += [f"WHEN {p} THEN '{r}'" for r, p in RULES.get(n, ())]
    whens.append("WHEN " + " OR ".join(f"{k} IS NULL OR CAST({k} AS VARCHAR) = ''" for k in keys) + " THEN 'missing_key'")
    key, cols = ", ".join(keys), ", ".join(kinds)
    ties = ", ".join(f"{c} ASC NULLS FIRST" for c in kinds)
    bkey = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    return f"""
x_{n} AS (SELECT *, CASE {' '.join(whens)} END AS _reason FROM (SELECT {typed} FROM l_{n}) t),
s_{n} AS (SELECT {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order} {ties}) AS _rn
  FROM x_{n} WHERE _reason IS NULL) d WHERE _rn = 1),
rej_{n} AS (
  SELECT '{n}' AS source_table, _reason AS reject_reason, {bkey} AS business_key, CAST(1 AS BIGINT) AS rejected_rows
  FROM x_{n} WHERE _reason IS NOT NULL
  UNION ALL
  SELECT '{n}', 'duplicate_key', {bkey}, CAST(count(*) - 1 AS BIGINT)
  FROM x_{n} WHERE _reason IS NULL GROUP BY {key} HAVING count(*) > 1)"""


FE_COLS = """portfolio_id, legal_entity, issuer_id, position_id, position_kind, asset_class, instrument_type,
    exposure_eur, native_amount, native_currency, fx_missing_flag, fiscal_year, evic_eur, total_assets_eur,
    revenue_eur, issuer_name, provider_entity_id, coverage_status, lei_missing_flag, scope1_tco2e, scope2_tco2e,
    scope3_tco2e, emission_data_source, esg_rating, fossil_fuel_flag"""

GOLD_SQL = f"""
g_providers AS (SELECT DISTINCT provider_entity_id FROM s_vendor_emissions WHERE fiscal_year = {FY}),
g_entity_map AS (
  SELECT i.issuer_id, i.lei, i.issuer_name, i.country, i.nace_sector, i.lei_missing_flag, c.provider_entity_id,
    CASE WHEN c.provider_entity_id IS NULL THEN 'unmapped_issuer'
         WHEN p.provider_entity_id IS NULL THEN 'orphan_provider' ELSE 'mapped' END AS coverage_status
  FROM s_issuers i
  LEFT JOIN s_crosswalk c ON i.issuer_id = c.issuer_id
  LEFT JOIN g_providers p ON c.provider_entity_id = p.provider_entity_id),
g_fx AS (SELECT currency AS fx_currency, rate_to_eur FROM s_fx_rates WHERE as_of_date = {D}),
g_positions AS (
  SELECT h.portfolio_id, p.legal_entity, i.issuer_id, h.instrument_id AS position_id, 'holding' AS position_kind,
    CASE WHEN i.instrument_type = 'equity' THEN 'listed_equity' ELSE i.instrument_type END AS asset_class,
    i.instrument_type, h.market_value * coalesce(f.rate_to_eur, 1.0) AS exposure_eur,
    h.market_value AS native_amount, h.currency AS native_currency,
    CAST(f.rate_to_eur IS NULL AS INTEGER) AS fx_missing_flag
  FROM s_holdings h
  LEFT JOIN s_instruments i ON h.instrument_id = i.instrument_id
  LEFT JOIN g_fx f ON h.currency = f.fx_currency
  LEFT JOIN s_portfolios p ON h.portfolio_id = p.portfolio_id
  WHERE h.as_of_date = {D}
  UNION ALL
  SELECT '{driver.LOAN_PORTFOLIO}', p.legal_entity, l.borrower_issuer_id, l.loan_id, 'loan', 'business_loan',
    'business_loan', l.outstanding_amount * coalesce(f.rate_to_eur, 1.0), l.outstanding_amount, l.currency,
    CAST(f.rate_to_eur IS NULL AS INTEGER)
  FROM s_loans l
  LEFT JOIN g_fx f ON l.currency = f.fx_currency
  LEFT JOIN s_portfolios p ON p.portfolio_id = '{driver.LOAN_PORTFOLIO}'
  WHERE l.as_of_date = {D}),
g_fe_raw AS (
  SELECT pos.*, fin.fiscal_year, fin.evic_eur, fin.total_assets_eur, fin.revenue_eur,
    em.issuer_name, em.provider_entity_id, em.coverage_status, em.lei_missing_flag,
    v.scope1_tco2e, v.scope2_tco2e, v.scope3_tco2e, v.emission_data_source, v.esg_rating, v.fossil_fuel_flag
  FROM g_positions pos
  LEFT JOIN (SELECT * FROM s_company_financials WHERE fiscal_year = {FY}) fin ON pos.issuer_id = fin.issuer_id
  LEFT JOIN g_entity_map em ON pos.issuer_id = em.issuer_id
  LEFT JOIN (SELECT * FROM s_vendor_emissions WHERE fiscal_year = {FY}) v
    ON em.provider_entity_id = v.provider_entity_id),
g_fe_calc AS (
  SELECT *,
    CASE WHEN asset_class IN ('listed_equity', 'corporate_bond') AND evic_eur > 0 THEN exposure_eur / evic_eur
         WHEN asset_class = 'business_loan' AND total_assets_eur > 0 THEN exposure_eur / total_assets_eur
    END AS af,
    CASE WHEN coverage_status = 'mapped'
         THEN coalesce(scope1_tco2e, 0.0) + coalesce(scope2_tco2e, 0.0) + coalesce(scope3_tco2e, 0.0)
    END AS issuer_emissions_tco2e
  FROM g_fe_raw),
g_fe AS (
  SELECT {FE_COLS},
    {rnd("af", 10)} AS attribution_factor, issuer_emissions_tco2e,
    {rnd("af * issuer_emissions_tco2e", 6)} AS financed_emissions_tco2e,
    CASE WHEN coverage_status <> 'mapped' THEN 5
         WHEN emission_data_source = 'verified' AND scope1_tco2e IS NOT NULL AND scope2_tco2e IS NOT NULL
              AND scope3_tco2e IS NOT NULL THEN 1
         WHEN emission_data_source = 'reported' AND scope1_tco2e IS NOT NULL AND scope2_tco2e IS NOT NULL
              AND scope3_tco2e IS NOT NULL THEN 2
         WHEN emission_data_source = 'reported' AND scope1_tco2e IS NOT NULL AND scope2_tco2e IS NOT NULL THEN 3
         WHEN emission_data_source = 'estimated' THEN 4
         ELSE 5 END AS pcaf_score,
    {D} AS as_of_date
  FROM g_fe_calc),
g_dq AS (
  SELECT as_of_date, portfolio_id, asset_class, exposure_eur, covered_exposure_eur,
    {rnd("score_num / nullif(exposure_eur, 0)", 4)} AS weighted_pcaf_score,
    {rnd("100.0 * covered_exposure_eur / nullif(exposure_eur, 0)", 4)} AS coverage_pct
  FROM (SELECT as_of_date, portfolio_id, asset_class, {xsum("exposure_eur")} AS exposure_eur,
          {xsum("exposure_eur", "pcaf_score")} AS score_num,
          {xsum("CASE WHEN financed_emissions_tco2e IS NOT NULL THEN exposure_eur ELSE 0.0 END")} AS covered_exposure_eur
        FROM g_fe GROUP BY 1, 2, 3) a),
g_ci_usable AS (
  SELECT as_of_date, portfolio_id,
    {xsum("issuer_emissions_tco2e / (revenue_eur / 1000000.0)", "exposure_eur")} AS waci_num,
    {xsum("exposure_eur")} AS covered_exposure_eur, {xsum("financed_emissions_tco2e")} AS financed_emissions_tco2e
  FROM g_fe
  WHERE issuer_emissions_tco2e IS NOT NULL AND revenue_eur > 0 AND financed_emissions_tco2e IS NOT NULL
  GROUP BY 1, 2),
g_ci AS (
  SELECT u.as_of_date, u.portfolio_id, u.covered_exposure_eur, u.financed_emissions_tco2e, t.aum_eur,
    {rnd("u.waci_num / nullif(u.covered_exposure_eur, 0)", 6)} AS waci_tco2e_per_m_eur,
    {rnd("u.financed_emissions_tco2e / nullif(t.aum_eur / 1000000.0, 0)", 6)} AS carbon_footprint_tco2e_per_m_eur
  FROM g_ci_usable u
  LEFT JOIN (SELECT portfolio_id, {xsum("exposure_eur")} AS aum_eur FROM g_fe GROUP BY 1) t
    ON u.portfolio_id = t.portfolio_id),
g_ta AS (
  SELECT as_of_date, portfolio_id, aum_eur, eligible_eur, aligned_eur,
    {rnd("100.0 * eligible_eur / nullif(aum_eur, 0)", 6)} AS eligible_share_pct,
    {rnd("CASE WHEN eligible_eur > 0 THEN 100.0 * aligned_eur / eligible_eur ELSE 0.0 END", 6)}
      AS aligned_share_of_eligible_pct,
    {rnd("100.0 * aligned_eur / nullif(aum_eur, 0)", 6)} AS aligned_share_of_aum_pct
  FROM (SELECT fe.as_of_date, fe.portfolio_id, {xsum("fe.exposure_eur")} AS aum_eur,
          {xsum("fe.exposure_eur", "coalesce(t.taxonomy_eligible_share, 0.0)")} AS eligible_eur,
          {xsum("fe.exposure_eur", "coalesce(t.taxonomy_aligned_share, 0.0)")} AS aligned_eur
        FROM g_fe fe
        LEFT JOIN (SELECT * FROM s_taxonomy_data WHERE fiscal_year = {FY}) t ON fe.issuer_id = t.issuer_id
        GROUP BY 1, 2) a),
g_cov AS (
  SELECT *,
    CASE WHEN coverage_status = 'unmapped_issuer' THEN 'unmapped_issuer'
         WHEN coverage_status = 'orphan_provider' THEN 'orphan_provider'
         WHEN attribution_factor IS NULL THEN 'zero_or_missing_denominator'
         WHEN financed_emissions_tco2e IS NULL THEN 'missing_esg_data'
         ELSE 'mapped' END AS gap_cause
  FROM g_fe)"""


def _financed_report(asset_class: str, value_name: str) -> str:
    return f"""
  SELECT as_of_date, portfolio_id, issuer_id, issuer_name,
    {rsum("exposure_eur", 2)} AS {value_name},
    {rsum("financed_emissions_tco2e", 6)} AS financed_emissions_tco2e,
    {rnd("max(attribution_factor)", 10)} AS attribution_factor,
    {rnd("avg(pcaf_score)", 4)} AS pcaf_score,
    max(CASE WHEN financed_emissions_tco2e IS NOT NULL THEN 1 ELSE 0 END) AS has_emissions_flag
  FROM g_fe WHERE asset_class = '{asset_class}'
  GROUP BY as_of_date, portfolio_id, issuer_id, issuer_name"""


def _r09(coverage: str) -> str:
    return f"""
  SELECT gap_cause, row_count, market_value_eur,
    {rnd("100.0 * market_value_eur / nullif(total, 0)", 6)} AS share_of_aum_pct,
    {D} AS as_of_date
  FROM (SELECT gap_cause, count(*) AS row_count, {rsum("exposure_eur", 2)} AS market_value_eur
        FROM {coverage} GROUP BY gap_cause) c, (SELECT {xsum("exposure_eur")} AS total FROM {coverage}) t"""


REPORT_SQL = {
    "R01": _financed_report("listed_equity", "market_value_eur"),
    "R02": _financed_report("corporate_bond", "market_value_eur"),
    "R03": _financed_report("business_loan", "outstanding_eur"),
    "R04": """
  SELECT as_of_date, portfolio_id, asset_class, weighted_pcaf_score, coverage_pct, exposure_eur FROM g_dq""",
    "R05": """
  SELECT as_of_date, portfolio_id, waci_tco2e_per_m_eur, carbon_footprint_tco2e_per_m_eur,
    financed_emissions_tco2e, aum_eur,
    'WACI uses positions with emissions and revenue; footprint uses full AUM' AS coverage_note
  FROM g_ci""",
    "R06": f"""
  SELECT legal_entity, 'PAI1_ghg_emissions_tco2e' AS pai_indicator, pai1 AS pai_value, {D} AS as_of_date
  FROM (SELECT legal_entity, {rsum("financed_emissions_tco2e", 6)} AS pai1, {rsum("exposure_eur", 2)} AS aum
        FROM g_fe GROUP BY 1) e
  UNION ALL
  SELECT legal_entity, 'PAI2_carbon_footprint_tco2e_per_m_eur', {rnd("pai1 / nullif(aum / 1000000.0, 0)", 6)}, {D}
  FROM (SELECT legal_entity, {rsum("financed_emissions_tco2e", 6)} AS pai1, {rsum("exposure_eur", 2)} AS aum
        FROM g_fe GROUP BY 1) e
  UNION ALL
  SELECT p.legal_entity, 'PAI3_ghg_intensity_tco2e_per_m_eur',
    {rnd(f'{xsum("ci.waci_tco2e_per_m_eur", "ci.aum_eur")} / nullif({xsum("ci.aum_eur")}, 0)', 6)}, {D}
  FROM g_ci ci LEFT JOIN s_portfolios p ON ci.portfolio_id = p.portfolio_id
  GROUP BY p.legal_entity""",
    "R07": f"""
  SELECT as_of_date, portfolio_id, aum_eur, fossil_fuel_market_value_eur,
    {rnd("100.0 * fossil_fuel_market_value_eur / nullif(aum_eur, 0)", 6)} AS fossil_fuel_exposure_pct,
    flagged_exposure_eur,
    {rnd("100.0 * flagged_exposure_eur / nullif(aum_eur, 0)", 4)} AS flag_coverage_pct
  FROM (SELECT as_of_date, portfolio_id, {rsum("exposure_eur", 2)} AS aum_eur,
          {rsum("CASE WHEN fossil_fuel_flag = 1 THEN exposure_eur ELSE 0.0 END", 2)} AS fossil_fuel_market_value_eur,
          {xsum("CASE WHEN fossil_fuel_flag IS NOT NULL THEN exposure_eur ELSE 0.0 END")} AS flagged_exposure_eur
        FROM g_fe GROUP BY 1, 2) a""",
    "R08": """
  SELECT as_of_date, portfolio_id, eligible_share_pct, aligned_share_of_eligible_pct, aligned_share_of_aum_pct,
    aum_eur, 'SIMPLIFIED: issuer-level shares weighted by exposure; no turnover/CapEx split' AS simplification_note
  FROM g_ta""",
    "R09": _r09("g_cov"),
}


def prelude() -> str:
    silver = "".join("," + _clean_ctes(n) for n in CONTRACT)
    return "WITH " + LANDING_SQL.strip() + silver + "," + GOLD_SQL


def with_prelude(select: str) -> str:
    return prelude() + "\n" + select.strip()


def reject_details_sql(tables: list[str], fields: dict[str, str]) -> str:
    """Typed fields of rejected rows, and of the row that each duplicated key keeps."""
    parts = []
    for n in tables:
        keys, _, columns = CONTRACT[n]
        keys = keys.split()
        own = {c.partition(":")[0] for c in columns.split()}
        bkey = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
        some = ", ".join(f"CAST({c if c in own else 'NULL'} AS {'VARCHAR' if k == 'string' else k}) AS {c}" for c, k in fields.items())
        on = ", ".join(keys)
        parts.append(f"SELECT '{n}' AS source_table, _reason AS reject_reason, {bkey} AS business_key, {some} FROM x_{n} WHERE _reason IS NOT NULL")
        parts.append(
            f"SELECT '{n}', 'duplicate_key', {bkey}, {some} FROM s_{n} "
            f"SEMI JOIN (SELECT {on} FROM x_{n} WHERE _reason IS NULL GROUP BY {on} HAVING count(*) > 1) d USING ({on})"
        )
    return " UNION ALL ".join(parts)


# ---- ingest -------------------------------------------------------------------------------


def csv_ingest_sql(columns: dict[str, tuple[str, ...]]) -> str:
    """What the deliveries of ``queries.deliver_csv`` say."""
    parts = []
    for name, cols in columns.items():
        turned = f"CAST('0x' || substr(md5(coalesce({cols[0]}, '')), 1, 4) AS INT) % 2 = 1"
        last = f"CASE WHEN {turned} THEN 'null' ELSE coalesce({cols[-1]}, 'null') END"
        text = " || '|' || ".join([f"coalesce({c}, 'null')" for c in cols[:-1]] + [last])
        said = [
            ("malformed_line", ",".join(["long"] * (len(cols) + 1))),
            ("malformed_line", "short" + "," * (len(cols) - 2)),
            ("unknown_column", "delivered_by"),
            ("missing_column", cols[-1]),
        ]
        parts.append(f"SELECT '{name}' AS source_table, 'row' AS outcome, {text} AS content FROM l_{name}")
        parts += [f"SELECT '{name}', '{a}', '{b}'" for a, b in said]
    return " UNION ALL ".join(parts)


# ---- reconciliation -----------------------------------------------------------------------

def baseline_sql(report_id: str) -> str:
    """The planted baseline (see ``sources.driver.planted_baseline``)."""
    spec = specs.RECON_SPECS[report_id]
    keys, (v, *others) = ", ".join(spec.keys), spec.values
    key = "concat_ws('|', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in spec.keys) + ")"
    rest = "".join(f", CAST({o} AS DOUBLE) AS {o}" for o in others)
    one = ", ".join(f"'only in the baseline' AS {k}" for k in spec.keys)
    return f"""
  SELECT {keys}, CASE m WHEN 2 THEN CAST({v} AS DOUBLE) * 1.5 + 10.0 WHEN 3 THEN CAST('NaN' AS DOUBLE)
      WHEN 4 THEN NULL WHEN 5 THEN CAST({v} AS DOUBLE) + {spec.abs_tol / 2} ELSE CAST({v} AS DOUBLE) END AS {v}{rest}
  FROM (SELECT *, CAST('0x' || substr(md5({key}), 1, 4) AS INT) % 11 AS m FROM ({REPORT_SQL[report_id]}) r) p,
    (SELECT unnest([0, 1]) AS copy) c
  WHERE m <> 0 AND (copy = 0 OR m = 1)
  UNION ALL SELECT {one}, CAST(1 AS DOUBLE){"".join(", CAST(1 AS DOUBLE)" for _ in others)}"""


def _side_sql(sql: str, spec: specs.ReconSpec, tag: str) -> str:
    keys = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '') AS {k}" for k in spec.keys)
    vals = ", ".join(f"CAST({v} AS DOUBLE) AS {tag}_{v}" for v in spec.values)
    aggs = ", ".join(f"min({tag}_{v}) AS {tag}_{v}" for v in spec.values)
    group = ", ".join(spec.keys)
    return f"SELECT {group}, count(*) AS {tag}__n, {aggs} FROM (SELECT {keys}, {vals} FROM ({sql}) q) s GROUP BY {group}"


def _differs(spec: specs.ReconSpec, v: str) -> str:
    tol = f"greatest(CAST({spec.abs_tol} AS DOUBLE), CAST({spec.rel_tol} AS DOUBLE) * greatest(abs(b_{v}), 1.0))"
    close = f"NOT isnan(n_{v}) AND NOT isnan(b_{v}) AND abs(n_{v} - b_{v}) <= {tol}"
    return f"NOT ((n_{v} IS NULL AND b_{v} IS NULL) OR coalesce({close}, false))"


def compared_sql(report_id: str) -> str:
    spec = specs.RECON_SPECS[report_id]
    on = " AND ".join(f"n.{k} = b.{k}" for k in spec.keys)
    key_text = "concat_ws('|', " + ", ".join(f"coalesce(n.{k}, b.{k})" for k in spec.keys) + ")"
    values = ", ".join(f"n.n_{v}, b.b_{v}" for v in spec.values)
    return f"""SELECT *, CASE WHEN n__n IS NULL THEN 'missing_in_new' WHEN b__n IS NULL THEN 'missing_in_baseline'
      WHEN n__n > 1 OR b__n > 1 THEN 'duplicate_key'
      WHEN {' OR '.join(f'({_differs(spec, v)})' for v in spec.values)} THEN 'value_mismatch' END AS break_type
    FROM (SELECT '{report_id}' AS report_id, {key_text} AS key_text, n.n__n, b.b__n, {values}
      FROM ({_side_sql(REPORT_SQL[report_id], spec, 'n')}) n
      FULL OUTER JOIN ({_side_sql(baseline_sql(report_id), spec, 'b')}) b ON {on}) j"""


def breaks_sql(report_id: str) -> str:
    spec = specs.RECON_SPECS[report_id]
    none = "CAST(NULL AS VARCHAR) AS new_text, CAST(NULL AS VARCHAR) AS old_text"
    c = f"({compared_sql(report_id)}) c"
    parts = [
        f"""SELECT report_id, key_text, break_type, CAST(NULL AS VARCHAR) AS column_name,
          CAST(NULL AS DOUBLE) AS new_value, CAST(NULL AS DOUBLE) AS old_value, {none}
        FROM {c} WHERE break_type <> 'value_mismatch'"""
    ]
    parts += [
        f"""SELECT report_id, key_text, break_type, '{v}', n_{v}, b_{v}, NULL, NULL
        FROM {c} WHERE break_type = 'value_mismatch' AND ({_differs(spec, v)})"""
        for v in spec.values
    ]
    return " UNION ALL ".join(parts)


def recon_summary_sql(report_ids, expected_fail) -> str:
    parts = [
        f"""SELECT '{rid}' AS report_id, CAST(coalesce(sum(n__n), 0) AS BIGINT) AS rows_new,
          CAST(coalesce(sum(b__n), 0) AS BIGINT) AS rows_base, count_if(break_type IS NOT NULL) AS breaks
        FROM ({compared_sql(rid)}) c"""
        for rid in report_ids
    ]
    expected = ", ".join(f"'{r}'" for r in expected_fail)
    return f"""SELECT report_id, CASE WHEN breaks = 0 THEN 'PASS' ELSE 'FAIL' END AS status, rows_new, rows_base,
      breaks, CASE WHEN breaks = 0 THEN 'match' ELSE 'see breaking rows' END AS note,
      (breaks > 0 AND report_id NOT IN ({expected})) AS unexpected_fail
    FROM ({' UNION ALL '.join(parts)}) s"""


def top_breaks_sql(report_ids, n: int = 8) -> str:
    union = " UNION ALL ".join(breaks_sql(rid) for rid in report_ids)
    return f"""SELECT * FROM (
      SELECT *, dense_rank() OVER (PARTITION BY report_id ORDER BY key_text) AS break_rank FROM ({union}) u
    ) r WHERE break_rank <= {n}"""


def with_recon(select: str) -> str:
    return with_prelude(select)


# ---- row accounting -----------------------------------------------------------------------


def step_metrics_sql(tables) -> str:
    z = "CAST(0 AS BIGINT)"
    parts = []
    for t in tables:
        step = f"'silver.{t}'"
        parts += [
            f"SELECT {step} AS step, count(*) AS input_rows, {z} AS output_rows, {z} AS rejected_rows, "
            f"{z} AS duplicate_rows, {z} AS flagged_rows FROM l_{t}",
            f"SELECT {step}, {z}, count(*), {z}, {z}, {z} FROM s_{t}",
            f"SELECT {step}, {z}, {z}, "
            "CAST(coalesce(sum(CASE WHEN reject_reason <> 'duplicate_key' THEN rejected_rows END), 0) AS BIGINT), "
            "CAST(coalesce(sum(CASE WHEN reject_reason = 'duplicate_key' THEN rejected_rows END), 0) AS BIGINT), "
            f"{z} FROM rej_{t}",
        ]
    e = "'silver.entity_resolution'"
    g = "'gold.financed_emissions'"
    parts += [
        f"SELECT {e}, count(*), {z}, {z}, {z}, {z} FROM s_issuers",
        f"SELECT {e}, {z}, count(*), {z}, {z}, count_if(coverage_status <> 'mapped') FROM g_entity_map",
        f"SELECT {g}, count(*), {z}, {z}, {z}, {z} FROM s_holdings WHERE as_of_date = {D}",
        f"SELECT {g}, count(*), {z}, {z}, {z}, {z} FROM s_loans WHERE as_of_date = {D}",
        f"SELECT {g}, {z}, count(*), {z}, {z}, count_if(financed_emissions_tco2e IS NULL) FROM g_fe",
    ]
    sums = ", ".join(
        f"CAST(sum({m}) AS BIGINT) AS {m}"
        for m in ("input_rows", "output_rows", "rejected_rows", "duplicate_rows", "flagged_rows")
    )
    return f"SELECT step, {sums} FROM ({' UNION ALL '.join(parts)}) u GROUP BY step"


# ---- BY groups ----------------------------------------------------------------------------

BY_FLAGS_SQL = """
SELECT *,
  row_number() OVER full_sort AS by_number,
  count(*) OVER (PARTITION BY borrower_issuer_id, currency) AS by_rows,
  row_number() OVER head_sort = 1 AS first_borrower_issuer_id,
  row_number() OVER head_sort = count(*) OVER (PARTITION BY borrower_issuer_id) AS last_borrower_issuer_id,
  row_number() OVER full_sort = 1 AS first_currency,
  row_number() OVER full_sort = count(*) OVER (PARTITION BY borrower_issuer_id, currency) AS last_currency
FROM s_loans
WINDOW full_sort AS (PARTITION BY borrower_issuer_id, currency
    ORDER BY outstanding_amount NULLS FIRST, loan_id NULLS FIRST, as_of_date NULLS FIRST, loan_purpose NULLS FIRST),
  head_sort AS (PARTITION BY borrower_issuer_id
    ORDER BY currency NULLS FIRST, outstanding_amount NULLS FIRST, loan_id NULLS FIRST, as_of_date NULLS FIRST,
      loan_purpose NULLS FIRST)"""

MERGE_BY_SQL = """
SELECT k.issuer_id, k.by_number,
  f.fiscal_year AS financial_year, f.evic_eur, f.total_assets_eur, f.revenue_eur,
  t.fiscal_year AS taxonomy_year, t.taxonomy_eligible_share, t.taxonomy_aligned_share,
  f.n IS NOT NULL AS in_left, t.n IS NOT NULL AS in_right
FROM (SELECT issuer_id, unnest(range(1, max(n) + 1)) AS by_number,
        max(n) FILTER (side = 0) AS n_left, max(n) FILTER (side = 1) AS n_right
      FROM (SELECT issuer_id, 0 AS side, count(*) AS n FROM s_company_financials GROUP BY issuer_id
            UNION ALL SELECT issuer_id, 1, count(*) FROM s_taxonomy_data GROUP BY issuer_id) u
      GROUP BY issuer_id) k
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY issuer_id ORDER BY fiscal_year NULLS FIRST) AS n FROM s_company_financials) f
  ON f.issuer_id = k.issuer_id AND f.n = least(k.by_number, k.n_left)
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY issuer_id ORDER BY fiscal_year NULLS FIRST) AS n FROM s_taxonomy_data) t
  ON t.issuer_id = k.issuer_id AND t.n = least(k.by_number, k.n_right)"""
