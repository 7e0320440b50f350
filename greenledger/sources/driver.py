"""Driver tables (TPC-H-like parquet) projected onto the bank's ten source extracts.

The projection is deterministic and plants the defects the cleaners must
catch (padded and lower-case text, blank ids, null and negative amounts,
DATE9 text, an unparseable date format, missing FX rates, issuers missing
from the master, orphan crosswalk ids). Every extract is all-text, like the
CSV files it stands for, so the typing and parsing steps are exercised.
Column pruning reaches each parquet scan: only the columns used are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.sources.parallel import spread

# Reporting date of the driver data and the book that holds the loans.
AS_OF = "2000-12-31"
LOAN_PORTFOLIO = "FURNITURE"
# FX rates to EUR by currency, and holding / loan currencies by residue.
FX_TABLE = (("EUR", "1.0"), ("SEK", "0.087"), ("GBP", "1.18"), ("usd", "0.92"), ("USDT", "0.91"))
FX_ISO_TEXT = ("NOK", "0.085")  # delivered in ISO text, which the DATE9 parser rejects
HOLDING_CURRENCIES = ("EUR", "SEK", "GBP", "XXX")  # by l_suppkey % 4; XXX has no rate
LOAN_CURRENCIES = ("EUR", "GBP", "SEK")  # by o_orderkey % 3
EQUITY_PART_TYPES = ("PROMO", "ECONOMY", "SMALL")
ENTITY_A_SEGMENTS = ("BUILDING", "MACHINERY")
RATINGS = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC")  # by s_suppkey % 7
SOURCES_BY_RESIDUE = ("verified", "reported", "estimated")  # by s_suppkey % 3

DRIVER_TABLES = ("customer", "supplier", "part", "orders", "lineitem")
# The fact-sized table is spread on its key when under-split (columns pruned first); the loans
# extract is spread after projection, so the raw orders can still be broadcast where they are small.
SPREAD_KEYS = {"lineitem": "l_orderkey"}
SPREAD_COLUMNS = {
    "lineitem": (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    ),
}


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(col: Column) -> Column:
    return col.cast("string")


def _pick(residue: Column, values: tuple[str, ...]) -> Column:
    """values[residue] as a CASE expression."""
    expr = F.when(residue == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(residue == i, F.lit(v))
    return expr


def _year_end(ts: str) -> Column:
    return _text(F.make_date(F.year(ts), F.lit(12), F.lit(31)))


def _supplier_count(supplier: DataFrame) -> Column:
    """Scalar subquery: number of suppliers (issuer ids are keys modulo it)."""
    return supplier.select(F.count(F.lit(1))).scalar()


def portfolios(customer: DataFrame) -> DataFrame:
    seg = customer.select(F.col("c_mktsegment").alias("seg")).distinct()
    entity = F.when(F.col("seg") == "BUILDING", F.lit("ENTITY_A "))  # trailing blank
    entity = entity.when(F.col("seg").isin(*ENTITY_A_SEGMENTS), F.lit("ENTITY_A")).otherwise(F.lit("ENTITY_B"))
    return seg.select(
        F.col("seg").alias("portfolio_id"),
        F.lower("seg").alias("portfolio_name"),
        entity.alias("legal_entity"),
        F.when(F.col("seg") == LOAN_PORTFOLIO, F.lit("business_loans")).otherwise(F.lit("mixed")).alias(
            "asset_class_scope"
        ),
        F.lit("EUR").alias("currency"),
    )


def instruments(part: DataFrame, supplier: DataFrame) -> DataFrame:
    return part.select(
        _text(F.col("p_partkey")).alias("instrument_id"),
        F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" ")).alias("isin"),
        F.when(F.col("p_type").isin(*EQUITY_PART_TYPES), F.lit("equity"))
        .otherwise(F.lit("corporate_bond"))
        .alias("instrument_type"),
        _text(F.col("p_partkey") % _supplier_count(supplier)).alias("issuer_id"),
        F.lit("EUR").alias("currency"),
    )


def issuers(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.where(k % 25 != 24).select(
        _text(k).alias("issuer_id"),
        F.when(k % 9 == 2, F.lit("   ")).otherwise(F.concat(F.lit("LEI"), _text(k))).alias("lei"),
        F.concat(F.col("s_name"), F.lit("  ")).alias("issuer_name"),
        _text(F.col("s_nationkey")).alias("country"),
        F.concat(F.lit("C"), _text(F.col("s_nationkey") % 33)).alias("nace_sector"),
    )


def holdings(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    joined = li.join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    ).join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    currency = _pick(F.col("l_suppkey") % 4, HOLDING_CURRENCIES)
    return joined.select(
        F.col("c_mktsegment").alias("portfolio_id"),
        _text(F.col("l_partkey")).alias("instrument_id"),
        _year_end("l_shipdate").alias("as_of_date"),
        _text(F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_quantity") == 50, F.lit(None).cast("string"))
        .otherwise(_text(F.col("l_extendedprice")))
        .alias("market_value"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(currency, F.lit(" "))).otherwise(currency).alias("currency"),
        _text(F.col("l_orderkey")).alias("src_order_key"),
        _text(F.col("l_linenumber")).alias("src_line_no"),
    )


HOLDINGS_TIE_BREAKERS = (("src_order_key", "bigint"), ("src_line_no", "int"))


def loans(orders: DataFrame, supplier: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    amount = (
        F.when(k % 40 == 7, _text(-F.col("o_totalprice")))
        .when(k % 40 == 8, F.lit(None).cast("string"))
        .when(k % 40 == 9, F.lit("NaN"))
        .when(k % 40 == 10, F.lit("-Infinity"))
        .when(k % 1000 == 500, F.lit("2500000000000.5"))  # beyond 1e12
        .otherwise(_text(F.col("o_totalprice")))
    )
    currency = F.when(k % 40 == 12, F.lit("usd")).when(k % 40 == 13, F.lit("USDT"))
    delivered = orders.select(
        F.when(k % 40 == 11, F.lit("  ")).otherwise(_text(k)).alias("loan_id"),
        _text(F.col("o_custkey") % _supplier_count(supplier)).alias("borrower_issuer_id"),
        _year_end("o_orderdate").alias("as_of_date"),
        amount.alias("outstanding_amount"),
        currency.otherwise(_pick(k % 3, LOAN_CURRENCIES)).alias("currency"),
        F.col("o_orderpriority").alias("loan_purpose"),
        F.explode(F.when(k % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_later"),
    )
    # some loans are delivered for the next year-end too
    later = _text(F.add_months(F.col("as_of_date").cast("date"), 12))
    return delivered.withColumn(
        "as_of_date", F.when(F.col("_later") == 1, later).otherwise(F.col("as_of_date"))
    ).drop("_later")


def company_financials(lineitem: DataFrame) -> DataFrame:
    """Issuer size per supplier and ship year, summed exactly in decimal."""
    per_year = lineitem.groupBy(
        F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("y")
    ).agg(F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("v"))
    k, v = F.col("k"), F.col("v")
    return per_year.select(
        _text(k).alias("issuer_id"),
        _text(F.col("y")).alias("fiscal_year"),
        F.when(k % 5 == 1, F.lit("0")).otherwise(_text(v * 1000)).alias("evic_eur"),
        _text(v * 1500).alias("total_assets_eur"),
        _text(v * 100).alias("revenue_eur"),
    )


def vendor_emissions(supplier: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Vendor rows for the fiscal year, plus a prior year (scope 1 doubled) that the year filter must drop."""
    k = F.col("s_suppkey")
    year = int(as_of[:4])

    def for_year(fy: int, scale: int) -> DataFrame:
        return supplier.select(
            _text(k + 1_000_000).alias("provider_entity_id"),
            F.lit(str(fy)).alias("fiscal_year"),
            _text((k % 50 + 1) * 1000 * scale).alias("scope1_tco2e"),
            _text((k % 20 + 1) * 250).alias("scope2_tco2e"),
            F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(_text((k % 30 + 1) * 4000)).alias("scope3_tco2e"),
            _pick(k % 3, SOURCES_BY_RESIDUE).alias("emission_data_source"),
            F.when(k % 11 == 3, F.lit("  ")).otherwise(_pick(k % 7, RATINGS)).alias("esg_rating"),
            F.when(k % 6 == 2, F.lit("1")).otherwise(F.lit("0")).alias("fossil_fuel_flag"),
        )

    return for_year(year, 1).unionByName(for_year(year - 1, 2))


def taxonomy_data(supplier: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Shares of 14 decimals: the first one decides, the others are the same in both shares."""
    k = F.col("s_suppkey").cast("long")
    more = F.lpad(_text(k * 829348951 % 10**13), 13, "0")
    aligned = (
        F.when(k % 8 == 6, F.lit("0.95"))
        .when(k % 8 == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("0."), _text(F.floor(k % 10 / 2)), more))
    )
    return supplier.select(
        _text(k).alias("issuer_id"),
        F.lit(as_of[:4]).alias("fiscal_year"),
        F.concat(F.lit("0."), _text(k % 10), more).alias("taxonomy_eligible_share"),
        aligned.alias("taxonomy_aligned_share"),
    )


def fx_rates(orders: DataFrame) -> DataFrame:
    """Year-end rates for every order year, DATE9 text (one currency in ISO text)."""
    years = orders.select(_text(F.year("o_orderdate")).alias("y")).distinct()
    frames = [
        years.select(
            F.lit(cur).alias("currency"), F.concat(F.lit("31dec"), F.col("y")).alias("as_of_date"), F.lit(rate).alias("rate_to_eur")
        )
        for cur, rate in FX_TABLE
    ]
    cur, rate = FX_ISO_TEXT
    frames.append(
        years.select(
            F.lit(cur).alias("currency"), F.concat(F.col("y"), F.lit("-12-31")).alias("as_of_date"), F.lit(rate).alias("rate_to_eur")
        )
    )
    return reduce(DataFrame.unionByName, frames)


def crosswalk(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    provider = (
        F.when(k % 7 == 5, F.lit("-1"))  # vendor id that does not exist: orphan
        .when(k % 49 == 6, F.lit("  "))  # blank id: unmapped after cleaning
        .otherwise(_text(k + 1_000_000))
    )
    return supplier.where(k % 7 != 3).select(_text(k).alias("issuer_id"), provider.alias("provider_entity_id"))


def planted_baseline(report: DataFrame, spec) -> DataFrame:
    """A baseline for ``report`` that breaks in every way, by four hex digits of the key's MD5 modulo 11.

    0: key missing; 1: key twice; 2: first value out of tolerance; 3: first value NaN; 4: first value
    missing; 5: first value off by half the absolute tolerance (no break). One further key is extra.
    """
    value = spec.values[0]
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in spec.keys])
    m = F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("int") % 11
    old = F.col(value).cast("double")
    changed = (
        F.when(F.col("_m") == 2, old * 1.5 + 10.0)
        .when(F.col("_m") == 3, F.lit(float("nan")))
        .when(F.col("_m") == 4, F.lit(None).cast("double"))
        .when(F.col("_m") == 5, old + spec.abs_tol / 2)
        .otherwise(old)
    )
    copies = F.explode(F.when(F.col("_m") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = report.select(*spec.keys, *spec.values).withColumn("_m", m).where(F.col("_m") != 0)
    rows = rows.withColumn(value, changed).select(*spec.keys, *spec.values, copies.alias("_copy")).drop("_copy")
    extra = report.sparkSession.range(1).select(
        *[F.lit("only in the baseline").alias(k) for k in spec.keys], *[F.lit(1.0).alias(v) for v in spec.values]
    )
    return rows.unionByName(extra)


class LandingExtracts(Mapping):
    """The ten source extracts, each built on first access (plans are not free to build)."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self._spark, self._dir, self._as_of = spark, sf_dir, as_of
        self._tables: dict[str, DataFrame] = {}
        self._frames: dict[str, DataFrame] = {}
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "portfolios": lambda: portfolios(self._t("customer")),
            "instruments": lambda: instruments(self._t("part"), self._t("supplier")),
            "issuers": lambda: issuers(self._t("supplier")),
            "holdings": lambda: holdings(self._t("lineitem"), self._t("orders"), self._t("customer")),
            "loans": lambda: spread(loans(self._t("orders"), self._t("supplier")), "loan_id"),
            "company_financials": lambda: company_financials(self._t("lineitem")),
            "vendor_emissions": lambda: vendor_emissions(self._t("supplier"), self._as_of),
            "taxonomy_data": lambda: taxonomy_data(self._t("supplier"), self._as_of),
            "fx_rates": lambda: fx_rates(self._t("orders")),
            "crosswalk": lambda: crosswalk(self._t("supplier")),
        }

    def _t(self, name: str) -> DataFrame:
        if name not in self._tables:
            df = read_driver(self._spark, self._dir, name)
            if name in SPREAD_KEYS:
                df = spread(df.select(*SPREAD_COLUMNS[name]), SPREAD_KEYS[name])
            self._tables[name] = df
        return self._tables[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name]()
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def landing_extracts(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> LandingExtracts:
    """The ten source extracts (all text) projected from the driver tables, built lazily."""
    return LandingExtracts(spark, sf_dir, as_of)
