"""Registered queries over the driver tables: Spark callables and their SQL twins.

Every query reads the whole driver tables of ``sf_dir`` (through the domain
projection in :mod:`greenledger.sources.driver`) and returns a DataFrame;
nothing is collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.operators.by_groups import by_flags, merge_by
from greenledger.operators.emissions import TAXONOMY_ATTRS, VENDOR_ATTRS, open_projection
from greenledger.operators.quality import DUPLICATE_KEY, detail, reject_counts
from greenledger.plans import oracle
from greenledger.plans.driver_book import driver_book
from greenledger.plans.incremental import refresh_dates
from greenledger.session import checkpoint_dir
from greenledger.sources import driver
from greenledger.sources.extracts import MALFORMED, ingest_delivery, ingest_table
from greenledger.sources.tables import TableStore, materialize, materialize_all, read_report_csv, write_report_csv
from greenledger.plans.pipeline import REPORT_IDS, SEEDED_DIFFERENCES
from greenledger.plans.specs import RECON_SPECS, SOURCES

Query = Callable[[SparkSession, str], DataFrame]
SPECS = {spec.name: spec for spec in SOURCES}

CLEAN_QUERIES = {
    "clean_portfolios": "portfolios",
    "clean_instruments": "instruments",
    "clean_issuers": "issuers",
    "clean_holdings": "holdings",
    "clean_loans": "loans",
    "clean_financials": "company_financials",
    "clean_vendor": "vendor_emissions",
    "clean_taxonomy": "taxonomy_data",
    "clean_fx_date9": "fx_rates",
    "clean_crosswalk": "crosswalk",
}
REPORT_QUERIES = {
    "r01_equity": "R01",
    "r02_bonds": "R02",
    "r03_loans": "R03",
    "r04_quality": "R04",
    "r05_waci": "R05",
    "r06_pai": "R06",
    "r07_fossil": "R07",
    "r08_taxonomy": "R08",
    "r09_coverage": "R09",
}


def _silver(table: str) -> Query:
    return lambda spark, sf_dir: driver_book(spark, sf_dir).silver(table)


def _report(report_id: str) -> Query:
    return lambda spark, sf_dir: driver_book(spark, sf_dir).report(report_id)


def _attr(name: str) -> Query:
    return lambda spark, sf_dir: getattr(driver_book(spark, sf_dir), name)


def _routed_book(spark: SparkSession, sf_dir: str):
    """Ledger and row accounting read every source after one routed pass, which types it once."""
    return driver_book(spark, sf_dir).with_routed_sources()


def reject_ledger_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(_routed_book(spark, sf_dir).reject_ledger)


def reject_ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ledger entry (the row JSON is left out: number formatting is engine-specific)."""
    return _routed_book(spark, sf_dir).reject_ledger.drop("details")


#: Fields that reject_details takes out of the ledger, with their types.
DETAILS = {
    "outstanding_amount": "double",
    "market_value": "double",
    "taxonomy_eligible_share": "double",
    "taxonomy_aligned_share": "double",
    "rate_to_eur": "double",
    "fiscal_year": "int",
    "src_line_no": "int",
    "as_of_date": "date",
    "currency": "string",
}


def reject_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ledger entry with typed fields of the row it speaks of (of a duplicated key: of the row kept)."""
    ledger = _routed_book(spark, sf_dir).reject_ledger
    fields = [detail(c, kind).alias(c) for c, kind in DETAILS.items()]
    return ledger.select("source_table", "reject_reason", "business_key", *fields)


def duplicates_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _routed_book(spark, sf_dir).reject_ledger
    return (
        ledger.where(F.col("reject_reason") == DUPLICATE_KEY)
        .groupBy("source_table")
        .agg(F.count(F.lit(1)).alias("duplicate_keys"), F.sum("rejected_rows").alias("rows_dropped"))
    )


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _silver(table) for name, table in CLEAN_QUERIES.items()}
    out["reject_ledger"] = reject_ledger_counts
    out["reject_ledger_rows"] = reject_ledger_rows
    out["reject_details"] = reject_details
    out["duplicates_dropped"] = duplicates_dropped
    out["entity_map"] = _attr("entity_map")
    out["positions_eur"] = _attr("positions")
    out["financed_emissions"] = _attr("financed_emissions")
    out["fact_refreshed"] = fact_refreshed
    out["financed_emissions_open"] = lambda spark, sf_dir: open_projection(driver_book(spark, sf_dir).financed_emissions)
    out["data_quality"] = _attr("data_quality")
    out["carbon_intensity"] = _attr("carbon_intensity")
    out["taxonomy_alignment"] = _attr("taxonomy_alignment")
    out["coverage_gaps"] = _attr("coverage_table")
    out.update({name: _report(rid) for name, rid in REPORT_QUERIES.items()})
    out["step_metrics"] = lambda spark, sf_dir: _routed_book(spark, sf_dir).step_metrics()
    out["by_group_flags"] = loan_flags
    out["merge_by_issuer"] = merged_issuers
    out["audit_ingest"] = audit_ingest
    out["csv_roundtrip"] = csv_roundtrip
    out["csv_ingest"] = csv_ingest
    out["table_store"] = table_store
    out["table_store_dates"] = table_store_dates
    out["recon_breaks"] = recon_breaks
    out["recon_bucket_summary"] = recon_bucket_summary
    out["recon_summary"] = lambda spark, sf_dir: _recon(spark, sf_dir, lambda book, base: book.recon_summary(base))
    out["recon_top_breaks"] = lambda spark, sf_dir: _recon(spark, sf_dir, lambda book, base: book.top_breaks(base, 8))
    return out


def loan_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean loans by borrower and currency, the smallest amount first: numbers, first. and last. of both."""
    loans = driver_book(spark, sf_dir).silver("loans")
    return by_flags(loans, ("borrower_issuer_id", "currency"), ("outstanding_amount", "loan_id"))


def merged_issuers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match-merge of issuers' financial years with their taxonomy years."""
    book = driver_book(spark, sf_dir)
    years = book.silver("company_financials").withColumnRenamed("fiscal_year", "financial_year")
    shares = book.silver("taxonomy_data").withColumnRenamed("fiscal_year", "taxonomy_year")
    return merge_by(years, shares, ("issuer_id",), ("financial_year",), ("taxonomy_year",))


def audit_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ingest of one delivered file with its audit columns (load time left out: it is the clock)."""
    return ingest_table(spark, f"{sf_dir.rstrip('/')}/customer.parquet", driver.AS_OF).drop("_ingested_at")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R01 written by the report CSV sink into the shared checkpoint folder, then read back with its schema."""
    report = driver_book(spark, sf_dir).report("R01")
    path = f"{checkpoint_dir(spark).rstrip('/')}/report-csv/{uuid.uuid4().hex}/R01"
    write_report_csv(report, path)
    return read_report_csv(spark, path, report.schema)


def deliver_csv(spark: SparkSession, sf_dir: str, base: str) -> dict[str, str]:
    """All ten extracts as CSV under ``base``, in files that a bank's systems might send; path per source.

    By a hash of the key, rows come in the contract's order, or in reverse order with a column more and
    without the last one; a third file has a line that is too long and one that is too short.
    """
    paths = {}
    extracts = driver.landing_extracts(spark, sf_dir)
    # joined and shuffled once for both layouts
    written = materialize_all({name: extract.select(*SPECS[name].columns) for name, extract in extracts.items()})
    for name, extract in written.items():
        spec = SPECS[name]
        paths[name] = f"{base}/{name}"
        rows = extract.withColumn("_hash", F.substring(F.md5(F.coalesce(spec.columns[0], F.lit(""))), 1, 4))
        turned = F.conv("_hash", 16, 10).cast("int") % 2 == 1
        as_is = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.where(~turned).select(*spec.columns).write.options(**as_is).csv(f"{paths[name]}/plain")
        other = [F.col(c).alias(f" {c.upper()} ") for c in reversed(spec.columns[:-1])]
        rows.where(turned).select(F.lit("x").alias("delivered_by"), *other).write.options(**as_is).csv(f"{paths[name]}/turned")
        lines = [",".join(spec.columns), ",".join(["long"] * (len(spec.columns) + 1)), "short" + "," * (len(spec.columns) - 2)]
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{paths[name]}/torn")
    return paths


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten extracts read back from CSV files with headers of their own: rows as text, torn lines, header findings."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/extract-csv/{uuid.uuid4().hex}"
    parts = []
    for name, path in deliver_csv(spark, sf_dir, base).items():
        rows, findings = ingest_delivery(spark, f"{path}/*", name, SPECS[name].columns, driver.AS_OF)
        whole = F.concat_ws("|", *[F.coalesce(c, F.lit("null")) for c in SPECS[name].columns])
        torn = F.col(MALFORMED).isNotNull()
        outcome = F.when(torn, F.lit("malformed_line")).otherwise(F.lit("row"))
        parts.append(
            rows.select(
                F.lit(name).alias("source_table"), outcome.alias("outcome"), F.when(torn, F.col(MALFORMED)).otherwise(whole).alias("content")
            )
        )
        column = F.get_json_object("details", "$.column").alias("content")
        parts.append(findings.select("source_table", F.col("reject_reason").alias("outcome"), column).distinct())
    return reduce(DataFrame.unionByName, parts)


def table_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean holdings overwritten in the table store by date, then one date read back."""
    return table_store_dates(spark, sf_dir).where(F.col("as_of_date") == F.lit(driver.AS_OF).cast("date"))


def table_store_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean holdings overwritten in the table store by date, then every date read back."""
    store = TableStore(f"{checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}")
    store.write(driver_book(spark, sf_dir).silver("holdings"), "silver", "holdings", partition_by=("as_of_date",))
    return store.read(spark, "silver", "holdings")


def fact_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open fact after a late correction: first computed without loans and with a rate missing, then refreshed."""
    store = TableStore(f"{checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}")
    book = driver_book(spark, sf_dir)
    silver = {name: materialize(book.silver(name), name) for name in book.clean_specs}
    late = {"loans": silver["loans"].limit(0), "fx_rates": silver["fx_rates"].where("currency <> 'USD'")}
    for tables in ({**silver, **late}, silver):
        refresh_dates(spark, tables, store, [driver.AS_OF], driver.LOAN_PORTFOLIO)
    return store.read(spark, "gold", "financed_emissions").drop(*TAXONOMY_ATTRS)


def _gold_book(spark: SparkSession, sf_dir: str):
    """Reconciliation reads a written gold fact (as a production run does), not 18 inlined pipelines."""
    return driver_book(spark, sf_dir).with_materialized_fact()


def recon_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every break of every report against its baseline."""
    return _recon(
        spark, sf_dir, lambda book, base: reduce(DataFrame.unionByName, [book.breaks(r, b) for r, b in base.items()])
    )


def recon_bucket_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary again, comparing only the key buckets whose digests differ."""
    return _recon(spark, sf_dir, lambda book, base: book.recon_summary(base, skip_equal=True))


def _recon(spark: SparkSession, sf_dir: str, build: Callable) -> DataFrame:
    """Reconcile every report, written, with the baseline planted in the driver data, written before."""
    book = _gold_book(spark, sf_dir)
    for r, written in materialize_all({r: book.report(r) for r in REPORT_IDS}).items():
        book.pin_report(r, written)
    planted = materialize_all(
        {f"{r}-baseline": driver.planted_baseline(book.report(r), RECON_SPECS[r]) for r in REPORT_IDS}
    )
    return build(book, {r: planted[f"{r}-baseline"] for r in REPORT_IDS})


def _rejects_union() -> str:
    return " UNION ALL ".join(f"SELECT * FROM rej_{t}" for t in CLEAN_QUERIES.values())


def oracle_sql() -> dict[str, str]:
    w = oracle.with_prelude
    out = {name: w(f"SELECT * FROM s_{table}") for name, table in CLEAN_QUERIES.items()}
    out["reject_ledger"] = w(
        f"""SELECT source_table, reject_reason, count(*) AS ledger_entries,
              CAST(sum(rejected_rows) AS BIGINT) AS rejected_rows
            FROM ({_rejects_union()}) r GROUP BY 1, 2"""
    )
    out["reject_ledger_rows"] = w(f"SELECT * FROM ({_rejects_union()}) r")
    out["reject_details"] = w(oracle.reject_details_sql(list(CLEAN_QUERIES.values()), DETAILS))
    out["duplicates_dropped"] = w(
        f"""SELECT source_table, count(*) AS duplicate_keys, CAST(sum(rejected_rows) AS BIGINT) AS rows_dropped
            FROM ({_rejects_union()}) r WHERE reject_reason = 'duplicate_key' GROUP BY 1"""
    )
    out["entity_map"] = w("SELECT * FROM g_entity_map")
    out["positions_eur"] = w("SELECT * FROM g_positions")
    out["financed_emissions"] = w("SELECT * FROM g_fe")
    vendor_cols = ", ".join(VENDOR_ATTRS)
    out["financed_emissions_open"] = w(f"SELECT * EXCLUDE ({vendor_cols}) FROM g_fe")
    out["fact_refreshed"] = out["financed_emissions_open"]
    out["data_quality"] = w("SELECT * FROM g_dq")
    out["carbon_intensity"] = w("SELECT * FROM g_ci")
    out["taxonomy_alignment"] = w("SELECT * FROM g_ta")
    out["coverage_gaps"] = w("SELECT * FROM g_cov")
    out.update({name: w(oracle.REPORT_SQL[rid]) for name, rid in REPORT_QUERIES.items()})
    out["step_metrics"] = w(oracle.step_metrics_sql(list(CLEAN_QUERIES.values())))
    out["by_group_flags"] = w(oracle.BY_FLAGS_SQL)
    out["merge_by_issuer"] = w(oracle.MERGE_BY_SQL)
    out["audit_ingest"] = (
        f"SELECT *, 'customer.parquet' AS _source_file, 'batch-{driver.AS_OF}' AS _batch_id FROM customer"
    )
    out["csv_roundtrip"] = w(oracle.REPORT_SQL["R01"])
    out["csv_ingest"] = w(oracle.csv_ingest_sql({name: SPECS[name].columns for name in CLEAN_QUERIES.values()}))
    out["table_store"] = w(f"SELECT * FROM s_holdings WHERE as_of_date = {oracle.D}")
    out["table_store_dates"] = w("SELECT * FROM s_holdings")
    r = oracle.with_recon
    out["recon_breaks"] = r(" UNION ALL ".join(oracle.breaks_sql(rid) for rid in REPORT_IDS))
    out["recon_summary"] = r(oracle.recon_summary_sql(REPORT_IDS, SEEDED_DIFFERENCES))
    out["recon_bucket_summary"] = out["recon_summary"]
    out["recon_top_breaks"] = r(oracle.top_breaks_sql(REPORT_IDS, 8))
    return out


assert set(REPORT_QUERIES.values()) == set(REPORT_IDS)
