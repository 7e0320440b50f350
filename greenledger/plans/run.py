"""Batch run that writes every layer once: bronze -> silver (+ ledger) -> gold -> reports -> reconciliation.

Each layer is written to the table store and read back by the next one, so
lineage is cut at every layer (a lost executor recomputes from the last
written table, never from the landing files) and each table is computed
exactly once even though nine reports read the gold fact. Row counts ride
along each write as observed metrics (no extra pass) and are written as a
``run_metrics`` table. Position-grain tables are partitioned by as-of date
so later runs and readers prune to one date.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from greenledger.operators import metrics, recon
from greenledger.operators.emissions import FINANCED_EMISSIONS_COLUMNS, TAXONOMY_ATTRS, open_projection
from greenledger.operators.positions import with_legal_entity
from greenledger.operators.quality import reject_ledger
from greenledger.operators.routing import Sink, route
from greenledger.plans import specs
from greenledger.plans.pipeline import REPORT_IDS, SEEDED_DIFFERENCES, Book
from greenledger.sources.tables import TableStore, write_report_csv

# One row per gap cause, so five rows at most.
SINGLE_FILE_REPORTS = ("R09",)
# Gold tables that hold a date per run: a run leaves the other dates alone.
ONE_DATE = {"partition_by": ("as_of_date",), "only_partitions": True}
# Tables with a date column worth partitioning on.
DATE_PARTITIONED = {"holdings": ("as_of_date",), "loans": ("as_of_date",)}


def _write_observed(df: DataFrame, store: TableStore, layer: str, table: str, step: str, **kw) -> tuple[DataFrame, dict]:
    observed, obs = metrics.observe_step(df, step)
    store.write(observed, layer, table, **kw)
    return store.read(df.sparkSession, layer, table), {"step": step, "output_rows": obs.get.get("rows", 0)}


def _sink(store: TableStore, layer: str) -> Sink:
    """Routed tables stand in the layer of their source: those of a vendor's data stay restricted."""

    def write(df: DataFrame, name: str, partition_by: tuple[str, ...]) -> DataFrame:
        path = store.write(df, layer, f"_{name}", partition_by=partition_by)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return write


def run_batch(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    store: TableStore,
    as_of: str,
    loan_portfolio: str,
    clean_specs: Mapping[str, specs.CleanSpec] | None = None,
    baselines: TableStore | None = None,
    report_csv_dir: str | None = None,
) -> DataFrame:
    """Run the whole book for one as-of date into ``store``; returns the run metrics table."""
    book = Book(spark, bronze, as_of, loan_portfolio, dict(clean_specs or {}))
    log: list[dict] = []

    # bronze: landing as delivered, audit columns kept; vendor data stays in the restricted layer
    written_bronze = {}
    for name, spec in book.clean_specs.items():
        layer = "restricted" if spec.restricted else "bronze"
        written_bronze[name], entry = _write_observed(bronze[name], store, layer, f"bronze_{name}", f"bronze.{name}")
        log.append(entry)

    # silver: one routed pass per source, then clean rows (partitioned by date where it has one) and the reject ledger
    silver_book = Book(spark, written_bronze, as_of, loan_portfolio, dict(clean_specs or {}))
    layers = {name: "restricted" if spec.restricted else "silver" for name, spec in silver_book.clean_specs.items()}
    silver_book.pin_routed(
        {name: route(written_bronze[name], spec, _sink(store, layers[name])) for name, spec in silver_book.clean_specs.items()}
    )
    clean = {}
    for name in silver_book.clean_specs:
        clean[name], entry = _write_observed(
            silver_book.silver(name), store, layers[name], name, f"silver.{name}", partition_by=DATE_PARTITIONED.get(name, ())
        )
        log.append(entry)
    # rejected rows of a restricted source stay restricted: their details are the vendor's data
    ledgers = {"silver": [], "restricted": []}
    for name, layer in layers.items():
        ledgers[layer].append(silver_book.rejects(name))
    for layer, parts in ledgers.items():
        if parts:
            _, entry = _write_observed(reject_ledger(parts), store, layer, "_rejects", f"{layer}._rejects")
            log.append(entry)

    # gold: entity map, then the fact (written once, read by every mart and report)
    gold_book = Book(spark, {}, as_of, loan_portfolio, dict(clean_specs or {}))
    gold_book.pin_silver(clean)
    emap, entry = _write_observed(gold_book.entity_map, store, "silver", "issuer_entity_map", "silver.entity_map")
    log.append(entry)
    gold_book.pin(entity_map=emap)
    fact = with_legal_entity(gold_book.fact, clean["portfolios"]).select(*FINANCED_EMISSIONS_COLUMNS, *TAXONOMY_ATTRS)
    # the full fact carries vendor data: restricted layer; the open gold table is its projection
    fact, entry = _write_observed(
        fact, store, "restricted", "financed_emissions_full", "gold.financed_emissions", **ONE_DATE
    )
    log.append(entry)
    store.write(open_projection(fact), "gold", "financed_emissions", **ONE_DATE)
    gold_book.pin(fact=fact.where(F.col("as_of_date") == F.lit(as_of).cast("date")))

    marts_out = {
        "pcaf_data_quality": gold_book.data_quality,
        "carbon_intensity": gold_book.carbon_intensity,
        "taxonomy_alignment": gold_book.taxonomy_alignment,
    }
    written = {}
    for table, df in marts_out.items():
        written[table], entry = _write_observed(df, store, "gold", table, f"gold.{table}")
        log.append(entry)
    coverage = open_projection(gold_book.coverage)
    written["coverage"], entry = _write_observed(
        coverage, store, "gold", "coverage", "gold.coverage", **ONE_DATE
    )
    log.append(entry)
    gold_book.pin(
        data_quality=written["pcaf_data_quality"],
        carbon_intensity=written["carbon_intensity"],
        taxonomy_alignment=written["taxonomy_alignment"],
        coverage=written["coverage"].where(F.col("as_of_date") == F.lit(as_of).cast("date")),
    )

    # reports: gold table + CSV (written by the executors), then reconciliation
    written_reports = {}
    for rid in REPORT_IDS:
        written_reports[rid], entry = _write_observed(gold_book.report(rid), store, "gold", rid.lower(), f"report.{rid}")
        log.append(entry)
        if report_csv_dir:
            # only the report by gap cause has a bounded number of rows and so a single file
            single = rid in SINGLE_FILE_REPORTS
            write_report_csv(written_reports[rid], f"{report_csv_dir.rstrip('/')}/{rid}", single_file=single)
    if baselines is not None:
        pairs, missing = {}, []
        for rid in REPORT_IDS:
            try:
                pairs[rid] = (written_reports[rid], baselines.read(spark, "gold", rid.lower()))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                missing.append(recon.missing_baseline(rid, written_reports[rid], SEEDED_DIFFERENCES))
        parts = [recon.recon_summary(pairs, specs.RECON_SPECS, SEEDED_DIFFERENCES, skip_equal=True)] if pairs else []
        summary = reduce(DataFrame.unionByName, parts + missing)
        store.write(summary, "gold", "recon_summary")

    run_metrics = spark.createDataFrame(
        [(e["step"], int(e["output_rows"])) for e in log], "step string, output_rows bigint"
    )
    store.write(run_metrics, "gold", "run_metrics")
    return store.read(spark, "gold", "run_metrics")
