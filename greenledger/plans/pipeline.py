"""The batch plan: landing extracts -> silver -> gold -> nine reports.

``Book`` wires the operators lazily: every attribute is a DataFrame whose
plan goes back to the landing extracts, so Catalyst sees (and prunes,
pushes down and reuses exchanges across) the whole chain. ``materialize``
runs the same plan layer by layer into a table store, which is what a
cluster run does: each layer is written once and re-read, cutting lineage
so a lost executor only recomputes from the last written layer.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from greenledger.functions.pcaf import BUSINESS_LOAN, MAPPED, asset_class_of
from greenledger.operators import marts, metrics, recon, reports
from greenledger.operators.emissions import FINANCED_EMISSIONS_COLUMNS, financed_emissions
from greenledger.operators.joins import heavy_hitters
from greenledger.operators.positions import positions_in_eur, with_legal_entity
from greenledger.operators.quality import clean_counts, clean_rows, ledger_rows, reject_ledger, typed_frame
from greenledger.operators.resolve import resolve_entities
from greenledger.operators.routing import Routed, route_all
from greenledger.plans import specs
from greenledger.sources.tables import materialize


# Columns of the fact that the marts and reports read.
REPORT_FACT_COLUMNS = (
    "as_of_date",
    "portfolio_id",
    "issuer_id",
    "issuer_name",
    "asset_class",
    "exposure_eur",
    "revenue_eur",
    "coverage_status",
    "fossil_fuel_flag",
    "attribution_factor",
    "issuer_emissions_tco2e",
    "financed_emissions_tco2e",
    "pcaf_score",
    "taxonomy_eligible_share",
    "taxonomy_aligned_share",
)
# The two reports whose legacy baseline is known to differ.
SEEDED_DIFFERENCES = ("R01", "R09")


class Book:
    """All layers for one as-of date, built on demand from the landing extracts."""

    def __init__(
        self,
        spark: SparkSession,
        extracts: Mapping[str, DataFrame],
        as_of: str,
        loan_portfolio: str,
        clean_specs: dict[str, specs.CleanSpec] | None = None,
        materialize_fact: bool = False,
    ):
        self.spark = spark
        self.extracts = extracts
        self.as_of = as_of
        self.fiscal_year = int(as_of[:4])
        self.loan_portfolio = loan_portfolio
        self.clean_specs = {s.name: s for s in specs.SOURCES}
        self.clean_specs.update(clean_specs or {})
        self.materialize_fact = materialize_fact
        self._typed_cache: dict[str, DataFrame] = {}
        self._silver_cache: dict[str, DataFrame] = {}
        self._report_cache: dict[str, DataFrame] = {}
        self._written: dict[str, DataFrame] = {}
        self._routed: dict[str, Routed] = {}

    def with_materialized_fact(self) -> Book:
        """A book sharing this one's silver plans whose fact is written once and read back."""
        other = Book(self.spark, self.extracts, self.as_of, self.loan_portfolio, self.clean_specs, True)
        other._typed_cache = self._typed_cache
        other._silver_cache = self._silver_cache
        if "entity_map" in self.__dict__:
            other.pin(entity_map=self.__dict__["entity_map"])
        return other

    def with_routed_sources(self) -> Book:
        """A book over this one's extracts, each typed and judged once and written by outcome."""
        other = Book(self.spark, {}, self.as_of, self.loan_portfolio, self.clean_specs, self.materialize_fact)
        other.pin_routed(route_all(self.extracts, self.clean_specs))
        return other

    def pin_routed(self, routed: Mapping[str, Routed]) -> None:
        """Use sources after their routed pass: clean rows, ledger and counts read those tables."""
        self._routed.update(routed)
        self._silver_cache.update({name: r.clean() for name, r in routed.items()})

    def pin(self, **frames: DataFrame) -> None:
        """Use already-written tables for derived layers (``entity_map=``, ``fact=``, ...)."""
        for name, df in frames.items():
            self.__dict__[name] = df  # cached_property reads the instance dict first

    def pin_silver(self, tables: Mapping[str, DataFrame]) -> None:
        """Use already-written clean tables instead of cleaning the extracts; their hot keys are counted."""
        self._silver_cache.update(tables)
        self._written.update(tables)

    def _heavy(self) -> dict[str, DataFrame]:
        """Heavy hitters of the join keys of written tables (a lazy plan is not run twice to count its keys)."""
        keys = {"holdings": "instrument_id", "loans": "borrower_issuer_id", "instruments": "issuer_id"}
        found = {t: heavy_hitters(self._written[t], k) for t, k in keys.items() if t in self._written}
        if "loans" in found:
            found["loans"] = found["loans"].withColumnRenamed("borrower_issuer_id", "issuer_id")
        return found

    # ---- silver -------------------------------------------------------------
    def _typed(self, name: str) -> DataFrame:
        if name not in self._typed_cache:
            self._typed_cache[name] = typed_frame(self.extracts[name], self.clean_specs[name])
        return self._typed_cache[name]

    def silver(self, name: str) -> DataFrame:
        """Clean rows of one source (built on first use)."""
        if name not in self._silver_cache:
            self._silver_cache[name] = clean_rows(self._typed(name), self.clean_specs[name])
        return self._silver_cache[name]

    def rejects(self, name: str) -> DataFrame:
        """Ledger rows of one source."""
        if name in self._routed:
            return self._routed[name].ledger()
        return ledger_rows(self._typed(name), self.clean_specs[name])

    @cached_property
    def reject_ledger(self) -> DataFrame:
        return reject_ledger([self.rejects(name) for name in self.clean_specs])

    @cached_property
    def entity_map(self) -> DataFrame:
        return resolve_entities(
            self.silver("issuers"), self.silver("crosswalk"), self.silver("vendor_emissions"), self.fiscal_year
        )

    # ---- gold ---------------------------------------------------------------
    @cached_property
    def positions(self) -> DataFrame:
        return positions_in_eur(
            self.silver("holdings"),
            self.silver("instruments"),
            self.silver("loans"),
            self.silver("fx_rates"),
            self.silver("portfolios"),
            self.as_of,
            self.loan_portfolio,
        )

    @cached_property
    def fact(self) -> DataFrame:
        """Financed emissions at portfolio level plus the taxonomy shares (full width, lazy plan)."""
        return self._fact(self.silver("holdings"))

    def _fact(self, holdings: DataFrame) -> DataFrame:
        return financed_emissions(
            holdings,
            self.silver("instruments"),
            self.silver("loans"),
            self.silver("fx_rates"),
            None,
            self.silver("company_financials"),
            self.entity_map,
            self.silver("vendor_emissions"),
            self.as_of,
            self.loan_portfolio,
            taxonomy=self.silver("taxonomy_data"),
            heavy=self._heavy(),
        )

    @cached_property
    def report_fact(self) -> DataFrame:
        """What the marts and reports read.

        With ``materialize_fact`` only the columns they use are written, once,
        as a table in the shared checkpoint folder (lineage cut, survives lost
        executors) and every consumer reads it back; otherwise it is the lazy
        fact, which Catalyst prunes per query anyway.
        """
        if self.materialize_fact:
            return materialize(self.fact.select(*REPORT_FACT_COLUMNS), "fact")
        return self.fact

    @cached_property
    def loan_fact(self) -> DataFrame:
        """The fact as far as business loans go: holdings are cut down to instruments of that class first.

        The cut stands below the dedupe (the instrument is part of its key) and all joins. Where the
        fact is already written, that table is read.
        """
        if self.materialize_fact or "fact" in self.__dict__:
            return self.report_fact
        loan_like = self.silver("instruments").where(asset_class_of() == BUSINESS_LOAN).select("instrument_id")
        if "holdings" not in self.extracts:  # a book over written tables
            holdings = self.silver("holdings").join(loan_like, "instrument_id", "left_semi")
        else:
            typed = self._typed("holdings").join(loan_like, "instrument_id", "left_semi")
            holdings = clean_rows(typed, self.clean_specs["holdings"])
        return self._fact(holdings)

    @cached_property
    def financed_emissions(self) -> DataFrame:
        """The published position table (with legal entity)."""
        return with_legal_entity(self.fact, self.silver("portfolios")).select(*FINANCED_EMISSIONS_COLUMNS)

    @cached_property
    def data_quality(self) -> DataFrame:
        return marts.data_quality(self.report_fact)

    @cached_property
    def portfolio_summary(self) -> DataFrame:
        return marts.portfolio_summary(self.report_fact)

    @cached_property
    def carbon_intensity(self) -> DataFrame:
        return marts.carbon_intensity(self.report_fact, self.portfolio_summary)

    @cached_property
    def taxonomy_alignment(self) -> DataFrame:
        return marts.taxonomy_alignment(self.report_fact)

    @cached_property
    def coverage(self) -> DataFrame:
        """Gap cause per position at portfolio level (what R09 aggregates)."""
        return marts.coverage_gaps(self.report_fact)

    @cached_property
    def coverage_table(self) -> DataFrame:
        """The published coverage table: financed emissions plus gap cause."""
        return marts.coverage_gaps(self.financed_emissions)

    # ---- reports ------------------------------------------------------------
    def report(self, report_id: str) -> DataFrame:
        """One of the nine reports (plan built once per book)."""
        if report_id not in self._report_cache:
            self._report_cache[report_id] = self._build_report(report_id)
        return self._report_cache[report_id]

    def pin_report(self, report_id: str, written: DataFrame) -> None:
        """Use an already-written report."""
        self._report_cache[report_id] = written

    def _build_report(self, report_id: str) -> DataFrame:
        builders = {
            "R01": lambda: reports.r01_equity(self.report_fact),
            "R02": lambda: reports.r02_bonds(self.report_fact),
            "R03": lambda: reports.r03_loans(self.loan_fact),
            "R04": lambda: reports.r04_quality(self.data_quality),
            "R05": lambda: reports.r05_waci(self.carbon_intensity),
            "R06": lambda: reports.r06_pai(self.portfolio_summary, self.silver("portfolios"), self.as_of),
            "R07": lambda: reports.r07_fossil(self.report_fact),
            "R08": lambda: reports.r08_taxonomy(self.taxonomy_alignment),
            "R09": lambda: reports.r09_coverage(self.coverage, self.as_of),
        }
        return builders[report_id]()


    # ---- row accounting -----------------------------------------------------
    def step_metrics(self) -> DataFrame:
        """Rows in / out / rejected / de-duplicated / flagged for every cleaning step and the gold build.

        Cleaning counts are one count-only aggregate per source, over its
        routed tables where it has them; the gold
        step checks that attaching issuer data neither adds nor loses positions.
        """
        parts = []
        for name, spec in self.clean_specs.items():
            if name in self._routed:
                parts += self._routed[name].counts(f"silver.{name}")
                continue
            counts = clean_counts(self._typed(name), spec)
            parts.append(
                counts.select(
                    F.lit(f"silver.{name}").alias("step"),
                    *[F.col(m).cast("bigint").alias(m) for m in metrics.METRICS if m != "flagged_rows"],
                    F.lit(0).cast("bigint").alias("flagged_rows"),
                )
            )
        step = "silver.entity_resolution"
        parts += [
            metrics.metric(self.silver("issuers"), step, metrics.rows("input_rows")),
            metrics.metric(
                self.entity_map,
                step,
                {"output_rows": F.count(F.lit(1)), "flagged_rows": F.count_if(F.col("coverage_status") != MAPPED)},
            ),
        ]
        step = "gold.financed_emissions"
        as_of = F.col("as_of_date") == F.lit(self.as_of).cast("date")
        parts += [
            metrics.metric(self.silver("holdings").where(as_of), step, metrics.rows("input_rows")),
            metrics.metric(self.silver("loans").where(as_of), step, metrics.rows("input_rows")),
            metrics.metric(
                self.fact,
                step,
                {
                    "output_rows": F.count(F.lit(1)),
                    "flagged_rows": F.count_if(F.col("financed_emissions_tco2e").isNull()),
                },
            ),
        ]
        return metrics.step_counts(parts)

    # ---- reconciliation -----------------------------------------------------
    def compared(self, report_id: str, baseline: DataFrame) -> DataFrame:
        return recon.compared(self.report(report_id), baseline, specs.RECON_SPECS[report_id])

    def breaks(self, report_id: str, baseline: DataFrame) -> DataFrame:
        return recon.reconcile(self.report(report_id), baseline, specs.RECON_SPECS[report_id])

    def recon_summary(
        self,
        baselines: Mapping[str, DataFrame],
        expected_fail: tuple[str, ...] = SEEDED_DIFFERENCES,
        skip_equal: bool = False,
    ) -> DataFrame:
        pairs = {rid: (self.report(rid), base) for rid, base in baselines.items()}
        return recon.recon_summary(pairs, specs.RECON_SPECS, expected_fail, skip_equal)

    def top_breaks(self, baselines: Mapping[str, DataFrame], n: int = 8) -> DataFrame:
        return recon.top_breaks([self.compared(rid, base) for rid, base in baselines.items()], n)


REPORT_IDS = tuple(f"R{i:02d}" for i in range(1, 10))
