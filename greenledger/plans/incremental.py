"""Incremental as-of runs: only dates whose inputs changed are computed again.

What a date's fact depends on is cut into slices of the clean tables: positions and rates of the
date, issuer data of its fiscal year, and master data as a whole. Each slice has a digest (rows and
128 bits over them, whatever their order), one partially aggregated pass per table. The digests that
a date was computed from are stored with it; a late correction changes a digest of the dates that it
touches and of no other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.operators.emissions import FINANCED_EMISSIONS_COLUMNS, TAXONOMY_ATTRS, open_projection
from greenledger.operators.marts import coverage_gaps
from greenledger.operators.positions import with_legal_entity
from greenledger.plans import specs
from greenledger.plans.pipeline import Book
from greenledger.sources.tables import TableStore

#: Column that cuts a source into slices; the other sources belong to every date as a whole.
BY_DATE = ("holdings", "loans", "fx_rates")
BY_YEAR = ("company_financials", "vendor_emissions", "taxonomy_data")
DIGESTS = "_input_digests"
# What a date's run did.
COMPUTED, UNCHANGED = "computed", "unchanged"
_PENDING = "_pending"


def _dates_of_slice(source: str, dates: Sequence[str]) -> Column:
    """One row per date that the row's slice belongs to."""
    listed = F.array(*[F.lit(d) for d in dates])
    if source in BY_DATE:
        return F.filter(listed, lambda d: d == F.col("as_of_date").cast("string"))
    if source in BY_YEAR:
        return F.filter(listed, lambda d: F.substring(d, 1, 4).cast("int") == F.col("fiscal_year"))
    return listed


def input_digests(silver: Mapping[str, DataFrame], dates: Sequence[str]) -> DataFrame:
    """``(as_of_date, source, n, xored, summed)`` per date and source with rows in its slice.

    Rows count as often as they occur; columns are taken by name, so their order does not matter.
    """
    parts = []
    for source, df in sorted(silver.items()):
        columns = [F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]
        # a null must not pass for the value beside it: the hash skips nulls
        texts = [x for c in columns for x in (c.isNull(), c)]
        slice_of = []
        if source in BY_DATE:  # the scan is pruned to the dates
            slice_of = ["as_of_date"]
            df = df.where(F.col("as_of_date").isin(*[F.lit(d).cast("date") for d in dates]))
        elif source in BY_YEAR:
            slice_of = ["fiscal_year"]
            df = df.where(F.col("fiscal_year").isin(*sorted({int(d[:4]) for d in dates})))
        digest = df.groupBy(*slice_of).agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64(*texts)).alias("xored"),
            F.sum(F.xxhash64(F.lit(1), *texts).cast("decimal(20,0)")).cast("string").alias("summed"),
        ).where("n > 0")
        digest = digest.withColumn("_date", F.explode(_dates_of_slice(source, dates)))
        parts.append(digest.select(F.col("_date").alias("as_of_date"), F.lit(source).alias("source"), "n", "xored", "summed"))
    return reduce(DataFrame.unionByName, parts)


def _by_date(rows: list, dates: Sequence[str]) -> dict[str, set]:
    out: dict[str, set] = {d: set() for d in dates}
    for r in rows:
        out[str(r["as_of_date"])].add((r["source"], r["n"], r["xored"], r["summed"]))
    return out


def _stored(spark: SparkSession, store: TableStore, dates: Sequence[str]) -> dict[str, set]:
    try:
        known = store.read(spark, "gold", DIGESTS)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return _by_date([], dates)
    mine = known.where(F.col("as_of_date").cast("string").isin(*dates))
    return _by_date(mine.collect(), dates)  # at most a row per source and date


def refresh_dates(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    store: TableStore,
    dates: Sequence[str],
    loan_portfolio: str,
    clean_specs: Mapping[str, specs.CleanSpec] | None = None,
) -> DataFrame:
    """Bring the fact, its open projection and the coverage table up to date for ``dates``.

    ``silver`` are written clean tables (of every date). Returns ``(as_of_date, action)``. A date
    whose inputs are as they were is left alone. A date without positions any more is replaced by an
    empty one. While a date is written its digests say so, so a run that was cut off is made again.
    """
    dates = sorted(set(dates))
    if not dates:
        return spark.createDataFrame([], "as_of_date string, action string")
    # the loan book's name stands in the fact
    now = _by_date(input_digests(silver, dates).collect(), dates)  # at most a row per source and date
    for rows in now.values():
        rows.add((f"loan_portfolio={loan_portfolio}", 0, 0, ""))
    before = _stored(spark, store, dates)
    for as_of in dates:
        if now[as_of] == before[as_of]:
            continue
        _note(spark, store, as_of, {(_PENDING, 0, 0, "")})
        book = Book(spark, {}, as_of, loan_portfolio, dict(clean_specs or {}))
        book.pin_silver(silver)
        fact = with_legal_entity(book.fact, silver["portfolios"]).select(*FINANCED_EMISSIONS_COLUMNS, *TAXONOMY_ATTRS)
        store.write_date(fact, "restricted", "financed_emissions_full", as_of)
        fact = store.read_date(spark, "restricted", "financed_emissions_full", as_of)
        store.write_date(open_projection(fact), "gold", "financed_emissions", as_of)
        store.write_date(open_projection(coverage_gaps(fact)), "gold", "coverage", as_of)
        _note(spark, store, as_of, now[as_of])
    done = [(d, UNCHANGED if now[d] == before[d] else COMPUTED) for d in dates]
    return spark.createDataFrame(done, "as_of_date string, action string")


def _note(spark: SparkSession, store: TableStore, as_of: str, digests: set) -> None:
    rows = spark.createDataFrame(
        [(as_of, *d) for d in sorted(digests)], "as_of_date string, source string, n bigint, xored bigint, summed string"
    )
    store.write_date(rows, "gold", DIGESTS, as_of)
