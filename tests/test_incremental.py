"""Incremental as-of runs against full ones: two dates, late corrections, withdrawn dates, cut-off runs."""

import os
import tempfile

from pyspark.sql import functions as F

from greenledger.plans import incremental as inc
from greenledger.plans.pipeline import Book
from greenledger.sources.tables import TableStore
from tests.conftest import FIXTURE_AS_OF, FIXTURE_LOAN_PORTFOLIO

DATES = ["2023-12-31", FIXTURE_AS_OF]
TABLES = (("restricted", "financed_emissions_full"), ("gold", "financed_emissions"), ("gold", "coverage"))


def content(spark, store):
    return {t: sorted(map(repr, store.read(spark, layer, t).collect())) for layer, t in TABLES}


def files(store):
    path = store.path("gold", "financed_emissions")
    return {d: sorted(os.listdir(f"{path}/as_of_date={d}")) for d in DATES}


def test_only_changed_dates_are_computed(spark, fixture_extracts):
    base = tempfile.mkdtemp(prefix="greenledger-incremental-")
    book = Book(spark, fixture_extracts, FIXTURE_AS_OF, FIXTURE_LOAN_PORTFOLIO)
    silver = {}
    for name in book.clean_specs:
        book.silver(name).write.parquet(f"{base}/silver/{name}")
        silver[name] = spark.read.parquet(f"{base}/silver/{name}")

    def run(store, tables):
        out = inc.refresh_dates(spark, tables, store, DATES, FIXTURE_LOAN_PORTFOLIO)
        return {r["as_of_date"]: r["action"] for r in out.collect()}

    store = TableStore(f"{base}/tables")
    assert set(run(store, silver).values()) == {inc.COMPUTED}
    first = files(store)
    assert set(run(store, silver).values()) == {inc.UNCHANGED} and files(store) == first

    # a late correction of one date rewrites that date and equals a full run
    at = F.col("as_of_date") == F.lit(DATES[0]).cast("date")
    late = {**silver, "holdings": silver["holdings"].withColumn("market_value", F.when(at, 1.5).otherwise(F.col("market_value")))}
    assert run(store, late) == {DATES[0]: inc.COMPUTED, DATES[1]: inc.UNCHANGED}
    now = files(store)
    assert now[DATES[1]] == first[DATES[1]] and now[DATES[0]] != first[DATES[0]]
    full = TableStore(f"{base}/full")
    run(full, late)
    assert content(spark, store) == content(spark, full)

    # a year's issuer data touches the dates of that year only, a withdrawn date is emptied
    less = {**late, "taxonomy_data": silver["taxonomy_data"].where("issuer_id <> 'N7'")}
    assert run(store, less) == {DATES[0]: inc.UNCHANGED, DATES[1]: inc.COMPUTED}
    gone = {**less, "holdings": late["holdings"].where(~at)}
    assert run(store, gone) == {DATES[0]: inc.COMPUTED, DATES[1]: inc.UNCHANGED}
    assert {str(r[0]) for r in store.read(spark, "gold", "coverage").select("as_of_date").distinct().collect()} == {DATES[1]}

    # a run that was cut off is made again, even if its inputs are as before
    inc._note(spark, store, DATES[1], {(inc._PENDING, 0, 0, "")})
    assert run(store, gone) == {DATES[0]: inc.UNCHANGED, DATES[1]: inc.COMPUTED}


def test_digests_see_nulls_copies_and_empty_tables(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "a string, b string")
        return [tuple(r) for r in inc.input_digests({"portfolios": df}, DATES[:1]).collect()]

    assert digest([("x", None), ("y", "z")]) == digest([("y", "z"), ("x", None)])
    assert digest([("x", None)]) != digest([(None, "x")])
    assert len({str(digest([("x", "y")] * n)) for n in (1, 2, 3)}) == 3
    assert digest([]) == []
