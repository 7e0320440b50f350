"""A ``Book`` over the driver tables of one scale-factor folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

from greenledger.plans import specs
from greenledger.plans.pipeline import Book
from greenledger.sources import driver


_BOOKS: dict[tuple[int, str, str], Book] = {}


def driver_book(spark: SparkSession, sf_dir: str, as_of: str = driver.AS_OF) -> Book:
    """The book of one folder, memoized per session.

    A Book only holds lazy plans (nothing is cached or persisted), so sharing
    it between queries saves rebuilding identical plans on the Python side;
    every query still runs from the parquet files. Books that write tables
    (``with_materialized_fact``, ``with_routed_sources``) are made from it by each
    query for itself, so changed input is never answered from an earlier write.
    """
    key = (id(spark), sf_dir, as_of)
    book = _BOOKS.get(key)
    if book is None or book.spark is not spark:
        extracts = driver.landing_extracts(spark, sf_dir, as_of)
        holdings = specs.holdings_spec(driver.HOLDINGS_TIE_BREAKERS)
        book = _BOOKS[key] = Book(spark, extracts, as_of, driver.LOAN_PORTFOLIO, clean_specs={"holdings": holdings})
    return book
