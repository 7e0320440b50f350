"""Reproducible arithmetic for published numbers.

Double sums depend on the order tasks finish in, so a report rounded to cents could change from run to
run. Sums are therefore exact and rounded once (:mod:`greenledger.functions.exact`), and published numbers
are rounded half-up in the decimal domain, which makes them identical on every run and on every engine
that does the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from greenledger.functions.exact import rounded_total

ROUND_TYPE = "decimal(38,18)"  # 20 integer digits, 18 places before a published rounding


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(dec: Column) -> Column:
    """Decimal to double via its text, so the conversion is correctly rounded."""
    return dec.cast("string").cast("double")


def sum_double(col: str, *factors: str) -> Column:
    """The sum of an amount (times its factors), rounded to the nearest double; null without a value.

    For one-off use; :func:`greenledger.operators.totals.totals` forms terms once and is what reports use.
    """
    return rounded_total(col, *factors)


def round_half_up(col: str | Column, places: int) -> Column:
    """Round half-up to ``places`` decimals in the decimal domain, returned as double.

    From 10**20 on doubles are integers, and stay as they are.
    """
    c = _c(col).cast("double")
    return F.coalesce(as_double(F.round(c.try_cast(ROUND_TYPE), places)), c)
