"""Scalar cleaning expressions for landing text.

ANSI mode stays on: every parse is a ``try_`` form, so bad text becomes null
and is caught by a reject rule instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two date layouts the source extracts use.
ISO_DATE = "yyyy-MM-dd"
SAS_DATE9 = "ddMMMyyyy"  # e.g. 31DEC2025


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trimmed(col: str | Column) -> Column:
    return F.trim(_c(col))


def blank_to_null(col: str | Column) -> Column:
    """Whitespace-only or empty text becomes null."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def missing_flag(col: str | Column) -> Column:
    """1 when the value is null, else 0."""
    return _c(col).isNull().cast("int")


def to_double(col: str | Column) -> Column:
    return _c(col).try_cast("double")


def to_int(col: str | Column) -> Column:
    return _c(col).try_cast("int")


def parse_iso_date(col: str | Column) -> Column:
    return F.try_to_date(_c(col), ISO_DATE)


def parse_date9(col: str | Column) -> Column:
    """SAS DATE9. text (``31dec2025`` in any case) to a date; null when unparseable."""
    return F.try_to_date(F.upper(_c(col)), SAS_DATE9)
