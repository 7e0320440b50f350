"""Cleaning with a total, explained reject ledger.

``clean_table`` trims, types and checks one landing extract in a single
projection, then splits it with one CASE column: every input row is either
kept, rejected with a reason, or dropped as a duplicate of a kept row, and the
ledger says which.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.sources.extracts import AUDIT, LEDGER_SCHEMA, MALFORMED
from greenledger.functions.cleaning import (
    blank_to_null,
    missing_flag,
    parse_date9,
    parse_iso_date,
    to_double,
    to_int,
    trimmed,
)

# The ledger layout and the reasons that are not table rules.
REJECT_COLUMNS = ("source_table", "reject_reason", "business_key", "details", "rejected_rows")
REJECT_SCHEMA = LEDGER_SCHEMA
AUDIT_COLUMNS = AUDIT
MISSING_KEY = "missing_key"
DUPLICATE_KEY = "duplicate_key"
NON_FINITE = "non_finite_number"
MALFORMED_LINE = "malformed_line"

Rule = tuple[str, Callable[[], Column]]


@dataclass(frozen=True)
class CleanSpec:
    """Declarative cleaning contract of one source extract.

    ``columns`` are the landing columns (text). Steps run in this order:
    trim every column, upper-case, blank to null, casts, date parses, derived
    flags; then the first matching rule names the reject reason; then, when
    ``dedupe`` is set, one row per ``key`` survives (the first by ``order``,
    then by every column, so the survivor is deterministic).
    """

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    blank_to_null: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    ints: tuple[str, ...] = ()
    longs: tuple[str, ...] = ()
    iso_dates: tuple[str, ...] = ()
    date9_dates: tuple[str, ...] = ()
    flags: dict[str, str] = field(default_factory=dict)  # new column -> column whose null it flags
    rules: tuple[Rule, ...] = ()
    dedupe: bool = True
    order: tuple[tuple[str, bool], ...] = ()  # (column, ascending)
    restricted: bool = False


def typed_frame(raw: DataFrame, spec: CleanSpec) -> DataFrame:
    """Trim, normalise and type the landing columns in one projection (audit columns dropped)."""
    exprs: dict[str, Column] = {}
    for name in spec.columns:
        col: Column = trimmed(name)
        if name in spec.upper:
            col = F.upper(col)
        if name in spec.blank_to_null:
            col = blank_to_null(col)
        if name in spec.doubles:
            col = to_double(col)
        elif name in spec.ints:
            col = to_int(col)
        elif name in spec.longs:
            col = col.try_cast("bigint")
        elif name in spec.iso_dates:
            col = parse_iso_date(col)
        elif name in spec.date9_dates:
            col = parse_date9(col)
        exprs[name] = col
    flags = [missing_flag(exprs[src]).alias(flag) for flag, src in spec.flags.items()]
    extra = [MALFORMED] if MALFORMED in raw.columns else []
    return raw.select(*[exprs[n].alias(n) for n in spec.columns], *flags, *extra)


def reason_column(spec: CleanSpec, typed: DataFrame | None = None) -> Column:
    """A malformed line first (where ``typed`` can hold one), NaN or infinite numbers, then the first matching table rule, then a null or blank key.

    Null means the row is good. Table rules come before the key, so that e.g. an unparseable date
    that is part of the key is reported with its specific reason.
    """
    branches: list[tuple[str, Column]] = []
    if typed is not None and MALFORMED in typed.columns:
        branches.append((MALFORMED_LINE, F.col(MALFORMED).isNotNull()))
    if spec.doubles:
        odd = [F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c in spec.doubles]
        branches.append((NON_FINITE, reduce(lambda a, b: a | b, odd)))
    branches += [(reason, predicate()) for reason, predicate in spec.rules]
    if spec.key:
        key_missing = reduce(lambda a, b: a | b, [F.coalesce(F.col(k).cast("string"), F.lit("")) == "" for k in spec.key])
        branches.append((MISSING_KEY, key_missing))
    if not branches:
        return F.lit(None).cast("string")
    expr = F.when(branches[0][1], F.lit(branches[0][0]))
    for reason, predicate in branches[1:]:
        expr = expr.when(predicate, F.lit(reason))
    return expr


def business_key(key: Sequence[str]) -> Column:
    if not key:
        return F.lit(None).cast("string")
    return F.concat_ws("|", *[escaped(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in key])


def escaped(part: Column) -> Column:
    """A part of a key text, so that different keys have different texts: ``|`` and the escape itself are escaped."""
    return F.replace(F.replace(part, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def detail(column: str, kind: str) -> Column:
    """A typed field of a ledger row's ``details``, read as VARIANT; null where the row's source has no such field."""
    return F.try_variant_get(F.try_parse_json("details"), f"$.{column}", kind)


def row_json(columns: Sequence[str]) -> Column:
    """The whole row as JSON, nulls included so the ledger shows what was missing."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def split_rejects(typed: DataFrame, spec: CleanSpec) -> tuple[DataFrame, DataFrame]:
    """Split into (good, ledger rows) with one CASE column; the split is total."""
    flagged = typed.withColumn("_reject_reason", reason_column(spec, typed))
    good = flagged.where(F.col("_reject_reason").isNull()).drop("_reject_reason")
    bad = flagged.where(F.col("_reject_reason").isNotNull())
    return good, reject_entries(bad, spec, F.col("_reject_reason"), typed.columns)


def reject_entries(bad: DataFrame, spec: CleanSpec, reason: Column, columns: Sequence[str]) -> DataFrame:
    """Ledger entries of rejected rows; ``columns`` make the details."""
    return bad.select(
        F.lit(spec.name).alias("source_table"),
        reason.alias("reject_reason"),
        business_key(spec.key).alias("business_key"),
        row_json(columns).alias("details"),
        F.lit(1).cast("bigint").alias("rejected_rows"),
    )


def duplicate_entries(groups: DataFrame, key: Sequence[str], source_table: str, row: Column, copies: Column) -> DataFrame:
    """Ledger entries of duplicated keys: the surviving ``row`` and how many of its ``copies`` are dropped."""
    return groups.select(
        F.lit(source_table).alias("source_table"),
        F.lit(DUPLICATE_KEY).alias("reject_reason"),
        business_key(key).alias("business_key"),
        F.to_json(row, {"ignoreNullFields": "false"}).alias("details"),
        (copies - 1).alias("rejected_rows"),
    )


def survivors(df: DataFrame, key: Sequence[str], order: Sequence[tuple[str, bool]] = (), keep: Column | None = None) -> DataFrame:
    """Per key the first row by ``order``, then by all columns (``_w.r``), and how many rows there are (``_n``)."""
    order_exprs = [F.col(c) if asc else -F.col(c) for c, asc in order]
    ranking = F.struct(
        F.struct(*order_exprs, F.lit(0).alias("_pad")).alias("o"),
        F.struct(*[F.col(c) for c in df.columns]).alias("r"),
    )
    if keep is None:
        agg = [F.min(ranking).alias("_w"), F.count(F.lit(1)).alias("_n")]
    else:
        agg = [F.min(F.when(keep, ranking)).alias("_w"), F.count_if(keep).alias("_n")]
    return df.groupBy(*key).agg(*agg)


def dedupe_keep_one(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[tuple[str, bool]] = (),
    source_table: str = "",
    keep: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Keep one row per key: the first by ``order`` (then by all columns).

    Built as one aggregate on the key with ``min(struct)``, so the map side
    collapses a hot key before the shuffle (no window sort of a whole group in
    one task). ``keep`` restricts the candidates to rows where it is true,
    inside the aggregate, so no filter is pushed into (and duplicates) the
    typing expressions below. Returns (kept, ledger) where the ledger has one
    row per duplicated key carrying the number of rows dropped.
    Descending order is supported for numeric columns only.
    """
    grouped = survivors(df, key, order, keep)
    # keys come from the grouping, so a filter on them (as-of date, fiscal year) moves below the aggregate
    columns = [F.col(c) if c in key else F.col(f"_w.r.{c}").alias(c) for c in df.columns]
    kept = grouped.where(F.col("_n") > 0).select(*columns)
    dropped = duplicate_entries(grouped.where(F.col("_n") > 1), key, source_table, F.col("_w.r"), F.col("_n"))
    return kept, dropped


def clean_rows(typed: DataFrame, spec: CleanSpec) -> DataFrame:
    """The rows that pass: no reject reason, one per key (when the spec dedupes).

    With a key, the good rows go straight into the dedupe aggregate (the
    reject test is a condition inside it), so no filter is pushed into and
    duplicates the typing expressions.
    """
    ok = reason_column(spec, typed).isNull()
    if not (spec.dedupe and spec.key):
        return typed.where(ok).drop(MALFORMED)
    kept, _ = dedupe_keep_one(typed, spec.key, spec.order, spec.name, keep=ok)
    return kept.drop(MALFORMED)


def ledger_rows(typed: DataFrame, spec: CleanSpec) -> DataFrame:
    """Ledger entries: rejected rows plus one entry per duplicated key."""
    _, rejects = split_rejects(typed, spec)
    if not (spec.dedupe and spec.key):
        return rejects
    _, dups = dedupe_keep_one(typed, spec.key, spec.order, spec.name, keep=reason_column(spec, typed).isNull())
    return rejects.unionByName(dups)


def clean_table(raw: DataFrame, spec: CleanSpec) -> tuple[DataFrame, DataFrame]:
    """Landing extract -> (clean rows, ledger rows)."""
    typed = typed_frame(raw, spec)
    return clean_rows(typed, spec), ledger_rows(typed, spec)


def clean_counts(typed: DataFrame, spec: CleanSpec) -> DataFrame:
    """One row: input, kept, rejected and de-duplicated row counts of a source (count-only aggregates).

    Same rules as ``clean_rows`` / ``ledger_rows``, so input = kept + rejected + duplicates.
    """
    ok = reason_column(spec, typed).isNull()
    if not (spec.dedupe and spec.key):
        return typed.agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if(ok).alias("output_rows"),
            F.count_if(~ok).alias("rejected_rows"),
            F.lit(0).cast("bigint").alias("duplicate_rows"),
        )
    per_key = typed.groupBy(*spec.key).agg(F.count(F.lit(1)).alias("_all"), F.count_if(ok).alias("_ok"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("_all"), zero).alias("input_rows"),
        F.count_if(F.col("_ok") > 0).alias("output_rows"),
        F.coalesce(F.sum(F.col("_all") - F.col("_ok")), zero).alias("rejected_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_ok") - 1, F.lit(0))), zero).alias("duplicate_rows"),
    )


def empty_ledger(spark: SparkSession) -> DataFrame:
    """A ledger without entries, with the ledger's types."""
    return spark.createDataFrame([], REJECT_SCHEMA)


def reject_ledger(frames: Sequence[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """Union of ledger frames (UNION ALL by name); of none, the empty ledger of ``spark``."""
    if not frames:
        return empty_ledger(spark or SparkSession.getActiveSession())
    return reduce(DataFrame.unionByName, frames)


def reject_counts(ledger: DataFrame) -> DataFrame:
    """Ledger entries and rejected rows by (source, reason)."""
    return ledger.groupBy("source_table", "reject_reason").agg(
        F.count(F.lit(1)).alias("ledger_entries"),
        F.sum("rejected_rows").alias("rejected_rows"),
    )
