"""Reconciliation of a report against a baseline under per-report tolerances.

Both sides are reduced to one row per key (a partial aggregate, so a
duplicated key becomes a ``duplicate_key`` break instead of fanning out),
then joined FULL OUTER on the keys compared as text (missing -> ''). A key
breaks at most once: missing on one side, duplicated, or with the list of all
value columns that differ. Two values match when both are missing (null or
empty), when both are numbers with ``|new - old| <= max(abs_tol, rel_tol *
max(|old|, 1))``, or when they are not both numbers and their texts are equal.
NaN matches nothing.

Of two written tables that are nearly equal, ``differing`` first compares digests of key buckets and leaves only the
rows of buckets that differ to that join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.plans.specs import ReconSpec

# Break kinds and summary states.
MISSING_IN_NEW = "missing_in_new"
MISSING_IN_BASELINE = "missing_in_baseline"
DUPLICATE_KEY = "duplicate_key"
VALUE_MISMATCH = "value_mismatch"
PASS, FAIL = "PASS", "FAIL"
BREAK_COLUMNS = (
    "report_id", "key_text", "break_type", "column_name", "new_value", "old_value", "new_text", "old_text"
)


#: Buckets of keys that are compared by digest, so at most so many rows a side and report are shuffled for it.
BUCKETS = 4096


def _key_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _value_text(column: str) -> Column:
    return F.nullif(F.col(column).cast("string"), F.lit(""))


def _bucket(spec: ReconSpec, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[_key_text(k) for k in spec.keys]), F.lit(buckets))


def _digests(df: DataFrame, spec: ReconSpec, tag: str, buckets: int) -> DataFrame:
    """Per bucket: rows, 128 bits over all rows whatever their order, and rows that match nothing or may share a key."""
    texts = [*[_key_text(k) for k in spec.keys], *[F.coalesce(_value_text(v), F.lit("")) for v in spec.values]]
    odd = F.lit(False)
    for k in spec.keys:
        odd = odd | (_key_text(k) == "")
    for v in spec.values:
        odd = odd | F.coalesce(F.isnan(F.col(v).cast("string").try_cast("double")), F.lit(False))
    return df.groupBy(_bucket(spec, buckets).alias("_bucket")).agg(
        F.count(F.lit(1)).alias(f"{tag}_rows"),
        F.struct(
            F.count(F.lit(1)),
            F.bit_xor(F.xxhash64(*texts)),
            F.sum(F.xxhash64(F.lit(1), *texts).cast("decimal(20,0)")),
        ).alias(f"{tag}_digest"),
        F.count_if(odd).alias(f"{tag}_odd"),
    )


def differing(
    new: DataFrame, base: DataFrame, spec: ReconSpec, buckets: int = BUCKETS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of both sides in key buckets that differ, and one row with how many rows the equal ones hold (``n``).

    Rows left out match: their bucket has equal 128-bit digests of key and value texts on both sides. A bucket with NaN or
    with a missing key is always compared. Keys of ``new`` must be unique otherwise, as those of a report are (it is
    grouped by them); then a bucket that holds a key twice in ``base`` differs. Give written tables, each is read twice.
    """
    sides = _digests(new, spec, "n", buckets).join(_digests(base, spec, "b", buckets), "_bucket", "full")
    equal = F.col("n_digest").eqNullSafe(F.col("b_digest")) & (F.col("n_odd") == 0) & (F.col("b_odd") == 0)
    judged = sides.withColumn("_equal", F.coalesce(equal, F.lit(False)))
    wanted = F.broadcast(judged.where(~F.col("_equal")).select("_bucket"))  # at most ``buckets`` rows
    part = lambda df: df.withColumn("_bucket", _bucket(spec, buckets)).join(wanted, "_bucket", "left_semi").drop("_bucket")
    rest = judged.agg(F.coalesce(F.sum(F.when(F.col("_equal"), F.col("n_rows"))), F.lit(0)).cast("bigint").alias("n"))
    return part(new), part(base), rest


def _side(df: DataFrame, spec: ReconSpec, tag: str) -> DataFrame:
    keys = [_key_text(k).alias(k) for k in spec.keys]
    values = [_value_text(v).alias(f"{tag}_{v}") for v in spec.values]
    return (
        df.select(*keys, *values)
        .groupBy(*spec.keys)
        .agg(F.count(F.lit(1)).alias(f"{tag}__n"), *[F.min(f"{tag}_{v}").alias(f"{tag}_{v}") for v in spec.values])
    )


def _difference(column: str, spec: ReconSpec) -> Column:
    """What differs in ``column``, null if the two values match."""
    new_text, old_text = F.col(f"n_{column}"), F.col(f"b_{column}")
    new, old = new_text.try_cast("double"), old_text.try_cast("double")
    numbers = new.isNotNull() & old.isNotNull()
    threshold = F.greatest(F.lit(spec.abs_tol), F.lit(spec.rel_tol) * F.greatest(F.abs(old), F.lit(1.0)))
    close = ~F.isnan(new) & ~F.isnan(old) & (F.abs(new - old) <= threshold)
    match = F.when(numbers, close).otherwise(new_text.eqNullSafe(old_text))
    is_text = lambda x, number: F.when(number.isNull(), x)
    return F.when(
        ~match,
        F.struct(
            F.lit(column).alias("column_name"),
            new.alias("new_value"),
            old.alias("old_value"),
            is_text(new_text, new).alias("new_text"),
            is_text(old_text, old).alias("old_text"),
        ),
    )


def compared(new: DataFrame, base: DataFrame, spec: ReconSpec) -> DataFrame:
    """One row per key of either side with ``break_type`` (null = no break) and ``diffs``, all differing columns."""
    j = _side(new, spec, "n").join(_side(base, spec, "b"), list(spec.keys), "full")
    diffs = F.array_compact(F.array(*[_difference(v, spec) for v in spec.values]))
    break_type = (
        F.when(F.col("n__n").isNull(), F.lit(MISSING_IN_NEW))
        .when(F.col("b__n").isNull(), F.lit(MISSING_IN_BASELINE))
        .when((F.col("n__n") > 1) | (F.col("b__n") > 1), F.lit(DUPLICATE_KEY))
        .when(F.size("diffs") > 0, F.lit(VALUE_MISMATCH))
    )
    return j.withColumn("diffs", diffs).select(
        F.lit(spec.report_id).alias("report_id"),
        F.concat_ws("|", *[F.col(k) for k in spec.keys]).alias("key_text"),
        break_type.alias("break_type"),
        "n__n",
        "b__n",
        "diffs",
    )


def _break_rows(compared_keys: DataFrame, *extra: str) -> DataFrame:
    """A row per break, and one per differing column of a value mismatch."""
    shown = F.when(F.col("break_type") == VALUE_MISMATCH, F.col("diffs"))
    rows = compared_keys.select("report_id", "key_text", "break_type", *extra, F.explode_outer(shown).alias("d"))
    return rows.select(*[f"d.{c}" if c not in rows.columns else c for c in BREAK_COLUMNS], *extra)


def reconcile(new: DataFrame, base: DataFrame, spec: ReconSpec) -> DataFrame:
    """Break rows of one report (``BREAK_COLUMNS``); a key with several differing columns has a row for each."""
    return _break_rows(compared(new, base, spec).where(F.col("break_type").isNotNull()))


def recon_summary(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]],
    specs: Mapping[str, ReconSpec],
    expected_fail: Sequence[str] = (),
    skip_equal: bool = False,
) -> DataFrame:
    """PASS / FAIL per report (one aggregate of the comparison each) and whether a FAIL was unexpected.

    ``skip_equal``: compare only key buckets whose digests differ (see :func:`differing`).
    """
    rows = []
    for report_id, (new, base) in pairs.items():
        if skip_equal:
            new, base, rest = differing(new, base, specs[report_id])
            same = rest.select(F.lit(report_id).alias("report_id"), F.col("n").alias("rows_new"), F.col("n").alias("rows_base"))
            rows.append(same.withColumn("breaks", F.lit(0).cast("bigint")))
        c = compared(new, base, specs[report_id])
        rows.append(
            c.agg(
                F.coalesce(F.sum("n__n"), F.lit(0)).cast("bigint").alias("rows_new"),
                F.coalesce(F.sum("b__n"), F.lit(0)).cast("bigint").alias("rows_base"),
                F.count_if(F.col("break_type").isNotNull()).alias("breaks"),
            ).select(F.lit(report_id).alias("report_id"), "rows_new", "rows_base", "breaks")
        )
    summary = reduce(DataFrame.unionByName, rows)
    if skip_equal:
        counts = ("rows_new", "rows_base", "breaks")
        summary = summary.groupBy("report_id").agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])
    status = F.when(F.col("breaks") == 0, F.lit(PASS)).otherwise(F.lit(FAIL))
    return summary.select(
        "report_id",
        status.alias("status"),
        "rows_new",
        "rows_base",
        "breaks",
        F.when(F.col("breaks") == 0, F.lit("match")).otherwise(F.lit("see breaking rows")).alias("note"),
        ((F.col("breaks") > 0) & ~F.col("report_id").isin(*expected_fail)).alias("unexpected_fail"),
    )


def missing_baseline(report_id: str, new: DataFrame, expected_fail: Sequence[str] = ()) -> DataFrame:
    """Summary row for a report whose baseline does not exist: FAIL, with the new side's row count."""
    return new.agg(F.count(F.lit(1)).alias("rows_new")).select(
        F.lit(report_id).alias("report_id"),
        F.lit(FAIL).alias("status"),
        "rows_new",
        F.lit(0).cast("bigint").alias("rows_base"),
        F.lit(0).cast("bigint").alias("breaks"),
        F.lit("missing output or baseline").alias("note"),
        F.lit(report_id not in expected_fail).alias("unexpected_fail"),
    )


def breaking_keys(compared_keys: DataFrame, n: int = 8) -> DataFrame:
    """The first ``n`` breaking keys of one report (top-k: a bounded sort, not a full one)."""
    return compared_keys.where(F.col("break_type").isNotNull()).orderBy("key_text").limit(n)


def top_breaks(per_report: Sequence[DataFrame], n: int = 8) -> DataFrame:
    """Break rows of the first ``n`` breaking keys of each report, numbered by key (at most n keys per report)."""
    limited = reduce(DataFrame.unionByName, [breaking_keys(c, n) for c in per_report])
    rank = F.row_number().over(Window.partitionBy("report_id").orderBy("key_text")).cast("bigint")
    return _break_rows(limited.withColumn("break_rank", rank), "break_rank")
