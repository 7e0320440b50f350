"""Landing ingest (bronze): read an extract exactly as delivered and stamp audit columns.

No trimming, parsing or dropping happens here. CSV extracts are read as text (no inference pass over
the data), and columns are bound by the name that each file's own header gives them: files are grouped
by header, each group is scanned with its own schema, and one projection per group names the contract's
columns. Columns that a file lacks are null, and what a file has beyond the contract is not read; both
are told as ledger rows.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


# Column with the text of a line that does not have the extract's number of fields.
MALFORMED = "_malformed_line"
# Audit columns, the ledger's layout and the reasons that concern a file as a whole.
AUDIT = ("_ingested_at", "_source_file", "_batch_id")
AUDIT_TYPES = ("timestamp", "string", "string")
LEDGER_SCHEMA = "source_table string, reject_reason string, business_key string, details string, rejected_rows bigint"
MISSING_COLUMN, UNKNOWN_COLUMN = "missing_column", "unknown_column"
#: Headers that are read at a time.
HEADER_READERS = 8


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def batch_id(as_of: str) -> str:
    return f"batch-{as_of}"


def stamp_audit(df: DataFrame, as_of: str) -> DataFrame:
    """Add ``_ingested_at`` (load time), ``_source_file`` (file name per row) and ``_batch_id``."""
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.lit(batch_id(as_of)).alias("_batch_id"),
    )


def read_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Header of every file under ``path`` that is not empty, read by Spark's CSV reader: a line a file, no scan."""
    files = [unquote(f) for f in spark.read.text(path).inputFiles()]
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = pool.map(lambda f: tuple(spark.read.option("header", True).csv(f).columns), files)
        return {f: h for f, h in zip(files, headers, strict=True) if h}


def _plain(name: str) -> str:
    """A column's name without byte-order mark, blanks around it and case."""
    return name.lstrip("\ufeff").strip().lower()


def bind_columns(header: Sequence[str], columns: Sequence[str]) -> tuple[dict[str, int], list[str]]:
    """Place of each contract column in ``header`` (the first of that name), and the names that are not bound."""
    places: dict[str, int] = {}
    wanted = {_plain(c): c for c in columns}
    unknown = []
    for i, name in enumerate(header):
        column = wanted.get(_plain(name))
        if column is None or column in places:
            unknown.append(name)
        else:
            places[column] = i
    return places, unknown


def header_findings(
    spark: SparkSession, headers: Mapping[str, Sequence[str]], source: str, columns: Sequence[str]
) -> DataFrame:
    """Ledger rows (none rejected): each file's missing and unknown columns, keyed by file name."""
    rows = []
    for file, header in sorted(headers.items()):
        places, unknown = bind_columns(header, columns)
        found = ((MISSING_COLUMN, [c for c in columns if c not in places]), (UNKNOWN_COLUMN, unknown))
        rows += [
            (source, reason, file.rsplit("/", 1)[-1], json.dumps({"column": c}), 0) for reason, names in found for c in names
        ]
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def _bound(spark: SparkSession, files: Sequence[str], header: Sequence[str], columns: Sequence[str], as_of: str) -> DataFrame:
    """Files of one header, under the contract's names."""
    places, _ = bind_columns(header, columns)
    raw = (
        spark.read.schema(text_schema([f"_c{i}" for i in range(len(header))]).add(MALFORMED, StringType()))
        .option("header", True)
        .option("enforceSchema", True)  # names are bound below, by place in this very header
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)  # a line is torn by all of its fields, not by those that are bound
        .csv(list(files))
    )
    text = lambda c: F.col(f"_c{places[c]}") if c in places else F.lit(None).cast("string")
    stamped = stamp_audit(raw, as_of)
    return stamped.select(*[text(c).alias(c) for c in columns], MALFORMED, *AUDIT)


def ingest_delivery(
    spark: SparkSession, path: str | Sequence[str], source: str, columns: Sequence[str], as_of: str
) -> tuple[DataFrame, DataFrame]:
    """``(rows, findings)`` of a CSV extract, one or many files under ``path`` with a header each.

    Rows: every contract column as text, found by name whatever its place (case, blanks and a byte-order
    mark do not count), null where the file lacks it; audit columns; ``_malformed_line``. A blank field
    and a quoted empty string both arrive as null. A line with too few or too many fields for its own
    file's header does not stop the load: its text is kept in ``_malformed_line``, which the cleaning step
    turns into a ledger row of its own. Empty files have no header and no row. Findings: see
    :func:`header_findings`.
    """
    headers = read_headers(spark, path)
    groups = defaultdict(list)
    for file, header in headers.items():
        groups[header].append(file)
    frames = [_bound(spark, files, header, columns, as_of) for header, files in sorted(groups.items())]
    if not frames:
        empty = spark.createDataFrame([], text_schema([*columns, MALFORMED]))
        frames = [empty.select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(AUDIT, AUDIT_TYPES, strict=True)])]
    return reduce(DataFrame.unionByName, frames), header_findings(spark, headers, source, columns)


def ingest_extract(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], as_of: str) -> DataFrame:
    """The rows of :func:`ingest_delivery`."""
    return ingest_delivery(spark, path, "", columns, as_of)[0]


def ingest_table(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    """A columnar (parquet) extract as delivered, plus audit columns."""
    return stamp_audit(spark.read.parquet(path), as_of)
