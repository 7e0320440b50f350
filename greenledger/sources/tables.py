"""Layered table store (bronze / silver / gold / restricted) and report CSV sinks.

Tables are parquet folders under one base path per layer; the restricted
layer is a separate base so access can be granted separately. Writes replace
the table (schema included). Report CSVs are written by the executors as
part files (never collected to the driver).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Tables that are written at a time where they do not depend on each other.
WRITERS = 4
LAYERS = ("bronze", "silver", "gold", "restricted")


@dataclass(frozen=True)
class TableStore:
    """Where each layer lives; ``restricted_base`` defaults to a sibling of ``base``."""

    base: str
    restricted_base: str | None = None

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        if layer == "restricted":
            root = self.restricted_base or f"{self.base.rstrip('/')}_restricted"
            return f"{root}/{table}"
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.parquet(self.path(layer, table))

    def write(
        self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = (), only_partitions: bool = False
    ) -> str:
        """Replace the table, schema included: what ``df`` no longer has is gone.

        ``only_partitions`` replaces just the partitions that ``df`` has, for tables that runs of
        several dates write one date each.
        """
        path = self.path(layer, table)
        writer = df.write.mode("overwrite")
        if partition_by:
            mode = "dynamic" if only_partitions else "static"
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", mode)
        writer.parquet(path)
        return path


    def write_date(self, df: DataFrame, layer: str, table: str, as_of: str) -> None:
        """Replace one date's partition of a table, also by no rows; the other dates are not touched.

        The column ``as_of_date`` of ``df`` gives way to the partition's.
        """
        df.drop("as_of_date").write.mode("overwrite").parquet(f"{self.path(layer, table)}/as_of_date={as_of}")

    def read_date(self, spark: SparkSession, layer: str, table: str, as_of: str) -> DataFrame:
        """One date's partition, also one without rows, with its date."""
        path = self.path(layer, table)
        part = spark.read.parquet(f"{path}/as_of_date={as_of}")
        return part.withColumn("as_of_date", F.lit(as_of).cast("date"))


def write_report_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Headered CSV, null as an empty field. ``single_file`` only for reports known to be small."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)
    return path


def read_report_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a report CSV back with its schema (empty field -> null)."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as parquet under the session's shared checkpoint folder and read it back.

    Cuts lineage like a reliable checkpoint, but computes the plan once (a
    reliable RDD checkpoint of an uncached plan runs it twice) and keeps the
    data columnar, so readers get pruning and statistics. Read with the
    schema of ``df``: an empty partitioned table has no file to tell it.
    """
    from greenledger.session import checkpoint_dir  # local import: session helpers stay optional here

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/greenledger/{uuid.uuid4().hex}/{name}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if partition_by else spark.read.parquet(path)


def materialize_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """:func:`materialize` of frames that do not depend on each other, a few at a time.

    The last tasks of one table and the many short jobs of a small one leave cores idle, which another table's
    tasks use.
    """
    with ThreadPoolExecutor(WRITERS) as pool:
        return dict(zip(frames, pool.map(lambda name: materialize(frames[name], name), frames), strict=True))
