"""One routed pass per source: every row is typed and judged once, then read by its outcome.

``route`` writes two tables per source:

- the typed rows with their reject reason, partitioned by outcome (good or rejected);
- one row per duplicated key: the surviving row and how many rows had that key.

Clean rows, ledger and row counts all read these, so none of them types a source again.

The dedupe has two phases. Hashes of the keys are counted first, by a hash aggregate that shuffles two longs
a row at most; only rows whose hash occurs twice or more go on to the choice of the survivor, which has to sort
and goes by the keys themselves, so that a collision of hashes costs a little work and changes nothing.
Rows of unique keys, nearly all, are neither sorted nor shuffled by it where the duplicated keys
are few enough to be broadcast (Spark decides by the written table's size), and meet them in one
shuffled anti-join otherwise. A hot key is one row after the map side of the count, and again after the map
side of the choice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.operators.metrics import metric
from greenledger.operators.quality import (
    CleanSpec,
    duplicate_entries,
    reason_column,
    reject_entries,
    survivors,
    typed_frame,
)
from greenledger.sources.extracts import MALFORMED
from greenledger.sources.tables import materialize

OUTCOME, REASON, COPIES, KEY_HASH = "_outcome", "_reject_reason", "_n", "_key_hash"
GOOD, REJECTED = "good", "rejected"
#: Sources routed at the same time; their jobs are independent and mostly small.
AT_ONCE = 4

#: Writes a frame under a name, partitioned by columns, and reads it back.
Sink = Callable[[DataFrame, str, tuple[str, ...]], DataFrame]


@dataclass(frozen=True)
class Routed:
    """A source after its routed pass; ``duplicated`` is None where the contract does not dedupe."""

    spec: CleanSpec
    rows: DataFrame
    duplicated: DataFrame | None

    def _of(self, outcome: str) -> DataFrame:
        return self.rows.where(F.col(OUTCOME) == outcome)

    def clean(self) -> DataFrame:
        """One row per key: those of unique keys as they are, and the survivor of each duplicated key."""
        good = self._of(GOOD).drop(OUTCOME, REASON)
        if self.duplicated is not None:
            unique = good.join(self.duplicated.select(*self.spec.key), list(self.spec.key), "left_anti")
            good = unique.unionByName(self.duplicated.drop(COPIES))
        return good.drop(MALFORMED)

    def ledger(self) -> DataFrame:
        """Rejected rows plus one entry per duplicated key."""
        rejected = self._of(REJECTED)
        columns = [c for c in rejected.columns if c not in (OUTCOME, REASON)]
        entries = reject_entries(rejected, self.spec, F.col(REASON), columns)
        if self.duplicated is None:
            return entries
        row = F.struct(*[F.col(c) for c in columns])
        return entries.unionByName(duplicate_entries(self.duplicated, self.spec.key, self.spec.name, row, F.col(COPIES)))

    def counts(self, step: str) -> list[DataFrame]:
        """Metric rows of ``step`` to be summed: input = output + rejected + duplicates."""
        good, rejected = F.count_if(F.col(OUTCOME) == GOOD), F.count_if(F.col(OUTCOME) == REJECTED)
        parts = [metric(self.rows, step, {"input_rows": F.count(F.lit(1)), "output_rows": good, "rejected_rows": rejected})]
        if self.duplicated is not None:
            dropped: Column = F.sum(F.col(COPIES) - 1)
            parts.append(metric(self.duplicated, step, {"duplicate_rows": dropped, "output_rows": -dropped}))
        return parts


def to_checkpoint(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The default sink: a table in the shared checkpoint folder."""
    return materialize(df, name, partition_by)


def route(raw: DataFrame, spec: CleanSpec, sink: Sink = to_checkpoint) -> Routed:
    """Type and judge every row of a landing extract once, and write the outcome.

    Nulls and blanks in a key are rejected by the contract, so keys of good rows compare plainly. An empty
    extract gives empty tables. Rows equal in all columns are duplicates like any other.
    """
    typed = typed_frame(raw, spec)
    judged = typed.withColumn(REASON, reason_column(spec, typed))
    outcome = F.when(F.col(REASON).isNull(), F.lit(GOOD)).otherwise(F.lit(REJECTED))
    rows = sink(judged.withColumn(OUTCOME, outcome), f"routed_{spec.name}", (OUTCOME,))
    if not (spec.dedupe and spec.key):
        return Routed(spec, rows, None)
    good = rows.where(F.col(OUTCOME) == GOOD).drop(OUTCOME, REASON)
    keys = list(spec.key)
    hashed = good.withColumn(KEY_HASH, F.xxhash64(*keys))
    repeated = hashed.groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias(COPIES)).where(F.col(COPIES) > 1).select(KEY_HASH)
    candidates = hashed.join(repeated, KEY_HASH, "left_semi").drop(KEY_HASH)
    chosen = survivors(candidates, keys, spec.order).where(F.col(COPIES) > 1)
    kept = [F.col(c) if c in keys else F.col(f"_w.r.{c}").alias(c) for c in good.columns]
    return Routed(spec, rows, sink(chosen.select(*kept, COPIES), f"duplicated_{spec.name}", ()))


def route_all(extracts: Mapping[str, DataFrame], specs: Mapping[str, CleanSpec], sink: Sink = to_checkpoint) -> dict[str, Routed]:
    """Route every source of ``specs``, a few at a time."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        done = pool.map(lambda name: route(extracts[name], specs[name], sink), specs)
        return dict(zip(specs, done))
