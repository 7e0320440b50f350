"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is executed in full with the no-op sink (every row produced, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from greenledger.plans.queries import queries  # noqa: E402
from greenledger.session import get_session  # noqa: E402

HEADLINE = (
    "clean_holdings",
    "reject_ledger",
    "entity_map",
    "financed_emissions",
    "r01_equity",
    "r02_bonds",
    "r03_loans",
    "r04_quality",
    "r05_waci",
    "r06_pai",
    "r07_fossil",
    "r08_taxonomy",
    "r09_coverage",
    "recon_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    registry = queries()
    # Warm the JVM (class loading, codegen caches) on the smallest data set; not timed.
    registry["r01_equity"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        if name not in registry:
            continue
        t0 = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(match.group(1)) if match else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
