"""greenledger: Spark-native sustainable-finance analytics.

Every calculation is a pure function ``DataFrame... -> DataFrame`` built from
Spark's own expressions, joins and aggregates, so Catalyst plans it and the
cluster scales it. I/O lives only in :mod:`greenledger.sources` and the run
plan in :mod:`greenledger.plans.pipeline`.
"""

__version__ = "0.1.0"
