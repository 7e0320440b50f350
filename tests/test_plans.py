"""Plan-shape regressions: what the scale review established stays true."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from greenledger.sources.tables import TableStore

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "LocalTableScan [")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["r01_equity", "r03_loans", "r06_pai", "r09_coverage", "reject_ledger", "step_metrics"])
def test_no_cross_joins_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for bad in FORBIDDEN[:4]:
        assert bad not in plan, (name, bad)


def test_scans_are_pruned_and_filtered(spark):
    plan = plan_of(entry.queries()["r01_equity"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_tax" not in s and "l_returnflag" not in s for s in lineitem)


def test_report_aggregates_combine_map_side(spark):
    plan = plan_of(entry.queries()["r01_equity"](spark, SF))
    assert "partial_sum" in plan and "partial_min" in plan


def test_date_filter_reaches_the_scan_side_of_the_dedupe(spark):
    """The as-of and fiscal-year predicates stand below the aggregates that pick one row per key."""
    from greenledger.plans.driver_book import driver_book

    book = driver_book(spark, SF)
    for table, column, value in (
        ("holdings", "as_of_date", F.lit("2000-12-31").cast("date")),
        ("loans", "as_of_date", F.lit("2000-12-31").cast("date")),
        ("company_financials", "fiscal_year", F.lit(2000)),
    ):
        plan = book.silver(table).where(F.col(column) == value)._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        dedupe = next(i for i, x in enumerate(lines) if "Aggregate" in x and "min(" in x)
        wanted = "2000" if column == "fiscal_year" else "2000-12-31|11322"
        assert any(re.search("Filter.*(" + wanted + ")", x) for x in lines[dedupe + 1 :]), (table, plan)


KEYED = "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 900) END"


def keyed_tables(spark):
    """Positions on a hot, a null and many cold keys, and attributes of all but some of the cold ones; written."""
    folder = tempfile.mkdtemp(prefix="greenledger-joins-")
    spark.range(12_000).selectExpr(f"{KEYED} AS k", "id", "repeat('x', 50) AS pad").repartition(6).write.parquet(f"{folder}/p")
    names = spark.range(0, 900, 1, 3).selectExpr("concat('k', id) AS k", "id * 10 AS v").where("v % 70 <> 0")
    names.unionByName(spark.createDataFrame([("hot", 1), (None, 2)], "k string, v long")).write.parquet(f"{folder}/a")
    return spark.read.parquet(f"{folder}/p"), spark.read.parquet(f"{folder}/a")


def test_heavy_hitters_are_bounded_and_never_null(spark):
    from greenledger.operators.joins import heavy_hitters

    rows, _ = keyed_tables(spark)
    assert {r.k: r.rows for r in heavy_hitters(rows, "k", 100).collect()} == {"hot": 3000}
    assert heavy_hitters(rows, "k", 100_000).count() > 100
    assert heavy_hitters(rows.limit(0), "k").count() == 0


def test_attributes_join_alike_with_and_without_heavy_hitters(spark):
    from greenledger.operators.joins import heavy_hitters, join_attributes

    rows, attrs = keyed_tables(spark)
    want = sorted(rows.join(attrs, "k", "left").select("k", "id", "v").collect(), key=lambda r: r.id)
    for heavy in (None, heavy_hitters(rows, "k"), heavy_hitters(rows, "k", 1), heavy_hitters(rows, "k", 10**6)):
        out = join_attributes(rows, attrs, "k", heavy)
        assert out.columns == ["k", "id", "pad", "v"]
        assert sorted(out.select("k", "id", "v").collect(), key=lambda r: r.id) == want


def test_hot_and_null_keys_are_not_shuffled(spark):
    """Rows of a hot or null key stay where they are read; attributes shuffle once, without copies."""
    from greenledger.operators.joins import heavy_hitters, join_attributes

    rows, attrs = keyed_tables(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_attributes(rows, attrs, "k", heavy_hitters(rows, "k", 100))
        plan = plan_of(out)
        assert "Generate explode" not in plan and "Union" in plan
        assert plan.count("SortMergeJoin") == 1
        # positions and attributes of the cold join; the counts of the key column (combined first)
        shuffled = out.withColumn("task", F.spark_partition_id()).groupBy("k", "task").count()
        tasks = {r.k: r.tasks for r in shuffled.groupBy("k").agg(F.count("*").alias("tasks")).collect() if r.k in ("hot", None)}
        assert tasks["hot"] >= 4 and tasks[None] >= 4  # as many as the scan has, not one
        cold = max(r["count"] for r in shuffled.where("k <> 'hot'").collect())
        assert cold < 3000 // 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_plain_join_splits_a_hot_key_at_run_time(spark):
    from greenledger.operators.joins import join_attributes

    rows, attrs = keyed_tables(spark)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = join_attributes(rows, attrs, "k")
        assert len(out.collect()) == 12_000
        assert "skew=true" in plan_of(out)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_partition_pruning_on_written_tables(spark):
    store = TableStore(tempfile.mkdtemp(prefix="greenledger-prune-"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").withColumn(
        "as_of_date", F.when(F.col("k") == "a", F.lit("2000-12-31")).otherwise(F.lit("1999-12-31")).cast("date")
    )
    store.write(df, "gold", "t", partition_by=("as_of_date",))
    read = store.read(spark, "gold", "t").where(F.col("as_of_date") == F.lit("2000-12-31").cast("date"))
    plan = plan_of(read)
    assert re.search(r"PartitionFilters: \[[^\]]*as_of_date", plan)
    assert [r["k"] for r in read.collect()] == ["a"]


def test_spread_only_when_under_split_and_copies_stay_balanced(spark):
    from greenledger.sources.parallel import spread

    cores = spark.sparkContext.defaultParallelism
    wide = spark.range(0, 2 * cores * 128 * 1024 * 1024 // 8)  # by its size estimate: a split for every core
    assert spread(wide, "id") is wide
    copies = spark.range(0, 8000, numPartitions=1).select(F.lit(7).alias("k"))  # one key, all copies
    spread_df = spread(copies, "k")
    sizes = spread_df.rdd.glom().map(len).collect()
    assert len(sizes) == cores and sum(sizes) == 8000
    assert max(sizes) - min(sizes) <= 1  # round-robin: a hot key or a block of copies cannot pile up
