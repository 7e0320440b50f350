"""A second run replaces tables whole: dates and columns that are gone do not come back."""

from greenledger.sources.tables import TableStore


def test_replace_drops_withdrawn_dates_and_takes_the_new_schema(spark, tmp_path):
    store = TableStore(str(tmp_path / "store"))
    first = spark.createDataFrame([("a", 1, "2024-12-31"), ("b", 2, "2025-12-31")], "k string, v int, d string")
    store.write(first, "silver", "t", ("d",))
    second = spark.createDataFrame([("c", 3.5, "new", "2025-12-31")], "k string, v double, more string, d string")
    store.write(second, "silver", "t", ("d",))
    got = store.read(spark, "silver", "t")
    assert set(got.columns) == {"k", "v", "more", "d"} and dict(got.dtypes)["v"] == "double"
    assert [(r.k, r.v, r.more) for r in got.collect()] == [("c", 3.5, "new")]


def test_one_date_leaves_the_others(spark, tmp_path):
    store = TableStore(str(tmp_path / "store"))
    two = spark.createDataFrame([("a", "2024-12-31"), ("b", "2025-12-31")], "k string, d string")
    store.write(two, "gold", "t", ("d",))
    store.write(spark.createDataFrame([("c", "2025-12-31")], "k string, d string"), "gold", "t", ("d",), only_partitions=True)
    assert sorted(r.k for r in store.read(spark, "gold", "t").collect()) == ["a", "c"]
