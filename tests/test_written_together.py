"""Tables that do not depend on each other are written together, and an extract is computed once."""

import threading

from greenledger.plans import queries
from greenledger.sources import driver, tables


def test_independent_tables_are_written_at_the_same_time(monkeypatch):
    both = threading.Barrier(2, timeout=20)

    def write(df, name):
        both.wait()  # breaks unless another table is being written
        return f"{df} written as {name}"

    monkeypatch.setattr(tables, "materialize", write)
    assert tables.materialize_all({"a": 1, "b": 2}) == {"a": "1 written as a", "b": "2 written as b"}


def test_an_extract_is_computed_once_for_both_layouts(spark, tmp_path, monkeypatch):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    columns = queries.SPECS["crosswalk"].columns
    rows = spark.createDataFrame([(str(i), f"p{i}") for i in range(40)], ", ".join(f"{c} string" for c in columns))
    monkeypatch.setattr(driver, "landing_extracts", lambda *_: {"crosswalk": rows.mapInPandas(counted, rows.schema)})
    path = queries.deliver_csv(spark, "", str(tmp_path / "csv"))["crosswalk"]
    assert runs.value == 40
    lines = spark.read.text([f"{path}/plain", f"{path}/turned"]).count()
    assert lines >= 40 + 2
