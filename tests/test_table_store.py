"""Every date of the table store is read back and compared, not one of them."""

from collections import Counter

import duckdb

import __spark_entry__ as entry
from tests.test_driver_oracle import SF, TABLES, _norm


def test_every_date_written_is_read_back(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(entry.oracle_sql()["table_store_dates"])
    df = entry.queries()["table_store_dates"](spark, SF)
    order = sorted(rel.columns)
    got = Counter(tuple(_norm(r[c]) for c in order) for r in df.collect())
    idx = [rel.columns.index(c) for c in order]
    assert got == Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert df.select("as_of_date").distinct().count() > 1
