"""CSV extracts bound by each file's own header."""

import json

from greenledger.operators import quality
from greenledger.sources.extracts import MALFORMED, ingest_delivery, ingest_extract

COLUMNS = ("loan_id", "as_of_date", "amount")


def deliver(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def read(spark, path, columns=COLUMNS):
    rows, findings = ingest_delivery(spark, path, "loans", columns, "2025-12-31")
    got = sorted(((r._source_file, *(r[c] for c in columns), r[MALFORMED]) for r in rows.collect()), key=repr)
    said = sorted((r.business_key, r.reject_reason, json.loads(r.details)["column"], r.rejected_rows) for r in findings.collect())
    return got, said


def test_columns_follow_the_header(spark, tmp_path):
    path = deliver(
        tmp_path,
        a="loan_id,as_of_date,amount\n1,2025-12-31,5\n",
        b="amount,loan_id,as_of_date\n6,2,2025-12-30\n",
        c="﻿Loan_ID, AMOUNT ,note,as_of_date\n3,7,hello,2025-12-29\n",
        d="amount,loan_id\n8,4\n",
    )
    got, said = read(spark, path)
    assert got == [
        ("a.csv", "1", "2025-12-31", "5", None),
        ("b.csv", "2", "2025-12-30", "6", None),
        ("c.csv", "3", "2025-12-29", "7", None),
        ("d.csv", "4", None, "8", None),
    ]
    assert said == [("c.csv", "unknown_column", "note", 0), ("d.csv", "missing_column", "as_of_date", 0)]


def test_swapped_text_columns_do_not_pass_unnoticed(spark, tmp_path):
    path = deliver(tmp_path, a="y,x\nwhy,ex\n", b="x,y\nex,why\n")
    got, said = read(spark, path, ("x", "y"))
    assert [r[1:3] for r in got] == [("ex", "why"), ("ex", "why")] and said == []


def test_torn_lines_quotes_and_repeated_names(spark, tmp_path):
    path = deliver(
        tmp_path,
        a='loan_id,as_of_date,amount\n1,2\n1,2,3,4\n"a,b","","q x"\n',
        b="amount,loan_id,as_of_date,amount\n1,2,3,4\n1,2,3\n",
        empty="",
        only_header="as_of_date,amount,loan_id\n",
    )
    got, said = read(spark, path)
    assert sorted((r[0], r[4]) for r in got if r[4]) == [("a.csv", "1,2"), ("a.csv", "1,2,3,4"), ("b.csv", "1,2,3")]
    assert ("a.csv", "a,b", None, "q x", None) in got
    assert all(reason in ("missing_column", "unknown_column") and file == "b.csv" for file, reason, _, _ in said) and said


def test_folder_without_rows(spark, tmp_path):
    rows, findings = ingest_delivery(spark, deliver(tmp_path, empty=""), "loans", COLUMNS, "2025-12-31")
    assert rows.count() == 0 and findings.count() == 0
    assert rows.columns == [*COLUMNS, MALFORMED, "_ingested_at", "_source_file", "_batch_id"]


def test_findings_are_ledger_rows(spark, tmp_path):
    path = deliver(tmp_path, a="loan_id,colour\n1,red\n")
    _, findings = ingest_delivery(spark, path, "loans", COLUMNS, "2025-12-31")
    ledger = quality.reject_ledger([quality.empty_ledger(spark), findings])
    assert ledger.schema == quality.empty_ledger(spark).schema
    assert quality.reject_counts(ledger).where("rejected_rows = 0").count() == 2
    assert quality.reject_ledger([], spark).count() == 0
    assert ingest_extract(spark, path, COLUMNS, "2025-12-31").count() == 1
