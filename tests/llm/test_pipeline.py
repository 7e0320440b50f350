"""The pipeline's stages against brute force, stage by stage on each stage's own input."""

import re

import pandas as pd

import corpus_pipeline as cp
from greenledger.llm import queries as q
from greenledger.llm.simhash_dedup import simhash
from greenledger.llm.toxicity import fit_from, toxic_spans

from .test_contracts import components
from .test_passages import SF, brute_leaks, brute_windows, words


def test_stages(spark):
    docs = q.table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_copies", "passages", "benchmark_leaks", "packing"]

    model = fit_from(docs, q.table(spark, SF, "labels"))
    want = {r.doc_id for r in toxic_spans(docs, model).where("predicted = 0").collect()}
    clean = cp.toxicity(spark, docs, SF)
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == want
    assert 0 < len(want) < docs.count()

    clean = cp.stored(clean, "test")
    rows = clean.toPandas()
    fps = {i: simhash(t) for i, t in zip(rows.doc_id, rows.text, strict=True)}
    label = components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    kept = cp.near_copies(spark, clean, SF)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {i for i, c in label.items() if i == c}

    kept = cp.stored(kept, "test")
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    gone = {(d, p + i) for (d, p), dup in brute_windows(rows, 50).items() if dup for i in range(50)}
    want = {d: [w for i, w in enumerate(words(t)) if (d, i) not in gone] for d, t in rows}
    cut = cp.passages(spark, kept, SF)
    got = {r.doc_id: (words(r.text), r.n_chars, r.text) for r in cut.collect()}
    assert cut.columns == columns
    assert {d: w for d, (w, _, _) in got.items()} == {d: w for d, w in want.items() if w or not words(dict(rows)[d])}
    assert all(n == len(t) for _, n, t in got.values())

    cut = cp.stored(cut, "test")
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    leaks = brute_leaks([(d, t) for d, (_, _, t) in got.items()], list(zip(items.item_id, items.text, strict=True)))
    left = cp.benchmark_leaks(spark, cut, SF)
    assert left.columns == columns
    assert {r.doc_id for r in left.collect()} == set(got) - {d for d, _ in leaks}

    packed = cp.packing(spark, cp.stored(left, "test"), SF).toPandas()
    assert set(packed.doc_id) == set(got) - {d for d, _ in leaks}
    assert (packed.groupby("sequence_id").length.sum() <= 2048).all()
    assert (packed.ids.map(len) == 4 * packed.length).all()


def test_near_copies_of_rows_without_ids(spark):
    text = "one two three four five six seven"
    rows = [(None, text, "en", "s", 3), (None, text, "en", "s", 3), (3, text, "en", "s", 3), (None, "other words here", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.text) for r in cp.near_copies(spark, docs, SF).collect())
    assert got == [(0, text), (0, "other words here")]
    assert cp.near_copies(spark, docs.limit(0), SF).count() == 0


def test_run_is_the_registered_query(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is cp.run
    found = {n for n in entry.queries() if re.match(r"op\d+_", n)}
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in found} == set(range(1, 14))
