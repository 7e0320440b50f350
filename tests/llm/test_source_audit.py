"""Source audit against a plain reading of the contract, without cells."""

import re
from collections import Counter, defaultdict

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from greenledger.llm import source_audit as a

LOWER = {c: c + 32 for c in range(65, 91)}
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top):
    rows = [(x or "", s or "", [w.translate(LOWER) for w in TERM.findall(t or "")]) for x, s, t in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = Counter(w for _, _, ws in mine for w in set(ws))
        kept = [w for w, n in df.items() if n >= min_docs]
        uses = defaultdict(Counter)
        for _, s, ws in mine:
            uses[s].update(ws)
        whole = Counter(w for _, _, ws in mine for w in ws)

        def freq(c, kept=kept):
            total = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 5) // (total + 5 * len(kept)) for w in kept}

        q, p = freq(whole), {s: freq(uses[s]) for s in {r[1] for r in mine}}
        for s in p:
            pair = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in p if o != s]
            term = [(p[s][w] - q[w], w) for w in kept if uses[s][w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out.update((lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:limit]))
    return out


def audited(spark, rows, min_docs, top):
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    docs = docs.selectExpr("*", "1 AS term", "2 AS p", "3 AS block", "4 AS slice", "5 AS n")
    got = [tuple(r) for r in a.source_divergence(docs, min_docs, top).collect()]
    assert len(got) == len(set(got))
    return set(got)


ROWS = [
    ("en", "a", "The the cat"), ("en", "a", "the dog"), ("en", "b", "The DOG dog dog"), ("en", "b", None), ("en", None, ""),
    ("en", "a", "the dog"), (None, None, "x y x"), (None, "a", "x"), ("de", "c", "Äpfel äpfel"), ("de", "d", "Äpfel z"),
    ("fr", "only", "seul"), ("xx", "p", "unkept"), ("xx", "q", "1 2 _ @"), ("en", "c", "tie1tie_tie~ÿéZ"),
]


def test_against_brute_force(spark):
    for min_docs, top in ((1, 50), (2, 50), (2, 1), (1, 2)):
        assert audited(spark, ROWS, min_docs, top) == brute(ROWS, min_docs, top)


def test_ties_beyond_the_limit_and_blocks(spark, monkeypatch):
    # one source with 60 terms of equal departure; many sources in small blocks and slices
    rows = [("en", f"s{i % 9}", " ".join(f"w{chr(97 + (i * j) % 26)}" for j in range(30))) for i in range(60)]
    rows += [("en", "own", " ".join(f"t{chr(97 + j // 26)}{chr(97 + j % 26)}é" for j in range(60)))] * 2
    want = brute(rows, 2, 50)
    assert audited(spark, rows, 2, 50) == want
    monkeypatch.setattr(a, "SOURCE_BLOCK", 2)
    monkeypatch.setattr(a, "SLICE_ROWS", 40)
    assert audited(spark, rows, 2, 50) == want


def test_large_counts_stay_exact(spark):
    for n, total, v in ((10**15, 3 * 10**15 + 7, 10**6), (0, 10**16, 3), (10**16 - 1, 10**16, 1)):
        row = spark.sql(f"SELECT {n}L AS n, {total}L AS total, {v}L AS v").select(
            a._frequency(a.F.col("n"), a.F.col("total"), a.F.col("v")).alias("p")
        )
        assert row.first().p == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_empty_and_long(spark):
    docs = spark.createDataFrame([("en", "a", "word " * 500_000 + "end"), ("en", "b", "word")], "lang string, source string, text string")
    assert a.source_divergence(docs.limit(0)).count() == 0
    got = {(r.term, r.source): r.n for r in a.term_counts(docs).collect()}
    assert got[("word", "a")] == 500_000 and got[("end", "a")] == 1 and got[(None, "a")] == 0


@settings(max_examples=50, suppress_health_check=[HealthCheck.function_scoped_fixture], deadline=None)
@given(st.text(alphabet="aZ é\n.日", max_size=60))
def test_slices_keep_terms_whole(text):
    want = [w.translate(LOWER).encode() for w in TERM.findall(text)]
    old, a.SLICE = a.SLICE, 7
    try:
        assert sum((list(x) for x in a._slices(text.encode())), []) == want
    finally:
        a.SLICE = old


def test_registered_query_counts_whole_tables(spark):
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    rows = list(zip(docs.lang, docs.source, docs.text, strict=True))
    assert audited(spark, rows, 30, 50) == brute(rows, 30, 50)
