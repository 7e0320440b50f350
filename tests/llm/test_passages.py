"""Suffix-array dedup and decontamination against brute force on small and real tables."""

import random
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from greenledger.llm import queries as q
from greenledger.llm.decontaminate import contaminated, missed
from greenledger.llm.suffix_dedup import remove_passages, repeated_passages

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def brute_windows(docs, passage):
    """(doc, place) of every window that stands elsewhere too -> is it a duplicate."""
    places = defaultdict(set)
    texts = {}
    for d, t in docs:
        w = words(t)
        texts[d, t] = w
        for p in range(len(w) - passage + 1):
            places[tuple(w[p : p + passage])].add((d, p))
    out = {}
    for found in places.values():
        if len(found) > 1:
            first = min(found)
            for x in found:
                out[x] = x != first
    return out


def covered(windows, passage, dup):
    return {(d, p + i) for (d, p), x in windows.items() if x == dup for i in range(passage)}


def spans_cover(rows, dup):
    return {(r.doc_id, r.start_word + i) for r in rows if r.duplicate == dup for i in range(r.n_words)}


def check(spark, docs, passage, gram):
    got = repeated_passages(spark.createDataFrame(docs, SCHEMA), passage, gram).collect()
    want = brute_windows(docs, passage)
    for dup in (True, False):
        assert spans_cover(got, dup) == covered(want, passage, dup)
    return got


def test_passages_of_all_documents(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows = list(zip(docs.doc_id.tolist(), docs.text, strict=True))
    got = q.op5_suffix_array(spark, SF).collect()
    want = brute_windows(rows, 50)
    copies = {t: min(docs.doc_id[docs.text == t]) for t in docs.text[docs.text.duplicated()]}
    # of equal texts only one is searched: the others are duplicates as a whole
    later = {i for i, t in rows if copies.get(t, i) != i}
    for dup in (True, False):
        assert {x for x in spans_cover(got, dup) if x[0] not in later} == {
            x for x in covered(want, 50, dup) if x[0] not in later
        }
    assert {r.doc_id for r in got if r.duplicate} >= {i for i in later if len(words(dict(rows)[i])) >= 50}
    assert any(r.duplicate for r in got)


def test_passages_on_made_up_texts(spark):
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(12)]
    docs = [
        (1, " ".join(a)),
        (2, " ".join(b + a[5:30] + b)),  # a passage of 25 inside others
        (3, " ".join(a[:9] + ["x"] + a[9:20] + ["y"] + a[20:31])),  # runs of 9, 11 and 11
        (4, " ".join(b)),  # 12 words, twice in document 2
        (5, "z " * 60),  # repeats itself
        (6, ""),
        (7, None),
        (8, "one"),
    ]
    got = check(spark, docs, 10, 4)
    assert not {6, 7, 8} & {r.doc_id for r in got}
    cut = remove_passages(spark.createDataFrame(docs, SCHEMA), repeated_passages(spark.createDataFrame(docs, SCHEMA), 10, 4))
    left = {r.doc_id: r.text for r in cut.collect()}
    assert left[1] == " ".join(a) and 4 not in left and left[6] == "" and left[7] is None
    assert words(left[3]) == a[:9] + ["x"] + ["y"]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=30), min_size=1, max_size=6, unique_by=tuple))
def test_passages_on_few_words(spark, texts):
    check(spark, [(i, " ".join(t)) for i, t in enumerate(texts)], 6, 3)


def test_repeated_rows_null_ids_and_extra_columns(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(None, t, "k"), (4, t, "k"), (4, t, "k"), (5, "short", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ks string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.duplicate) for r in repeated_passages(df).collect())
    assert got == [(False, 0, False), (True, 4, True)]
    left = remove_passages(df, repeated_passages(df), length_col=None)
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == [(0, t), (5, "short")]
    assert repeated_passages(df.limit(0)).count() == 0
    assert remove_passages(df, repeated_passages(df)).columns == df.columns


def bag(w):
    return Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def brute_leaks(docs, items):
    norm = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = {}
    bags = [(i, x, bag(x)) for i, x in ((i, norm(x)) for i, x in items) if x]
    for d, t in docs:
        w = norm(t)
        mine = set(bag(w))
        for i, x, want in bags:
            if len(x) >= 5 and not mine & set(want):
                continue  # nothing shared: similarity 0
            best = 0
            for s in range(max(1, len(w) - len(x) + 1)):
                have = bag(w[s : s + len(x)]) if len(x) >= 5 else Counter([tuple(w[s : s + len(x)])])
                top = sum((have | want).values())
                best = max(best, sum((have & want).values()) / top)
            if best >= 0.8:
                out[d, i] = round(best, 9)
    return out


def test_leaks_of_all_documents(spark):
    docs, items = pd.read_parquet(f"{SF}/documents.parquet"), pd.read_parquet(f"{SF}/benchmark.parquet")
    want = brute_leaks(zip(docs.doc_id, docs.text, strict=True), list(zip(items.item_id, items.text, strict=True)))
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in q.op4_decontaminate(spark, SF).collect()}
    assert got == want and want


def test_leaks_with_changes(spark):
    item = [f"w{i}" for i in range(46)]
    filler = [f"f{i}" for i in range(70)]
    one = item[:1] + ["new"] + item[2:]
    docs = [
        (1, " ".join(filler + item + filler)),
        (2, " ".join(filler + one + filler).upper()),
        (3, " ".join(filler + item[:3] + ["in"] + item[3:] + filler)),  # a word put in
        (4, " ".join(filler + item[:43] + item[44:] + filler)),  # a word left out
        (5, " ".join(item[3:])),  # shorter than the item
        (6, " ".join(filler + item[:20] + filler)),  # too little of it
        (7, " ".join(filler + [w if i % 9 else "z" for i, w in enumerate(item)])),
        (8, " ".join(filler + ["red", "fox"] + filler)),
        (9, "a b " * 200),
        (10, None),
        (11, ""),
        (None, " ".join(item)),
    ]
    items = [(1, ", ".join(item)), (2, "red fox"), (3, "a b " * 10), (4, None), (5, ""), (1, ", ".join(item))]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, w string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in contaminated(df, bench).collect()}
    want = brute_leaks(docs, items)
    assert got == want
    assert {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (8, 2), (9, 3), (None, 1)} <= set(got)
    assert contaminated(df.limit(0), bench).count() == 0
    assert contaminated(df, bench.limit(0)).count() == 0
    with pytest.raises(ValueError):
        contaminated(df, bench, threshold=0.5)


def test_leaks_of_many_items_of_one_size(spark):
    rng = random.Random(5)
    frame = [f"q{i}" for i in range(12)]  # words that all items share
    items = [(i, " ".join(frame + [f"v{rng.randrange(400)}" for _ in range(24)])) for i in range(60)]
    items += [(100 + i, " ".join(rng.choice("ab") for _ in range(12))) for i in range(10)]
    docs = []
    for d, (_, t) in enumerate(items):
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        docs.append((None if d % 3 else d, " ".join(["x"] * rng.randrange(9) + w + frame)))
    docs += [(None, " ".join(rng.choice("ab") for _ in range(60))) for _ in range(10)]
    docs += docs[:5]
    far = (900, " ".join(f"y{i}" for i in range(200_000)) + " " + items[7][1])  # a very long text
    df = spark.createDataFrame([*docs, far], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(900, 7): 1.0}
    for n, (d, t) in enumerate(docs):
        for (_, i), x in brute_leaks([(n, t)], items).items():
            want[d, i] = max(x, want.get((d, i), 0))
    rows = contaminated(df, bench).collect()
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in rows}
    assert got == want and len(rows) == len(got)


def test_missed_share_of_the_default_radius():
    assert missed(26, 3 / 16) < 2e-5 and missed(26, 0.162) < 1e-6  # shortest windows; all others
