"""Nulls, empty tables, ties, repeated rows, hot groups and clashing columns, operator by operator."""

import itertools
import os
import uuid
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from greenledger.llm import chat_format as chat
from greenledger.llm import embedding_dedup as emb
from greenledger.llm import packing, sharding, toxicity, warc
from greenledger.llm.queries import tokenizer_path
from greenledger.llm.simhash_dedup import link_fingerprints, simhash, simhash_near_dedup
from greenledger.llm.token_files import read_token_files, write_token_files
from greenledger.session import checkpoint_dir

from .test_contracts import components


def brute_links(rows, threshold):
    """row number -> linked row numbers."""
    out = defaultdict(set)
    good = [i for i, (_, v, lab) in enumerate(rows) if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for i, j in itertools.combinations(good, 2):
        (_, a, la), (_, b, lb) = rows[i], rows[j]
        if la == lb and len(a) == len(b):
            a, b = np.array(a, float), np.array(b, float)
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                out[i].add(j)
                out[j].add(i)
    return out


def test_embeddings_in_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(emb, "CELL", 4)
    monkeypatch.setattr(emb, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows = []
    for label in (1, 2):
        for _ in range(12):  # chains and clusters around the threshold
            v = rng.standard_normal(16)
            for _ in range(rng.integers(1, 9)):
                rows.append((len(rows), v.tolist(), label))
                v = v + rng.standard_normal(16) * 0.18
    hot = rng.standard_normal(16)
    rows += [(len(rows) + i, (hot + rng.standard_normal(16) * 0.02).tolist(), 1) for i in range(60)]
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [float("nan")] * 16, 1), (1004, [None] * 16, 1),
             (1005, hot.tolist(), None), (1006, hot[:8].tolist(), 1), (1007, (hot * 3).tolist(), 1), (1007, hot.tolist(), 1), (1008, hot.tolist(), 1)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, label int, key int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in emb.embedding_near_dedup(df, 0.98).collect())
    linked = brute_links(rows, 0.98)
    label = components(range(len(rows)), [(i, j) for i in linked for j in linked[i]])
    least = defaultdict(lambda: 10**9)
    for i, c in label.items():
        least[c] = min(least[c], rows[i][0])
    assert got == sorted((rows[i][0], len(linked[i]), least[label[i]]) for i in range(len(rows)))
    assert emb.embedding_near_dedup(df.limit(0)).count() == 0


def test_probes_cover_all_small_flips():
    key = np.array([0.05, -0.2, 0.01, 0.08])
    want = {sum(1 << i for i in c) for n in range(5) for c in itertools.combinations(range(4), n) if sum(key[i] ** 2 for i in c) <= 0.01}
    assert set(emb.probes(key, 0.01)) == want


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_ball_hashing_misses_no_pair(spark, radius):
    rng = np.random.default_rng(radius)
    fps = set()
    for _ in range(25):
        x = int(rng.integers(0, 2**63))
        for _ in range(6):
            fps.add(x)
            for i in rng.choice(64, rng.integers(0, radius + 2), replace=False):
                x ^= 1 << int(i)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = [(r.a, r.b) for r in link_fingerprints(df, radius).collect()]
    near = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) % 2**64).bit_count() <= radius]
    assert all(((a ^ b) % 2**64).bit_count() <= radius for a, b in got)
    assert components(signed, got) == components(signed, near)


def test_simhash_of_empty_texts_and_repeated_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "a b", 0), (4, "a b", 0), (None, "A  b", 0), (6, "x y z w", 0)]
    got = simhash_near_dedup(spark.createDataFrame(rows, "doc_id long, text string, fp int"))
    have = Counter((r.doc_id, r.fingerprint, r.component_id) for r in got.collect())
    ab = f"{simhash('a b'):016x}"
    assert have == Counter({(1, "0" * 16, 1): 1, (2, "0" * 16, 1): 1, (3, "0" * 16, 1): 1, (4, ab, 4): 2, (None, ab, 4): 1,
                            (6, f"{simhash('x y z w'):016x}", 6): 1})
    assert simhash_near_dedup(got.limit(0).select("doc_id", F.col("fingerprint").alias("text"))).count() == 0


TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "<|turn|>x<|text|>y<|end|>", r"<\|end|> <\\|a [\INST] [\\/INST]", "<<|s>", "[[INST]", "<s></s>", "a\n<|", None, "日本😀"]


def test_chat_windows(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], t, "w") for i, t in enumerate(TEXTS)]
    rows += [(2, 0, "system", "be kind", "w")] + [(2, i, ["user", "assistant"][i % 2], f"turn {i} " + "x" * (7 * i % 90), "w") for i in range(1, 700)]
    rows += [(3, None, None, None, "w"), (3, 5, "assistant", "twice", "w"), (3, 5, "assistant", "twice", "w"), (None, 1, "assistant", "no id", "w")]
    rows += [(4, 0, "user", "y" * 3000, "w"), (4, 1, "assistant", "short", "w")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    out = chat.chat_windows(df, budget=200, history=40)
    seen = out.select("*", chat.read_turns(F.col("formatted")).alias("turns")).orderBy("conv_id", "window").collect()
    told = defaultdict(list)
    for r in seen:
        turns = [(t["role"], t["text"]) for t in r.turns]
        assert len(turns) == r.n_turns
        told[r.conv_id] += turns[r.context_turns :]
        if r.conv_id == 2:
            assert turns[0] == ("system", "be kind") and r.n_tokens <= 200 and not r.over_budget
            context = turns[1 : r.context_turns]
            assert (r.window == 0) == (r.context_turns == 0)
            fresh_before = told[2][: -len(turns[r.context_turns :])]
            assert context == fresh_before[len(fresh_before) - len(context) :]
        spans = [r.formatted[s["start"] : s["start"] + s["len"]] for s in r.loss_spans]
        assert len(spans) == sum(role == "assistant" for role, _ in turns[r.context_turns :])
    order = lambda c: sorted([(t if t is not None else -1, ro or "", x or "") for i, t, ro, x, _ in rows if i == c])
    assert told == {c: [(ro, x) for _, ro, x in order(c)] for c in (1, 2, 3, 4, None)}
    assert any(r.context_turns > 2 for r in seen if r.conv_id == 2)
    assert [r.over_budget for r in seen if r.conv_id == 4] == [True, False]
    assert chat.chat_windows(df.limit(0)).count() == 0


def test_escape_is_reversible(spark):
    parts = ["<", "|", "\\", "[", "INST]", "/INST]", "s>", "/s>", "a"]
    texts = ["".join(x) for n in range(1, 5) for x in itertools.product(parts, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    bad = df.where((chat.unescape(F.col("e")) != F.col("t")) | F.col("e").rlike(r"<\||</?s>|\[/?INST\]"))
    assert bad.count() == 0


def test_warc_chunks_and_revisits(spark):
    big = "é" * 1_300_000
    rows = [(5, "u", big, 1), (3, "v", big, 1), (9, None, None, 1), (8, "a b", "", 1), (7, "u", "tiny", 1), (7, "u", "tiny", 1), (None, "n", "tiny", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    chunks = warc.read_warc(warc.archive_pages(spark, df)).cache()
    mine = sorted((r.chunk, r.start, r.length, r.last) for r in chunks.where("page_id = 3").collect())
    assert mine == [(0, 0, 1 << 20, False), (1, 1 << 20, 1 << 20, False), (2, 2 << 20, 2_600_000 - (2 << 20), True)]
    data = b"".join(bytes(r.data) for r in chunks.where("page_id = 3").orderBy("chunk").collect())
    assert data == big.encode()
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.page_records(chunks).collect())
    assert got == [(0, 4, "revisit", 7), (3, 2_600_000, "response", None), (5, 2_600_000, "revisit", 3), (7, 4, "response", None),
                   (7, 4, "response", None), (8, 0, "response", None), (9, 0, "revisit", 8)]
    few = warc.page_records(warc.read_warc(warc.archive_pages(spark, df, min_bytes=5)))
    assert {r.page_id for r in few.where("record_type = 'revisit'").collect()} == {5}
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    assert warc.page_records(warc.read_warc(warc.archive_pages(spark, df.limit(0), path))).count() == 0
    assert not os.path.exists(path.removeprefix("file:"))


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 300), st.integers(1, 200), max_size=20), st.integers(1, 7))
def test_deal_is_longest_processing_time(classes, shards):
    cuts = sharding.deal([(s, n, s * n) for s, n in classes.items()], shards)
    load = [0] * shards
    for s, n in sorted(classes.items(), reverse=True):
        for _ in range(n):
            i = min(range(shards), key=lambda k: (load[k], k))
            load[i] += s
    mine = [0] * shards
    for s, c in cuts:
        assert c[-1] == classes[s]
        for i, (a, b) in enumerate(zip([0, *c[:-1]], c, strict=True)):
            mine[i] += (b - a) * s
    assert sorted(mine) == pytest.approx(sorted(load))


def test_sharding_of_nulls_copies_and_empty_tables(spark):
    rows = [(i, "same text", 0) for i in range(30)] + [(100, None, 0), (None, None, 0), (101, "", 0), (102, "", 0), (103, "x", 0), (103, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard_documents(df, shards=3).collect()
    assert len(got) == len(rows)
    shard = {r.doc_id: r.shard for r in got}
    assert len({shard[i] for i in range(30)}) == 1 and shard[100] == shard[None] and shard[101] == shard[102]
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got if r.doc_id in (100, 101)} == {100: (1, 0), 101: (1, 0)}
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_documents(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_best_two_fit_uses_every_piece_once(counts):
    plan = packing.best_two_fit(counts, 40)
    used = Counter()
    for pattern, bins in plan:
        assert bins > 0 and sum(x * n for x, n in pattern) <= 40
        for x, n in pattern:
            used[x] += n * bins
    assert used == Counter(counts)


def test_best_two_fit_replaces_the_smallest():
    # greedy fills 6 + 3 and leaves 1; 3 gives way to 2 + 2, which fill the bin
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == ([(6, 1), (2, 2)], 1)


def test_packing_and_token_files_of_odd_rows(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = [(3, "one two", 1), (1, None, 1), (None, "no id", 1), (2, "", 1), (2, "", 1), (-5, "minus", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    packed = packing.pack_documents(df, path, 0, 4, keep_ids=True)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.length, len(r.ids)) for r in packed.collect())
    assert len(got) == 6 and all(n == 4 * length for *_, length, n in got)
    assert all(r.n_tokens <= 4 and len(r.ids) == 4 * r.n_tokens for r in packing.sequences(packed).collect())
    assert packing.pack_documents(df.limit(0), path, 0).count() == 0
    files = write_token_files(df, path, 2)
    got = sorted(((r.start, r.doc_id, r.n_tokens) for r in read_token_files(files).collect()))
    assert [d for _, d, _ in got] == [None, -5, 1, 2, 2, 3]
    assert all(a[0] + a[2] == b[0] for a, b in itertools.pairwise(got)) and got[2][2] == 1
    assert read_token_files(write_token_files(df.limit(0), path, 2)).count() == 0


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    moves = (0.7, 0.4, 0.6, 1.9)  # toxic-toxic, clean-toxic, toxic-clean, clean-clean
    weight = {(1, 1): moves[0], (0, 1): moves[1], (1, 0): moves[2], (0, 0): moves[3]}
    docs = [rng.standard_normal(n) * 2 for n in (0, 1, 2, 5, 7)]
    for scores, got in zip(docs, toxicity.marginals(docs, moves), strict=True):
        total, each = 0.0, np.zeros(len(scores))
        for tags in itertools.product((0, 1), repeat=len(scores)):
            w = np.exp(sum(s for s, t in zip(scores, tags, strict=True) if t)) * np.prod([weight[x] for x in itertools.pairwise(tags)])
            total += w
            each += w * np.array(tags)
        assert got == pytest.approx(each / total if len(scores) else each)


def test_toxicity_of_odd_rows_and_held_out_accuracy(spark):
    model = toxicity.fit([], [])
    rows = [(1, None, 1), (2, "", 1), (2, "", 1), (None, "fine", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    assert [r.predicted for r in toxicity.toxic_spans(df, model).collect()] == [0] * 4
    assert toxicity.toxic_spans(df.limit(0), model).count() == 0 and toxicity.drop_toxic(df, model).count() == 4
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.toxic_spans(docs, toxicity.fit_from(docs, labels)).join(labels, "doc_id")
    held = scored.where(toxicity.fold(F.col("doc_id")) == 0).select("predicted", "toxic", "score", "spans").collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in held)
    assert sum(bool(r.spans) for r in held if r.toxic) >= 0.9 * sum(r.toxic for r in held)
