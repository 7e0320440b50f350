"""LM scoring: counts and base scores against plain Python, the model as a distribution, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from greenledger.llm import lm_scoring as m
from greenledger.llm import queries as q
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))] + [b""]


def base_scores(rows, training):
    c = Counter(w for (_, x), t in zip(rows, training, strict=True) if t for w in tokens(x))
    n, v = sum(c.values()), len(c)
    out = []
    for _, x in rows:
        ts = tokens(x)
        score = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ts)
        out.append((len(ts), sum(c[w] > 0 for w in ts), n, score))
    return out


@pytest.fixture(scope="module")
def scored(spark):
    return q.op12_lm_scoring(spark, SF).toPandas().set_index("doc_id").sort_index()


def test_counts_and_base_scores(scored):
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in docs.doc_id]
    want = base_scores(list(zip(docs.doc_id, docs.text, strict=True)), [not x for x in held])
    assert scored.index.tolist() == docs.doc_id.tolist()
    assert scored.held_out.tolist() == held and any(held)
    for got, (n, known, total, base) in zip(scored.itertuples(), want, strict=True):
        assert (got.n_tokens, got.n_known, got.train_tokens) == (n, known, total)
        assert got.base_score == pytest.approx(base, rel=1e-9)
        assert got.score < 0


def test_held_out_texts_are_likelier_than_by_counts(spark):
    got = q.op12_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").agg(
        *[F.sum(c).alias(c) for c in ("score", "base_score", "n_tokens")]
    ).first()
    assert got.score > got.base_score + 0.02 * got.n_tokens


def trained(spark, texts, **settings):
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    return m.train_language_model(docs, **settings)


def test_probabilities_sum_to_one(spark):
    texts = [" ".join(f"w{i * k % 17}" for i in range(40)) + " Ünï längere, rare%d" % k for k in range(30)]
    model, counts = trained(spark, texts, predicted=6, known=12)
    units, before = np.arange(model.units, dtype=np.int32), np.tile([[2, 5]], (model.units, 1)).astype(np.int32)
    p = np.exp(model.log_probs(units, before))
    assert p.sum() == pytest.approx(1, abs=1e-5)
    # words of a class share it: known ones, met ones, and one that was never met
    share, unit_of = model.share(), model.unit_of()
    total = sum(p[unit_of[i]] * 10 ** share[i] for i in range(len(model.words)))
    listed = set(model.words)
    for r in counts.collect():
        if bytes(r.word) not in listed:
            at = len(model.words) + m.shape(bytes(r.word))
            total += p[unit_of[at]] * 10 ** share[at] * (r.n + 1)
    for s in range(8):
        at = len(model.words) + s
        total += p[unit_of[at]] * 10 ** share[at]
    assert total == pytest.approx(1, abs=1e-5)


def test_log_probs_by_hand(spark):
    model, _ = trained(spark, ["a b a b c", "b a c c"] * 5, predicted=4)
    doc = np.array([1, 2, 3, 2, 0], np.int32)
    units, before = model.history([doc, doc[:2]])
    assert before.tolist() == [[0, 0], [1, 0], [2, 1], [3, 2], [2, 3], [0, 0], [1, 0]]
    got = model.log_probs(units, before)
    for u, (v, w), x in zip(units, before, got, strict=True):
        s = (model.context[v] @ model.mix[0] + model.context[w] @ model.mix[1]) @ model.target.T + model.bias
        s = np.delete(s, range(4, 12))  # no known word outside the predicted ones
        assert x == pytest.approx(s[u] - np.log(np.exp(s).sum()), abs=1e-4)


def test_learning_follows_the_noise_contrastive_gradient():
    rng = np.random.default_rng(0)
    model = m.LanguageModel.start([b"", b"a", b"b", b"c"], [5, 4, 3, 2], [0, 0, 0, 0], np.zeros((8, 2), np.int64), 4)
    units = rng.integers(0, 4, 50).astype(np.int32)
    units, before = model.history([units])
    noise = model.unigram()
    cut, offset = np.cumsum(noise), np.log(m.NOISE * noise)
    table = [model.context, model.mix, model.target, model.bias]

    def objective():
        drawn = np.minimum(np.searchsorted(cut, np.random.default_rng(1).random(m.NOISE)), model.units - 1)
        q_ = sum(table[0][before[:, k]] @ table[1][k] for k in range(m.ORDER))
        s = q_ @ table[2].T + table[3] - offset
        real, fake = s[np.arange(len(units)), units], s[:, drawn]
        return (-np.log1p(np.exp(-real)) - np.log1p(np.exp(fake)).sum(axis=1)).mean()

    grads = model._gradients(table, offset, units, before, cut, np.random.default_rng(1))
    for x, g in zip(table, grads, strict=True):
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in x.shape)
            old, eps = x[at], 1e-5
            x[at] = old + eps
            up = objective()
            x[at] = old - eps
            down = objective()
            x[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * eps), abs=1e-4)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(m, "SLICE", 64)  # long texts in many slices (driver only; tasks keep theirs)
    long_word = "x" * 5000
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "A b"), (None, "A b"), (4, "a B never"), (4, long_word + " b"), (5, "b " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS row", "'w' AS word", "3 AS score")
    training = F.coalesce(F.col("doc_id"), F.lit(0)) != 4
    got = m.score_documents(docs, training).collect()
    want = base_scores(rows, [i != 4 for i, _ in rows])
    have = sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got)
    assert have == sorted((repr(i), *w[:3], round(w[3], 3)) for (i, _), w in zip(rows, want, strict=True))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert [list(x) for x in m.word_slices(b"Ab cd  " * 40 + b"end")] != []
    assert sum((list(x) for x in m.word_slices(b"Ab cd  " * 40 + b"end")), []) == [b"ab", b"cd"] * 40 + [b"end"]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (got,) = m.score_documents(docs, F.lit(False)).collect()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.held_out, got.base_score) == (3, 0, 0, True, 0.0)
    assert m.score_documents(docs.limit(0)).count() == 0


def test_documents_share_contexts_when_scored(monkeypatch):
    """Contexts are multiplied once for all documents of a turn, which holds more tokens than one of learning."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    words = [b"", *(f"w{i}".encode() for i in range(60))]
    model = m.LanguageModel.start(words, [5] * 61, [m.shape(x) for x in words], np.zeros((8, 2), np.int64), 40)
    texts = [b" ".join(words[i] for i in rng.integers(1, 61, 10_000)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    turns, log_probs = [], m.LanguageModel.log_probs
    monkeypatch.setattr(m.LanguageModel, "log_probs", lambda self, u, b: turns.append(len(u)) or log_probs(self, u, b))

    class Shared:
        value = model

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(m, "TaskContext", Task)

    def scores():
        return np.concatenate([x["score"].to_numpy() for x in m._scored(Shared)(iter([batch]))])

    whole = scores()
    assert turns == [600_060]
    monkeypatch.setattr(m, "SCORED", 50_000)
    assert np.allclose(scores(), whole, rtol=1e-6) and len(turns) > 10


def test_words_are_looked_up_once_a_batch(monkeypatch):
    """Words are numbered before they are looked up, slice by slice; long texts and empty ones keep their words."""
    rng = np.random.default_rng(3)
    texts = [b"", b" \t ", b"A b  a\x0bB\n", "Ж Я".encode() * 3, b" ".join(rng.choice([b"a", b"bB", b"c\n"], 2_000)), b"z" * 300, b"x "]
    monkeypatch.setattr(m, "SLICE", 64)
    monkeypatch.setattr(m, "NUMBERED", 500)
    monkeypatch.setattr(m, "HELD_WORDS", 5)
    got, groups = [[]], list(m.numbered(texts))
    for some in groups:
        words = some.words.to_pylist()
        for i, last, start, end in some.slices:
            assert i == len(got) - 1
            got[-1].extend(words[k] for k in some.numbers[start:end])
            if last:
                got.append([])
    want = [x.translate(m._FOLD).split() for x in texts]
    assert got == [*want, []] and len(groups) > 3
    counts = Counter()
    for batch in m._counted(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])])):
        for row in batch.to_pylist():
            assert row["shape"] == m.shape(row["word"])
            counts[row["word"]] += row["n"]
    assert +counts == Counter(w for x in want for w in [*x, m.END])

    class Asked(m._Known):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(m, "_Known", Asked)
    monkeypatch.setattr(m, "NUMBERED", 1 << 20)
    asked: list[bytes] = []
    model = m.LanguageModel.start([m.END, b"a", b"bb"], [7, 3, 2], [0, 0, 0], np.zeros((8, 2), np.int64), 3)
    units = list(m._unit_stream(model, iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])])))
    assert [len(x) for some in units for x in some] == [len(x) + 1 for x in want]
    assert len(asked) == len(set(asked))
