"""Cross-tokenizer alignment against a plain reading of the two tokenizers, whole texts at a time."""

import hashlib
import random
from collections import Counter

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from greenledger.llm import queries as q
from greenledger.llm import token_alignment as t

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ZERO = (0, 0, 0, 0, 0, 0, "")


def spelled():
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    letters = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)

    def a(text):
        e = tok.encode(" " + text, add_special_tokens=False)
        return [(i, bytes(letters[c] for c in x)) for i, x in zip(e.ids, e.tokens, strict=True)]

    def b(text):
        out = []
        for i in sp.encode(text):
            x = sp.id_to_piece(i)
            out.append((i, bytes([int(x[3:5], 16)]) if x.startswith("<0x") and len(x) == 6 else x.replace("▁", " ").encode()))
        return out

    return a, b


def ranges(tokens):
    at, out = 0, []
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(texts):
    a, b = spelled()
    pairs, docs = Counter(), []
    for text in texts:
        ta, tb = (a(text), b(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in ta) != whole or b"".join(x for _, x in tb) != whole:
            docs.append(None)
            continue
        ra, rb = ranges(ta), ranges(tb)
        links = [(i, j) for i, s, e in ra for j, u, v in rb if s < v and u < e]
        ends = sorted({e for _, _, e in ra} & {e for _, _, e in rb})
        groups, low = [], 0
        for end in ends:
            ids = [",".join(str(i) for i, s, e in r if low <= s < end) for r in (ra, rb)]
            groups.append("|".join(ids))
            low = end
        pairs.update(links)
        docs.append((len(ra), len(rb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, j), n in pairs.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for d in docs:
        if d is None:
            out.append(ZERO)
        else:
            links = d[3]
            n_best = sum(pairs[x] == best[x[1]] for x in links)
            out.append((d[0], d[1], d[2], len(links), n_best, sum(pairs[x] for x in links), d[4]))
    return out, pairs, best


def result(docs):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return {r.doc_id: tuple(r[c] for c in columns) for r in docs.collect()}


def test_whole_table(spark):
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs[docs.text.str.len() < 2500]  # the brute force is quadratic in a text
    frame = spark.createDataFrame(docs[["doc_id", "text"]])
    got, pairs = t.align_tokenizers(frame, A, B)
    want, counts, best = brute(docs.text)
    assert result(got) == dict(zip(docs.doc_id, want, strict=True))
    assert {(r.a, r.b): (r["count"], r.best) for r in pairs.collect()} == {k: (n, n == best[k[1]]) for k, n in counts.items()}


ODD = [
    None, "", " ", "  ", "   x", "x ", "x  ", "a  b\n", "\n", " \n x", "a\n\n b", "a \n b\t c", "▁", "a ▁ b", "a▁b c",
    "<|endoftext|> x", "</s> [INST] <unk> <0x0A>", "a\0b c", "ﬁn ①", "é é İ", "日本語 テキスト", "🙂 👍🏽x",
    "don't  we'll 'S", "x" * 300, "1234567 890,12", "a b  c", "\x1c x\x1d y", "﻿ x", "<s>", "▁▁ x",
]


def test_odd_texts(spark):
    rows = [(i, x) for i, x in enumerate(ODD)] + [(None, "a b"), (None, "a b"), (3, "twice")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({"text": "body"})
    frame = frame.selectExpr("doc_id", "body", "1 AS batch", "2 AS codes", "'x' AS pairs")
    got, _ = t.align_tokenizers(frame, A, B, text_col="body")
    want, _, _ = brute([x for _, x in rows])
    have = sorted((repr(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect())
    assert have == sorted((repr(i), *w) for (i, _), w in zip(rows, want, strict=True))


def test_units_are_whole_texts():
    aligner = t.Aligner(A, B)
    assert aligner.cuts
    rng = random.Random(5)
    bits = ["a", "the", "é", "\n", "\t", " ", "  ", "'s", "12", ".", "▁", " ", "wörd", "\r\n", "</s>", "日"]
    a, b = spelled()
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        units = [u for part in aligner.units(text) for u in part]
        assert " ".join(units) == text
        (ids_a, _), (ids_b, _) = aligner.tokens(units)
        assert ids_a.tolist() == [i for i, _ in a(text)], repr(text)
        if "▁" not in text:
            assert ids_b.tolist() == [i for i, _ in b(text)], repr(text)


def test_slices_and_batches(spark, monkeypatch):
    words = [w for x in pd.read_parquet("/root/testdata/sf0.001/documents.parquet").text[:20] for w in x.split(" ")][:1500]
    aligner = t.Aligner(A, B)
    monkeypatch.setattr(t, "SLICE", 50)
    text = " ".join(words) + "  end"
    units = [u for part in aligner.units(text) for u in part]
    assert " ".join(units) == text
    assert len(list(aligner.units(text))) > 20
    monkeypatch.undo()
    # a table of one batch and of many
    frame = spark.createDataFrame([(i, " ".join(words[i : i + 40])) for i in range(0, 1400, 10)], "doc_id long, text string")
    one = result(t.align_tokenizers(frame.coalesce(1), A, B)[0])
    many = result(t.align_tokenizers(frame.repartition(40), A, B)[0])
    assert one == many and len(one) == 140


def test_long_text_and_empty_table(spark):
    word = "lorem ipsum dolor "
    text = word * 90_000  # 1.6 MB, over one slice
    docs = spark.createDataFrame([(1, text), (2, word.strip())], "doc_id long, text string")
    got = result(t.align_tokenizers(docs, A, B)[0])
    a, b = spelled()
    assert got[1][0] == len(a(text)) and got[1][1] == len(b(text))
    assert got[2][2] > 0
    empty, pairs = t.align_tokenizers(docs.limit(0), A, B)
    assert empty.count() == 0 and pairs.count() == 0


def test_query_returns_the_contract(spark):
    got = q.op13_token_alignment(spark, "/root/testdata/sf0.001")
    want = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == want.replace("long", "bigint").split(", ")


@pytest.mark.parametrize("start,end,groups", [(([0, 3], [0, 2]), ([3, 5], [2, 5]), ([0, 0], [0, 0]))])
def test_coalescing(start, end, groups):
    import numpy as np

    got = t._coalesced([np.array(x) for x in start], [np.array(x) for x in end])
    assert [x.tolist() for x in got] == [list(x) for x in groups]
