"""The contract queries against plain-Python results computed here, on the whole sf0.001 tables."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from greenledger.llm import queries as q

SF = "/root/testdata/sf0.001"


def components(ids, linked):
    """Smallest id reachable, by repeated relabelling."""
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")


def test_simhash_matches_brute_force(spark, docs):
    def fingerprint(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for c in "\t\n\x0b\x0c\r":
            lower = lower.replace(c, " ")
        words = [w for w in lower.split(" ") if w]
        if not words:
            return 0
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        votes = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s.encode(), 42)
            for i in range(64):
                votes[i] += h >> i & 1
        return sum(1 << i for i in range(64) if 2 * votes[i] > len(shingles))

    fps = {i: fingerprint(t) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = components(fps, pairs)
    got = q.op2_simhash(spark, SF).toPandas()
    assert len(got) == len(docs)
    assert dict(zip(got.doc_id, got.fingerprint, strict=True)) == {i: f"{x:016x}" for i, x in fps.items()}
    assert dict(zip(got.doc_id, got.component_id, strict=True)) == want
    assert len(set(want.values())) < len(want)


def test_chat_digests(spark):
    conv = pd.read_parquet(f"{SF}/conversations.parquet")
    said = "</s>[INST] ok [/INST]"
    extra = pd.DataFrame({"conv_id": [-1, -1], "turn": [0, 1], "role": ["user", "assistant"], "text": [said, said]})
    conv = pd.concat([conv, extra]).sort_values(["conv_id", "turn"]).fillna({"text": ""})
    got = q.op3_chat_format(spark, SF).toPandas().set_index("conv_id")
    groups = list(conv.groupby("conv_id"))
    assert len(got) == len(groups)
    for conv_id, rows in groups:
        whole = "".join(f"{r}\n{t}\n" for r, t in zip(rows.role, rows.text, strict=True))
        loss = "".join(rows.text[rows.role == "assistant"])
        have = got.loc[conv_id]
        assert have.n_turns == len(rows)
        assert have.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (have.loss_chars, have.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert have.formatted_chars > len(rows.text.str.cat())


def test_token_files_match_plain_encoding(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(q.tokenizer_path("byte_bpe_50k.json"))
    got = q.op6_token_files(spark, SF).toPandas().sort_values("doc_id")
    assert got.doc_id.tolist() == sorted(docs.doc_id)
    start = 0
    for have, text in zip(got.itertuples(), docs.sort_values("doc_id").text, strict=True):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (have.start, have.n_tokens, have.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_warc(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet").fillna({"html": ""})
    first = pages.sort_values("page_id").groupby("html").page_id.first()
    got = q.op7_warc(spark, SF).toPandas().set_index("page_id")
    assert len(got) == len(pages)
    for page_id, html in zip(pages.page_id, pages.html, strict=True):
        have, answer = got.loc[page_id], first[html]
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert (have.payload_bytes, have.payload_digest) == (len(html.encode()), digest)
        assert have.record_type == ("response" if answer == page_id else "revisit")
        assert pd.isna(have.refers_to) if answer == page_id else have.refers_to == answer


def test_sharding_laws(spark, docs):
    got = q.op8_sharding(spark, SF).toPandas().merge(docs, on="doc_id")
    assert len(got) == len(docs) and set(got.shard) <= set(range(16))
    assert (got["size"] == got.text.map(lambda x: len(x.encode()) + 1)).all()
    assert (got.text_crc32 == got.text.map(lambda x: zlib.crc32(x.encode()))).all()
    assert (got.groupby("text").shard.nunique() == 1).all()
    for _, shard in got.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    load = got.groupby("shard")["size"].sum()
    assert load.max() - load.min() <= got.groupby("text")["size"].sum().max()


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(q.tokenizer_path("word_bpe_49k.json"))
    got = q.op9_packing(spark, SF).toPandas()
    have = {(r.doc_id, r.piece): r for r in got.itertuples()}
    total = n = 0
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part, row = ids[start : start + 2048], have[doc_id, piece]
            assert (row.start, row.length, row.ids_crc32) == (start, len(part), zlib.crc32(part.tobytes()))
            n += 1
    assert n == len(got)
    bins = defaultdict(list)
    for r in got.itertuples():
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-total // 2048) + 1
