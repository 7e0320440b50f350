"""Ids are kept beside the places, without going through the workers that make these."""

import numpy as np
import pytest

pytest.importorskip("tokenizers")

from greenledger.llm import packing  # noqa: E402
from greenledger.llm.queries import tokenizer_path  # noqa: E402


def test_ids_meet_the_places_in_the_end(spark):
    texts = ["a few words", None, "", "more words than one piece holds " * 9, "a few words", "twice the same row"]
    rows = [(i, x) for i, x in enumerate(texts)] + [(5, texts[5]), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = tokenizer_path("word_bpe_49k.json")
    packed = packing.pack_documents(docs, path, end_id=0, capacity=16, keep_ids=True)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    workers = [x for x in plan.splitlines() if "MapInArrow" in x]
    assert workers and not any("ids#" in x for x in workers)
    plain = packing.pack_documents(docs, path, end_id=0, capacity=16)
    assert packed.columns == [*plain.columns, "ids"][:5] + ["ids", "sequence_id", "offset"]
    found = packed.collect()
    numbers = lambda df: sorted(df.drop("ids").collect(), key=str)
    assert len(found) == plain.count() and [r[:5] for r in numbers(packed)] == [r[:5] for r in numbers(plain)]
    encode = packing.encoder(path).encode
    for r in found:
        assert len(r.ids) == 4 * r.length
        if r.doc_id is not None:
            ids = encode([texts[r.doc_id] or ""])[0] + np.array([0], "<u4").tobytes()
            assert ids[4 * r.start : 4 * (r.start + r.length)] == bytes(r.ids)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert [x for x, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 16
