"""The field is fitted in little memory, and to the same weights however the sample is cut into blocks."""

import tracemalloc

import numpy as np

from greenledger.llm import toxicity as t


def sample(docs=400, length=600, words=60_000):
    rng = np.random.default_rng(5)
    for i in range(docs):
        found = [f"word{x}" for x in rng.integers(0, words, length)]
        if i % 3 == 0:
            for at in rng.integers(0, length, 4):
                found[at] = ("Blargh", "blarghing", "vexatious")[at % 3]
        yield " ".join(found)


def marks(docs=400):
    return [int(i % 3 == 0) for i in range(docs)]


def test_the_driver_fits_in_little_memory():
    tracemalloc.start()
    try:
        model = t.fit(sample(), marks())
        top = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert top < 34  # 44 with Python objects for features and stems; 27 now
    assert model.token_score("blarghs") > 1 > 0 > model.token_score("word17")


def test_blocks_change_nothing(monkeypatch):
    texts = [*sample(60, 80, 300), "", "Blargh", "word1 word2"]
    texts += texts[:5]  # equal texts count once, with their last label
    toxic = [*marks(60), 0, 1, 0, 1, 1, 1, 0, 0]
    model = t.fit(texts, toxic)
    monkeypatch.setattr(t, "BLOCK", 64)
    again = t.fit(iter(texts), iter(toxic))
    assert np.array_equal(model.weights, again.weights) and (model.moves, model.final) == (again.moves, again.final)


def test_labels_follow_the_rule():
    texts, toxic = [*sample(90, 40, 50), "tiny text", "blarghing alone"], [*marks(90), 0, 1]
    c, rows = t._Corpus(texts, toxic), np.arange(92)
    words = list(dict.fromkeys(w for x in texts for w in t._WORD.findall(x.lower())))
    stems = lambda w: [f" {w}", *(w[:n] for n in range(4, 8) if len(w) > n)]
    counts = [{}, {}]
    for kind in (0, 1):
        seen = set()
        for x, y in zip(texts, toxic, strict=True):
            d = ["", *t._WORD.findall(x.lower()), ""]
            seen |= {tuple(d[i - 1 : i + 2]) for i in range(1, len(d) - 1) if y == kind}
        for _, w, _ in seen:
            for s in stems(w):
                counts[kind][s] = counts[kind].get(s, 0) + 1
        counts[kind]["all"] = len(seen)
    rate = (counts[1]["all"] + 1) / (counts[0]["all"] + 1)
    least = max(4, 0.01 * sum(toxic))
    marked = {s for s, n in counts[1].items() if n >= least and n > 10 * rate * (counts[0].get(s, 0) + 0.5)}
    want = [any(s in marked for s in stems(w)) for w in words]
    assert t.derive_labels(c, rows).tolist() == want and any(want) and not all(want)
    assert c.number.tolist() == [f for w in words for f in (0, *t.features(w))]
