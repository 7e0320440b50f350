"""Cases in which an operator once did less than its whole job, one or two for each."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from greenledger.llm import chat_format as chat
from greenledger.llm import embedding_dedup as emb
from greenledger.llm import toxicity
from greenledger.llm.decontaminate import contaminated
from greenledger.llm.suffix_dedup import remove_passages, repeated_passages
from greenledger.llm.token_files import TokenFile, _Writer

from .test_passages import brute_leaks


def test_links_whose_differing_coordinates_lie_on_both_sides(spark, monkeypatch):
    rng = np.random.default_rng(3)
    s = np.sqrt(1 - 0.13**2 - 0.001**2)
    planted = np.zeros((2, 64))
    planted[0, :3], planted[1, :3] = (0.13, 0.001, s), (-0.001, -0.13, s)
    assert planted[0] @ planted[1] > 0.98
    wide = np.concatenate([planted @ emb.rotation(64).T, rng.standard_normal((1022, 64))])  # 2 key bits
    low = rng.standard_normal((3000, 4))  # thousands of links, many near the threshold
    monkeypatch.setattr(emb, "CELL", 200)  # 4 key bits for 3000 vectors
    rows = [*((i, v.tolist(), 1) for i, v in enumerate(wide)), *((10_000 + i, v.tolist(), 2) for i, v in enumerate(low))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in emb.embedding_near_dedup(df, 0.98).collect()}
    want = {}
    for base, part in ((0, wide), (10_000, low)):
        unit = part / np.linalg.norm(part, axis=1, keepdims=True)
        want |= {base + i: int(n) - 1 for i, n in enumerate((unit @ unit.T >= 0.98).sum(axis=1))}
    assert want[0] == want[1] == 1
    assert got == want


def plain_windows(turns, budget, history):
    """[(context, targets)] of one conversation of (role, tokens) turns, decided turn by turn."""
    system = turns[0][1] if turns[0][0] == "system" else 0
    left, at = budget - system, int(system > 0)
    if sum(n for _, n in turns) <= budget:
        return [([], list(range(len(turns))))]
    longs = {i for i, (_, n) in enumerate(turns) if i >= at and 2 * n > left}
    room = left - max((n for i, (_, n) in enumerate(turns) if i >= at and i not in longs), default=0)
    repeat = max(0, min(history, room // 2))
    groups, start = [], 0
    for i in range(at, len(turns)):
        if i in longs:
            groups.append(("long", [i]))
            start = 0
            continue
        key = start // max(1, room - repeat)
        start += turns[i][1]
        if not groups or groups[-1][0] != key:
            groups.append((key, []))
        groups[-1][1].append(i)
    out = []
    for key, targets in groups:
        allowed = max(0, min(history, left - turns[targets[0]][1])) if key == "long" else repeat
        k = targets[0]
        while k > at and sum(n for _, n in turns[k - 1 : targets[0]]) <= allowed:
            k -= 1
        out.append((list(range(at)) * bool(out) + list(range(k, targets[0])), list(range(at)) * (not out) + targets))
    return out


def test_long_turns_leave_the_other_windows_their_context(spark):
    rng = np.random.default_rng(4)
    sizes = {c: rng.integers(1, 20, 700) for c in range(8)}
    sizes[1][300] = 2000  # beyond the budget
    sizes[2][300] = 190  # fits, and would leave next to nothing
    sizes[3][0] = sizes[4][1] = 2000  # at the start, without and with a system turn
    sizes[5][[99, 100, 255, 256, 257, 699]] = 2000, 150, 120, 2000, 101, 500
    sizes[6][rng.choice(700, 60, replace=False)] = 150
    sizes[7][0] = 120  # a large system turn
    roles = lambda c, i: "system" if i == 0 and c in (2, 4, 7) else ["user", "assistant"][i % 2]
    rows = [(c, i, roles(c, i), f"{i:<{4 * n}}"[: 4 * n]) for c, x in sizes.items() for i, n in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.chat_windows(df, budget=200, history=40).select("*", chat.read_turns(F.col("formatted")).alias("turns"))
    got = {c: [] for c in sizes}
    for r in out.orderBy("conv_id", "window").collect():
        texts = [t["text"] for t in r.turns]
        got[r.conv_id].append((texts[: r.context_turns], texts[r.context_turns :]))
        assert r.over_budget == (r.n_tokens > 200)
        assert not r.over_budget or max(len(x) for x in texts) > 4 * (200 - 124 - 4)
    for c in sizes:
        mine = [x for x in rows if x[0] == c]
        want = plain_windows([(x[2], -(-len(x[3]) // 4) + 4) for x in mine], 200, 40)
        assert got[c] == [([mine[i][3] for i in a], [mine[i][3] for i in b]) for a, b in want], c
    assert sum(not a for a, _ in got[1]) == 3  # the first, the long turn, the one after it


@pytest.mark.parametrize("ids", [(None, None, 7), (3, 3, 7), (None, None, None)])
def test_a_passage_stays_in_one_of_the_texts_that_share_the_smallest_id(spark, ids):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(d, f"own{i} text{i} {passage} end{i}") for i, d in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = repeated_passages(df, 12, 4)
    assert sorted((r.duplicate, r.start_word, r.n_words) for r in spans.collect()) == [(False, 2, 12), (True, 2, 12), (True, 2, 12)]
    assert {r.doc_id for r in spans.collect() if not r.duplicate} == {ids[0]}
    left = sorted(r.text for r in remove_passages(df, spans).collect())
    assert sum(passage in t for t in left) == 1 and len(left) == 3
    assert all(t in (rows[i][1], f"own{i} text{i} end{i}") for i, t in enumerate(left))


def test_leaks_of_items_that_repeat_themselves_or_are_turned_round(spark):
    item, fill = [f"w{i}" for i in range(46)], [f"f{i}" for i in range(30)]
    twice = [f"t{i}" for i in range(20)] * 2
    texts = [
        "x no no no no no no no y",
        " ".join(fill + item[23:] + item[:23] + fill),
        " ".join(fill + twice[10:] + twice[:10] + fill),
        " ".join(fill + ["ha", "ho"] * 9 + fill[:3]),
        " ".join(fill + item[23:] + fill + item[:23]),  # halves far apart: no window holds them
    ]
    docs = [*enumerate(texts), *((10 + i, " ".join(fill[:i] + t.split()[1:-1] + fill)) for i, t in enumerate(texts))]
    items = [(1, "no " * 7), (2, " ".join(item)), (3, " ".join(twice)), (4, "ha ho " * 6), (5, "one two three four five six")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in contaminated(df, bench).collect()}
    assert got == brute_leaks(docs, items)
    assert {(0, 1), (1, 2), (2, 3), (3, 4), (10, 1)} <= set(got) and (4, 2) not in got


def test_the_fitting_sample_is_bounded_in_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 5)
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 8)
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, marks: taken.append(list(zip(texts, marks, strict=True))))
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:6]
    docs = [(i, f"text {i} {j % 40}") for i in ids for j in range(120)]  # each text three times
    labels = spark.createDataFrame([(i, int(k < 3)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    for order in (docs, docs[::-1]):
        toxicity.fit_from(spark.createDataFrame(order, "doc_id long, text string"), labels)
    assert [sum(y == k for _, y in taken[0]) for k in (1, 0)] == [5, 8]
    assert len(set(taken[0])) == 13 and taken[0] == taken[1]


def test_ids_that_do_not_fit_are_an_error(tmp_path):
    writer = _Writer(tmp_path.as_uri(), 2)
    writer.add(1, np.array([0, 65_535], "<u4"))
    with pytest.raises(ValueError, match="65536"):
        writer.add(2, np.array([1, 65_536], "<u4"))
    wide = _Writer(tmp_path.as_uri(), 4)
    wide.add(1, np.array([1, 65_536], "<u4"))
    assert TokenFile(wide.close()["file"]).ids(0).tolist() == [1, 65_536]
