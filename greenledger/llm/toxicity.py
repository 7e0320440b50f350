"""Toxic spans by a linear-chain conditional random field.

Two tags, clean and toxic. A token's features are its lower-cased form, its first and last letters;
tags of neighbouring tokens are tied by transition weights. Labels mark documents, so the tokens'
labels are derived first: in a toxic document those tokens are toxic whose form or first letters are
far more frequent among toxic documents than among clean ones; in a clean document none is.

With two tags the forward and backward recursions need only the odds of the tags, so a batch of
documents takes one vector operation per position. The marginals give the offending tokens, and the
probability that a document holds any, calibrated on the labelled documents, is its score.

The model is fitted on a bounded sample of labelled rows (``MAX_TOXIC``, ``MAX_CLEAN``) and has a
fixed number of weights; scoring reads every whole text. The driver, which fits, keeps the sample as
flat arrays of 4 bytes a number and goes through them a block at a time.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import give_back, giving_back, stored

#: Labelled rows that a model is fitted on at most, the lowest by a hash of their id.
MAX_TOXIC, MAX_CLEAN = 2000, 4000
WEIGHTS = 1 << 18
#: Tokens on either side of a labelled token that training sees, and windows per clean document.
AROUND, CLEAN_WINDOWS = 8, 2
ROUNDS = 50
#: Tokens that fitting looks at together, about.
BLOCK = 1 << 18
#: Tokens whose scores a worker remembers.
REMEMBERED = 300_000
#: Characters of text that are scored at a time, about.
BATCH_CHARS = 3_000_000
_WORD = re.compile(r"\w+")


def features(token: str) -> list[int]:
    """Weight numbers of a token."""
    w = token.lower()
    names = [f"w {w}", *(f"{n} {w[:n]}" for n in range(3, 8) if len(w) >= n), f"e {w[-3:]}"]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % (WEIGHTS - 1) + 1 for x in names]


@dataclass
class Model:
    """``weights``: toxic against clean, number 0 for every token. ``moves``: odds factors of tag pairs."""

    weights: np.ndarray
    moves: tuple[float, float, float, float]  # toxic-toxic, clean-toxic, toxic-clean, clean-clean
    final: tuple[float, float, float]  # of a document's evidence, and a constant

    def token_score(self, token: str) -> float:
        return float(self.weights[0] + self.weights[features(token)].sum())


def marginals(scores: list[np.ndarray], moves: tuple[float, float, float, float]) -> list[np.ndarray]:
    """Toxic probability of each token of each document, by forward and backward odds."""
    tt, ct, tc, cc = moves
    sizes = np.array([len(s) for s in scores])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    start = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.exp(np.clip(np.concatenate([scores[i] for i in order]) if len(scores) else np.empty(0), -30, 30))
    forward, backward = np.empty(len(flat)), np.empty(len(flat))
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")  # documents with that many tokens
    odds = np.empty(0)
    for t in range(longest):
        at = start[: alive[t]] + t
        odds = flat[at] * ((odds[: alive[t]] * tt + ct) / (odds[: alive[t]] * tc + cc) if t else 1.0)
        np.clip(odds, 1e-100, 1e100, out=odds)
        forward[at] = odds
    odds = np.empty(0)
    for t in range(longest - 1, -1, -1):
        at, held = start[: alive[t]] + t, len(odds)
        new = np.ones(alive[t])
        if held:
            x = flat[at[:held] + 1] * odds
            new[:held] = (tt * x + tc) / (ct * x + cc)
        odds = np.clip(new, 1e-100, 1e100)
        backward[at] = odds
    total = forward * backward
    prob = total / (1 + total)
    out: list[np.ndarray] = [np.empty(0)] * len(scores)
    for k, i in enumerate(order):
        out[i] = prob[start[k] : start[k + 1]]
    return out


def _evidence(prob: np.ndarray) -> np.ndarray:
    """What a document's marginals say: log-odds of the likeliest token and of any token."""
    if not len(prob):
        return np.array([-15.0, -15.0])
    none = min(float(np.log1p(-np.minimum(prob, 1 - 1e-9)).sum()), -1e-9)
    top = min(max(float(prob.max()), 1e-9), 1 - 1e-9)
    some = math.log(-math.expm1(none)) - none
    return np.array([max(-15.0, math.log(top / (1 - top))), min(15.0, max(-15.0, some))])


#: Lengths of the first letters that a derived label may rest on, beside the whole form.
STEMS = range(4, 8)


class _Corpus:
    """The fitting sample as numbers: distinct lower-cased tokens, their features, documents of token numbers.

    Texts are read one by one and not kept; of the tokens, only what is looked up later stays.
    """

    def __init__(self, texts: Iterable[str], toxic: Iterable[int]):
        seen: dict[bytes, int] = {}  # equal texts count once
        y, ids, flat, sizes = [], {}, array("i"), []
        for text, mark in zip(texts, toxic, strict=True):
            key = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
            if key in seen:
                y[seen[key]] = mark
                continue
            seen[key] = len(y)
            y.append(mark)
            before = len(flat)
            flat.extend(ids.setdefault(m.group(), len(ids)) for m in _WORD.finditer(text.lower()))
            sizes.append(len(flat) - before)
        self.y = np.array(y, dtype=bool)
        self.words = len(ids)
        ends = np.cumsum(sizes, dtype=np.int64)
        flat = np.frombuffer(flat, np.int32)
        self.docs = [flat[e - n : e] for e, n in zip(ends, sizes, strict=True)]
        number, sizes = array("i"), array("b")
        for w in ids:
            found = features(w)
            number.append(0)
            number.extend(found)
            sizes.append(1 + len(found))
        self.sizes = np.frombuffer(sizes, np.int8)
        self.number = np.frombuffer(number, np.int32)
        self.stems = [self._stems(ids, n) for n in STEMS]

    @staticmethod
    def _stems(words: Iterable[str], n: int) -> np.ndarray:
        """Per word a number of its ``n`` first letters, -1 where it has no more than those."""
        seen: dict[str, int] = {}
        found = (seen.setdefault(w[:n], len(seen)) if len(w) > n else -1 for w in map(str.lower, words))
        return np.fromiter(found, np.int32)

    def _blocks(self) -> Iterator[tuple[int, int, int, int]]:
        """Words in blocks, and where their features stand: ``(from, to, from, to)``."""
        at = 0
        for low in range(0, self.words, BLOCK // 8):
            high = min(self.words, low + BLOCK // 8)
            end = at + int(self.sizes[low:high].sum(dtype=np.int64))
            yield low, high, at, end
            at = end

    def owners(self, low: int, high: int) -> np.ndarray:
        return np.repeat(np.arange(high - low), self.sizes[low:high])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = np.empty(self.words)
        for low, high, at, end in self._blocks():
            out[low:high] = np.bincount(self.owners(low, high), weights[self.number[at:end]], high - low)
        return out

    def features_of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of the ``wanted`` words, ascending: which of these has them, and their numbers."""
        owner, number = [], []
        for low, high, at, end in self._blocks():
            first, last = np.searchsorted(wanted, [low, high])
            place = np.full(high - low, -1, np.int32)
            place[wanted[first:last] - low] = np.arange(first, last)
            of = place[self.owners(low, high)]
            owner.append(of[of >= 0])
            number.append(self.number[at:end][of >= 0])
        return np.concatenate(owner), np.concatenate(number)

    def contexts(self, docs: list[np.ndarray]) -> np.ndarray:
        """Per token, in how many different pairs of neighbours it stands; copies of a passage count once."""
        total, at = sum(map(len, docs)), 0
        keys, words = np.empty(total, np.uint64), np.empty(total, np.int32)
        for d in docs:
            wide = np.concatenate([[-1], d, [-1]]).astype(np.uint64)
            mixed = (wide[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (wide[2:] * np.uint64(0xC2B2AE3D27D4EB4F))
            keys[at : at + len(d)] = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD) + wide[1:-1]
            words[at : at + len(d)] = d
            at += len(d)
        out = np.zeros(self.words, np.int64)
        parts = np.uint64(total // BLOCK + 1)  # equal keys are in one part
        for part in range(int(parts)):
            here = np.concatenate(
                [np.flatnonzero(keys[i : i + BLOCK] % parts == part) + i for i in range(0, total, BLOCK)] or [[]]
            ).astype(np.int64)
            _, first = np.unique(keys[here], return_index=True)
            out += np.bincount(words[here[first]], minlength=self.words)
        return out


def derive_labels(corpus: _Corpus, rows: np.ndarray) -> np.ndarray:
    """Which tokens are labelled toxic inside toxic documents.

    A stem (a form, or 4 to 7 first letters) marks them if it stands in at least as many different
    contexts as 1 % of the toxic texts (4 at least), and 10 times as often as among clean texts.
    """
    yes = corpus.contexts([corpus.docs[i] for i in rows if corpus.y[i]])
    no = corpus.contexts([corpus.docs[i] for i in rows if not corpus.y[i]])
    least = max(4, 0.01 * corpus.y[rows].sum())
    rate = (yes.sum() + 1) / (no.sum() + 1)
    marks = lambda n, m: (n >= least) & (n > 10 * rate * (m + 0.5))
    out = marks(yes, no)
    for stem in corpus.stems:
        of = np.flatnonzero(stem >= 0)
        sums = [np.bincount(stem[of], x[of]).astype(np.int64) for x in (yes, no)]
        out[of] |= marks(*sums)[stem[of]]
    return out


def fit(texts: Iterable[str], toxic: Iterable[int]) -> Model:
    """Fit the field and the calibration; deterministic. Without both kinds of labels scores are constant.

    The calibration uses documents that the field was not fitted on: two fields on alternate halves
    judge each other's documents, and the field that is kept is fitted on all.
    """
    c = _Corpus(texts, toxic)
    if not c.y.any() or c.y.all():
        base = 3.0 if len(c.y) and c.y.all() else -3.0
        return Model(np.zeros(WEIGHTS, np.float32), (1.0, 1.0, 1.0, 1.0), (0.0, 0.0, base))
    every = np.arange(len(c.y))
    half = np.zeros(len(c.y), dtype=bool)
    for kind in (c.y, ~c.y):
        half[np.flatnonzero(kind)[::2]] = True
    seen = np.zeros((len(c.y), 2))
    for side in (half, ~half):
        weights, moves = _train(c, every[~side])
        score = c.scores(weights)
        for some in _alike(c, every[side]):
            found = marginals([score[c.docs[i]] for i in some], moves)
            seen[some] = [_evidence(p) for p in found]
    weights, moves = _train(c, every)
    return Model(weights.astype(np.float32), moves, _calibrate(seen, c.y))


def _alike(c: _Corpus, rows: np.ndarray) -> Iterator[np.ndarray]:
    """``rows`` in blocks of about BLOCK tokens, documents of like length together."""
    sizes = np.array([len(c.docs[i]) for i in rows], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    block = np.cumsum(sizes[order]) // BLOCK
    yield from np.split(rows[order], np.flatnonzero(np.diff(block)) + 1)


def _windows(c: _Corpus, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tokens and tags around each labelled token, and of fixed pseudo-random places of clean documents."""
    marked, out = derive_labels(c, rows), []
    for i in rows:
        d = c.docs[i]
        if c.y[i]:
            tags, end = marked[d], -1
            for h in np.flatnonzero(tags):
                if h >= end:
                    start, end = max(0, h - AROUND), h + AROUND + 1
                    out.append((d[start:end], tags[start:end]))
        elif len(d):
            for j in range(CLEAN_WINDOWS):
                start = zlib.crc32(f"{i} {j}".encode()) % len(d)
                part = d[start : start + 2 * AROUND + 1]
                out.append((part, np.zeros(len(part), dtype=bool)))
    return out


def _train(c: _Corpus, rows: np.ndarray) -> tuple[np.ndarray, tuple[float, float, float, float]]:
    """Maximum conditional likelihood by AdaGrad over all windows, weights shrunk towards 0."""
    windows = _windows(c, rows)
    length, n = max((len(w) for w, _ in windows), default=0), len(windows)
    if not length:
        return np.zeros(WEIGHTS), (1.0, 1.0, 1.0, 1.0)
    token = np.zeros((length, n), np.int64)
    gold, mask = np.zeros((length, n), bool), np.zeros((length, n), bool)
    for i, (words, tags) in enumerate(windows):
        token[: len(words), i], gold[: len(words), i], mask[: len(words), i] = words, tags, True
    used, flat = np.unique(token, return_inverse=True)
    token = flat.reshape(length, n)
    owner, number = c.features_of(used)
    weights, moves = np.zeros(WEIGHTS), np.zeros((2, 2))  # moves[from, to], 1 is toxic
    squares, move_squares = np.full(WEIGHTS, 1e-6), np.full((2, 2), 1e-6)
    pair = mask[1:]
    want = np.zeros((2, 2))
    np.add.at(want, (gold[:-1][pair].astype(int), gold[1:][pair].astype(int)), 1)
    for _ in range(ROUNDS):
        up = np.exp(np.clip(np.bincount(owner, weights[number], len(used))[token], -30, 30))
        e = np.exp(moves)
        f, b = np.ones((length, n)), np.ones((length, n))
        f[0] = up[0]
        for t in range(1, length):
            f[t] = np.clip(up[t] * (f[t - 1] * e[1, 1] + e[0, 1]) / (f[t - 1] * e[1, 0] + e[0, 0]), 1e-100, 1e100)
        for t in range(length - 2, -1, -1):
            x = up[t + 1] * b[t + 1]
            b[t] = np.where(mask[t + 1], (e[1, 1] * x + e[1, 0]) / (e[0, 1] * x + e[0, 0]), 1.0)
        odds = f * b
        miss = (gold - odds / (1 + odds)) * mask
        grad = np.bincount(number, np.bincount(token.ravel(), miss.ravel(), len(used))[owner], WEIGHTS) / n
        grad -= 1e-4 * weights
        # expected pairs of tags: forward odds before, backward odds after
        left, right = np.clip(f[:-1][pair], 1e-30, 1e30), np.clip((up * b)[1:][pair], 1e-30, 1e30)
        joint = np.empty((2, 2, len(left)))
        joint[0, 0], joint[0, 1], joint[1, 0], joint[1, 1] = e[0, 0], e[0, 1] * right, e[1, 0] * left, e[1, 1] * left * right
        joint /= joint.sum(axis=(0, 1))
        move_grad = (want - joint.sum(axis=2)) / n - 1e-3 * moves
        squares += grad**2
        move_squares += move_grad**2
        weights += grad / np.sqrt(squares)
        moves += 0.3 * move_grad / np.sqrt(move_squares)
    e = np.exp(moves)
    return weights, (float(e[1, 1]), float(e[0, 1]), float(e[1, 0]), float(e[0, 0]))


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of y on the evidence by Newton's method, slightly shrunk."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - 0.1 * w
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, g), -1, 1)
    return tuple(w.tolist())


class _Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def score(self, texts: list[str]) -> list[tuple[float, list[dict]]]:
        words = [_WORD.findall(t) for t in texts]
        missing = set().union(*words).difference(self.known)
        if len(self.known) + len(missing) > REMEMBERED:
            self.known = {}
            missing = set().union(*words)
        self.known.update((x, self.model.token_score(x)) for x in missing)
        get = self.known.__getitem__
        scores = [np.fromiter(map(get, w), np.float64, len(w)) for w in words]
        out = []
        for text, prob in zip(texts, marginals(scores, self.model.moves), strict=True):
            x = float(np.dot(self.model.final[:2], _evidence(prob)) + self.model.final[2])
            bad = np.flatnonzero(prob >= 0.5)
            spans = _spans(text, bad) if len(bad) else []
            out.append((1 / (1 + math.exp(-min(30.0, max(-30.0, x)))), spans))
        return out


def _spans(text: str, bad: np.ndarray) -> list[dict]:
    """Character offsets of the offending tokens, neighbours joined."""
    wanted, out, last = set(bad.tolist()), [], -2
    for i, m in enumerate(_WORD.finditer(text)):
        if i in wanted:
            if last == i - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = i
    return out


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5


def fit_from(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """A model from at most MAX_TOXIC and MAX_CLEAN labelled rows that are not held out.

    Rows without a label, id or text are left out, and rows of one id, text and label count once. The
    sample is the lowest by a hash of the id, and of its rows the lowest by a hash of id and text.
    """
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    marked = marked.where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & (fold(F.col("_id")) != 0)).distinct()
    low = lambda y, n: marked.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    sample = low(1, MAX_TOXIC).unionByName(low(0, MAX_CLEAN))
    texts = docs.select(F.col(id_col).alias("_d"), F.col(text_col).cast("string").alias("_text"))
    rows = texts.join(F.broadcast(sample), F.col("_d") == F.col("_id")).where(F.col("_text").isNotNull())
    rows = stored(rows.select("_id", "_text", "_y").distinct(), "toxicity-sample")
    least = lambda y, n: rows.where(F.col("_y") == y).orderBy(F.xxhash64("_id", "_text"), "_id", "_text").limit(n)
    rows = least(1, MAX_TOXIC).unionByName(least(0, MAX_CLEAN))
    rows = rows.toArrow()
    order = pc.sort_indices(rows, [("_id", "ascending"), ("_text", "ascending"), ("_y", "ascending")])
    texts, marks = _taken(rows["_text"], order), rows["_y"].take(order).to_pylist()
    del rows  # the texts go when the last has been read
    model = fit(texts, marks)
    give_back()
    return model


def _taken(column: pa.ChunkedArray, order: pa.Array) -> Iterator[str]:
    for i in order:
        yield column[i.as_py()].as_py()


def _chunks(every: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts in turns of about BATCH_CHARS characters, null as empty: ``(from, texts)``."""
    texts, at, size = [], 0, 0
    for i, t in enumerate(every):
        texts.append(t or "")
        size += len(texts[-1])
        if size >= BATCH_CHARS or i == len(every) - 1:
            yield at, texts
            texts, at, size = [], i + 1, 0


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, unchanged."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            for at, texts in _chunks(batch.column(place).to_pylist()):
                clean = [x < 0.5 for x, _ in scorer.score(texts)]
                yield batch.slice(at, len(texts)).filter(pa.array(clean))

    return docs.mapInArrow(giving_back(keep), docs.schema)


def toxic_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted, spans)``: one row per row of ``docs``; whole texts are scored.

    ``score`` is the probability of label 1, ``predicted`` is 1 from 0.5 on, ``spans`` are the (start,
    end) characters of the offending tokens. Null, empty and wordless texts get the score of a text
    without toxic tokens. Nothing but the text is looked at; repeated rows keep a row each.
    """
    schema = pa.schema(
        [
            ("score", pa.float64()),
            ("predicted", pa.int32()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            for at, texts in _chunks(batch.column(1).to_pylist()):
                found = scorer.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([x for x, _ in found], schema.field(0).type),
                        pa.array([int(x >= 0.5) for x, _ in found], schema.field(1).type),
                        pa.array([s for _, s in found], schema.field(2).type),
                    ],
                    names=["doc_id", *schema.names],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string"))
    return rows.mapInArrow(giving_back(score), f"doc_id {kind}, score double, predicted int, spans array<struct<start:int,end:int>>")
