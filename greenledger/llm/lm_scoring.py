"""Log-probabilities of documents under a log-bilinear neural model that is learnt from the documents.

**Units.** The model predicts *units*: the most frequent words, the end of a document, and classes that
all other words fall into by their look (not ASCII, punctuation at the end, longer than 6 bytes) and by
whether they are among the words whose counts every task holds. A word of a class has the class's
probability times its share ``(count + 1) / (sum + words [+ 1])`` of it; the last one, in classes of words
outside that list, is for words never met in training. So the probabilities of all words sum to one.

**Model.** ``s(w | u, v) = (r_v C_1 + r_u C_2) . t_w + b_w`` after units u, v, normalised over all units in
batched matrix products; each different context of a batch is multiplied once.

**Learning.** Every training document, in numpy, by noise-contrastive estimation: each batch shares its
noise units, drawn by unigram probability, and ``b`` starts at the unigram log-probability. Tasks learn
from a common start and their parameters are averaged by Spark, weighted by tokens, as exact integer
sums; a second round goes on from the average with the documents that the first one left.

**Counts** of words are grouped by Spark over all training documents. The driver and the tasks hold the
most frequent KNOWN words, at most WORD_BYTES long each; counts of all others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import stored

#: Words whose counts every task holds, and the longest of them in bytes; of these, those that the model predicts.
KNOWN, WORD_BYTES, PREDICTED = 100_000, 64, 1_007
#: Size of the vectors, words of context, noise units of a batch, tokens of a batch, step size.
DIM, ORDER, NOISE, BATCH, RATE = 24, 2, 64, 1024, 0.1
#: Documents are dealt to PARTS by a hash; the first round learns from FIRST of them, the second from the others.
PARTS, FIRST = 4, 1
#: Distinct words that a task counts before it hands them on; bytes of text cut into words, and tokens learnt from, at a time.
HELD_WORDS, SLICE, LEARNT = 400_000, 1 << 20, 400_000
#: Bytes of slices, about, whose words are numbered together: each different word is looked up once.
NUMBERED = 4_000_000
#: Tokens scored at a time, about 100 bytes each: the more there are, the more of them share a context.
SCORED = 1_200_000
#: Contexts that are multiplied at a time.
CONTEXTS = 1024
#: Averaged parameters are summed as integers of this scale.
FIXED = float(1 << 40)
_FOLD = bytes(0x20 if 0x09 <= b <= 0x0D else b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_POINTS = frozenset(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_SHAPES = 8
#: The end of a document, as a word.
END = b""


def folded_slices(text: bytes) -> Iterator[bytes]:
    """A text in lower case (A-Z only) with a space for any white space, slice by slice; a slice ends between words."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end] != 0x20 and not 0x09 <= text[end] <= 0x0D:
            end += 1
        yield text[at:end].translate(_FOLD)
        at = end


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice."""
    return (part.split() for part in folded_slices(text))


@dataclass
class Numbered:
    """The words of some slices: the different ones, their numbers in order, and the (text, slice is its last, from, to) of each slice."""

    words: pa.Array
    numbers: np.ndarray
    slices: list[tuple[int, bool, int, int]]


def numbered(texts: list[bytes]) -> Iterator[Numbered]:
    """The words of texts, slices of about NUMBERED bytes at a time; every text has a slice that is its last."""
    held, owners, size = [], [], 0

    def number() -> Numbered:
        lists = pc.split_pattern(pa.array(held, pa.large_binary()), " ")
        found = lists.flatten().dictionary_encode()
        numbers = found.indices.to_numpy()
        # nothing between two spaces is no word
        some = pc.greater(pc.binary_length(found.dictionary), 0).to_numpy(zero_copy_only=False)[numbers]
        ends = np.concatenate(([0], np.cumsum(some)))[lists.offsets.to_numpy()].tolist()
        slices = [(i, last, x, y) for (i, last), x, y in zip(owners, ends, ends[1:], strict=False)]
        return Numbered(found.dictionary, numbers[some], slices)

    for i, text in enumerate(texts):
        for part in folded_slices(text):
            held.append(part), owners.append((i, False))
            size += len(part)
            if size >= NUMBERED:
                yield number()
                held, owners, size = [], [], 0
        if owners and owners[-1][0] == i:
            owners[-1] = (i, True)
        else:
            held.append(b""), owners.append((i, True))
    if held:
        yield number()


def shape(word: bytes) -> int:
    return 4 * (not word.isascii()) + 2 * (word[-1:] != b"" and word[-1] in _POINTS) + (len(word) > 6)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, shape, n)`` of a task, combined."""
    held, rows, ends = [], 0, 0

    def combined() -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])

    def flush(table: pa.Table) -> pa.RecordBatch:
        words = table["word"].to_numpy().tolist()
        columns = [pa.array(words, pa.binary()), pa.array([shape(x) for x in words], pa.int32()), pa.array(table["n_sum"].to_numpy(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "shape", "n"])

    for batch in batches:
        for some in numbered(batch.column(0).to_pylist()):
            times = np.bincount(some.numbers, minlength=len(some.words)).astype(np.int64)
            held.append(pa.table({"word": some.words, "n": times}))
            rows += len(times)
            if rows > HELD_WORDS:
                whole = combined()
                held, rows = [whole.rename_columns({"n_sum": "n"})], len(whole)
                if rows > HELD_WORDS:
                    yield flush(whole)
                    held, rows = [], 0
        ends += len(batch)
    held.append(pa.table({"word": pa.array([END], pa.large_binary()), "n": [ends]}))
    yield flush(combined())


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word binary, shape int, n long)`` of all documents; the end of a document is the empty word."""
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    parts = texts.mapInArrow(_counted, "word binary, shape int, n long")
    return parts.groupBy("word", "shape").agg(F.sum("n").alias("n")).where("n > 0")


class _Known(dict):
    """Number of a known word; of any other the number of its class, counted from the end of the known ones."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.size = len(words)

    def __missing__(self, word: bytes) -> int:
        return self.size + shape(word)

    def codes(self, words: pa.Array) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words.to_numpy(zero_copy_only=False)), np.int32, len(words))


@dataclass
class LanguageModel:
    """Counts of the known words and the parameters over units.

    ``words`` and ``counts``: known words, the end first, then by falling count. Units: the first
    ``predicted`` of them, the shapes of the other known words, the shapes of words outside the list.
    ``rare``: per shape the sum of counts and the number of the words outside the list.
    """

    words: list[bytes]
    counts: np.ndarray
    shapes: np.ndarray
    rare: np.ndarray
    predicted: int
    tokens: int
    distinct: int
    context: np.ndarray
    mix: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @property
    def units(self) -> int:
        return self.predicted + 2 * _SHAPES

    @classmethod
    def start(cls, words: list[bytes], counts: list[int], shapes: list[int], rare: np.ndarray, predicted: int) -> LanguageModel:
        predicted = min(predicted, len(words))
        n, kinds = np.array(counts, np.int64), np.array(shapes, np.int64)
        rng = np.random.default_rng(7)
        self = cls(
            words, n, kinds, rare, predicted, int(n.sum() + rare[:, 0].sum()), int((n > 0).sum() + rare[:, 1].sum()),
            np.empty(0), np.repeat(0.5 * np.eye(DIM)[None], ORDER, axis=0), np.empty(0), np.empty(0),
        )
        self.context, self.target = (rng.normal(0, 0.2, (self.units, DIM)) for _ in range(2))
        self.bias = np.log(self.unigram())
        return self

    def unigram(self) -> np.ndarray:
        n = np.bincount(self.unit_of()[: len(self.counts)], weights=self.counts, minlength=self.units)
        n[self.predicted + _SHAPES :] += self.rare[:, 0]
        return (n + 1) / (n + 1).sum()

    def unit_of(self) -> np.ndarray:
        """Unit of every number that :class:`_Known` gives."""
        at = np.arange(len(self.words))
        known = np.where(at < self.predicted, at, self.predicted + self.shapes)
        return np.concatenate([known, self.predicted + _SHAPES + np.arange(_SHAPES)]).astype(np.int32)

    def share(self) -> np.ndarray:
        """log10 of a known word's share of its class, and minus log10 of what shares of an unknown word are divided by."""
        inside = np.arange(len(self.words)) >= self.predicted
        total = np.bincount(self.shapes[inside], weights=self.counts[inside] + 1, minlength=_SHAPES)
        with np.errstate(divide="ignore", invalid="ignore"):
            known = np.where(inside, np.log10(self.counts + 1) - np.log10(total[self.shapes]), 0.0)
        return np.concatenate([known, -np.log10(self.rare.sum(axis=1) + 1)])

    def parameters(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.mix, self.target, self.bias)])

    def set_parameters(self, flat: np.ndarray) -> None:
        shapes = [(self.units, DIM), (ORDER, DIM, DIM), (self.units, DIM), (self.units,)]
        parts = np.split(flat, np.cumsum([np.prod(x) for x in shapes])[:-1])
        self.context, self.mix, self.target, self.bias = (p.reshape(x) for p, x in zip(parts, shapes, strict=True))

    def history(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Units of all documents, one after the other, and the ORDER units before each; before a document stand ends."""
        all_units = np.concatenate(docs)
        place = np.concatenate([np.arange(len(x)) for x in docs])
        before = np.zeros((len(all_units), ORDER), np.int32)  # the end is unit 0
        for k in range(ORDER):
            before[k + 1 :, k] = all_units[: -k - 1]
            before[place <= k, k] = 0
        return all_units, before

    def log_probs(self, units: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Natural log-probability of each unit after its context, normalised over all units."""
        context, target, bias = (x.astype(np.float32) for x in (self.context, self.target.T, self.bias))
        bias[self.predicted + np.flatnonzero(np.bincount(self.shapes[self.predicted :], minlength=_SHAPES) == 0)] = -1e9  # no word
        mixed = [(context @ m).astype(np.float32) for m in self.mix]
        key = np.zeros(len(units), np.int64)
        for k in range(ORDER):
            key = key * self.units + before[:, k]
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        number = np.cumsum(np.diff(key[order], prepend=-1) > 0) - 1
        ends = np.append(first[CONTEXTS::CONTEXTS], len(order))
        out, at = np.empty(len(units)), 0
        for i, end in enumerate(ends):
            rows = order[at:end]
            some = before[order[first[i * CONTEXTS : (i + 1) * CONTEXTS]]]
            s = sum(mixed[k][some[:, k]] for k in range(ORDER)) @ target + bias
            s -= s.max(axis=1, keepdims=True)
            local = number[at:end] - i * CONTEXTS
            value = s[local, units[rows]]
            np.exp(s, out=s)
            out[rows] = value - np.log(s.sum(axis=1, dtype=np.float64))[local]
            at = end
        return out

    def learn(self, stream: Iterator[list[np.ndarray]], seed: int) -> int:
        """One pass of noise-contrastive estimation with AdaGrad steps; returns the number of tokens."""
        noise = self.unigram()
        cut = np.cumsum(noise)
        offset = np.log(NOISE * noise).astype(np.float32)
        rng = np.random.default_rng(seed)
        table = [x.astype(np.float32) for x in (self.context, self.mix, self.target, self.bias)]
        seen = [np.full(x.shape, 1e-2, np.float32) for x in table]
        tokens = 0
        for docs in stream:
            units, before = self.history(docs)
            tokens += len(units)
            for at in range(0, len(units), BATCH):
                steps = self._gradients(table, offset, units[at : at + BATCH], before[at : at + BATCH], cut, rng)
                for x, g, s in zip(table, steps, seen, strict=True):
                    s += g * g
                    x += RATE * g / np.sqrt(s)
        self.set_parameters(np.concatenate([x.ravel() for x in table]).astype(np.float64))
        return tokens

    def _gradients(self, table, offset, units, before, cut, rng) -> list[np.ndarray]:
        context, mix, target, bias = table
        drawn = np.minimum(np.searchsorted(cut, rng.random(NOISE)), self.units - 1)
        h = [context[before[:, k]] for k in range(ORDER)]
        q = sum(x @ m for x, m in zip(h, mix, strict=True))
        t = target[units]
        real = np.einsum("ij,ij->i", q, t) + bias[units] - offset[units]
        fake = q @ target[drawn].T + (bias - offset)[drawn]
        real = _sigmoid(-real)  # what the gradient of log sigmoid weighs
        fake = -_sigmoid(fake)
        n = np.float32(1 / len(units))
        dq = (real[:, None] * t + fake @ target[drawn]) * n
        d_target = self._summed(units, real[:, None] * q * n)
        np.add.at(d_target, drawn, (fake.T @ q) * n)
        d_bias = np.bincount(units, weights=real * n, minlength=self.units).astype(np.float32)
        np.add.at(d_bias, drawn, fake.sum(axis=0) * n)
        d_context = sum(self._summed(before[:, k], dq @ mix[k].T) for k in range(ORDER))
        d_mix = np.stack([x.T @ dq for x in h])
        return [d_context, d_mix, d_target, d_bias]

    def _summed(self, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums of the vectors of equal rows."""
        at = np.add.outer(rows.astype(np.int64) * DIM, np.arange(DIM)).ravel()
        return np.bincount(at, weights=values.ravel(), minlength=self.units * DIM).reshape(-1, DIM).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.clip(np.negative(x), -30, 30)
    np.exp(out, out=out)
    out += 1
    return np.divide(1, out, out=out)


def _unit_stream(model: LanguageModel, batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Units of the documents, whole documents at a time, or slices of a long one."""
    known, unit_of = _Known(model.words), model.unit_of()
    held, parts, size = [], [], 0
    for batch in batches:
        for some in numbered(batch.column(0).to_pylist()):
            units = unit_of[known.codes(some.words)][some.numbers]
            for _, last, start, end in some.slices:
                parts.append(units[start:end])
                if not last:
                    continue
                held.append(np.concatenate([*parts, np.zeros(1, np.int32)]))
                parts = []
                size += len(held[-1])
                if size >= LEARNT:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _round(docs: DataFrame, model: LanguageModel, text_col: str) -> None:
    """Learn from all rows of ``docs`` in parallel and take the average, weighted by tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    total = max(1, model.tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value
        own = LanguageModel(**vars(base))
        tokens = own.learn(_unit_stream(own, batches), seed=TaskContext.get().partitionId())
        if tokens:
            weight = tokens / total
            values = np.rint(np.append(own.parameters(), 1.0) * (weight * FIXED)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([values], pa.list_(pa.int64()))], names=["values"])

    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    parts = texts.mapInArrow(run, "values array<long>").select(F.posexplode("values").alias("at", "x"))
    sums = parts.groupBy("at").agg(F.sum("x").alias("x")).toArrow().sort_by("at")["x"].to_numpy()
    if len(sums) and sums[-1] > 0:
        model.set_parameters(sums[:-1] / sums[-1])
    shared.unpersist()


def train_language_model(
    docs: DataFrame, text_col: str = "text", predicted: int = PREDICTED, known: int = KNOWN
) -> tuple[LanguageModel, DataFrame]:
    """A model of all ``docs`` and the stored counts ``(word, shape, n)`` of their words.

    Null text is empty: an end alone. Without documents the model is uniform over its classes.
    """
    counts = stored(word_counts(docs, text_col), "word-counts")
    short = counts.where(F.octet_length("word") <= WORD_BYTES)
    # the list's bound: `known` words of WORD_BYTES
    top = short.where(F.octet_length("word") > 0).orderBy(F.col("n").desc(), "word").limit(known)
    top = stored(top.unionByName(short.where(F.octet_length("word") == 0)), "known-words")
    rows = sorted(top.collect(), key=lambda r: (r.word != END, -r.n, bytes(r.word)))
    words = [bytes(r.word) for r in rows]
    listed, kinds = [r.n for r in rows], [r["shape"] for r in rows]
    if END not in words[:1]:
        words, listed, kinds = [END, *words], [0, *listed], [0, *kinds]
    every = counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    rare = np.zeros((_SHAPES, 2), np.int64)
    for r in every:
        rare[r["shape"]] = r.n, r.words
    np.subtract.at(rare, (np.array(kinds), 0), listed)
    np.subtract.at(rare, (np.array(kinds), 1), [int(n > 0) for n in listed])
    model = LanguageModel.start(words, listed, kinds, rare, predicted)
    part = F.pmod(F.xxhash64(text_col), F.lit(PARTS))
    for some in (part < FIRST, part >= FIRST):
        _round(docs.where(some), model, text_col)
    return model, counts


_SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, score double, words array<binary>, times array<long>"


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known, unit_of, share = _Known(model.words), model.unit_of(), model.share()
        raised = np.concatenate([np.log10(model.counts + 1), np.zeros(_SHAPES)])
        held, row = [], TaskContext.get().partitionId() << 36

        def flush() -> Iterator[pa.RecordBatch]:
            log_p = [unit_of[codes] for _, codes, _ in held]
            units, before = model.history(log_p)
            out = np.empty(len(units))
            for at in range(0, len(units), SCORED):
                out[at : at + SCORED] = model.log_probs(units[at : at + SCORED], before[at : at + SCORED])
            ends = np.cumsum([len(codes) for _, codes, _ in held])
            rows = []
            for k, ((doc_id, codes, tail), end) in enumerate(zip(held, ends.tolist(), strict=True)):
                n = len(codes)
                score = float(out[end - n : end].sum()) / np.log(10) + float(share[codes].sum())
                met = int((codes < known.size).sum()) if model.tokens else 0
                rows.append((row + k, doc_id, n, met, float(raised[codes].sum()), score, list(tail), list(tail.values())))
            types = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.list_(pa.binary()), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _SCORED.split(", ")])

        size, parts, tail = 0, [], Counter()
        for batch in batches:
            names = batch.column(0).to_pylist()
            for some in numbered(batch.column(1).to_pylist()):
                codes = known.codes(some.words)[some.numbers]
                missed = np.flatnonzero(codes >= known.size)
                cuts = np.searchsorted(missed, [x for _, _, *span in some.slices for x in span]).tolist()
                missed = some.words.take(pa.array(some.numbers[missed])).to_numpy(zero_copy_only=False).tolist()
                for k, (i, last, start, end) in enumerate(some.slices):
                    parts.append(codes[start:end])
                    tail.update(missed[cuts[2 * k] : cuts[2 * k + 1]])
                    if not last:
                        continue
                    held.append((names[i], np.concatenate([*parts, np.zeros(1, np.int32)]), tail))
                    parts, tail = [], Counter()
                    size += len(held[-1][1])
                    if size >= SCORED:
                        yield from flush()
                        row += len(held)
                        held.clear()
                        size = 0
        if held:
            yield from flush()

    return run


def score_documents(
    docs: DataFrame, training: Column | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    The counts and the model come from the rows where ``training`` holds (all by default; null does not
    hold), ``score`` is the model's log10 probability of the text with its end, ``base_score`` the sum of
    ``log10((count + 1) / (N + V + 1))``. Null text is empty, so the end alone; null ids, repeated rows and
    an empty table are like any others; other columns are not looked at. Long texts are cut in slices.
    """
    training = F.lit(True) if training is None else F.coalesce(training, F.lit(False))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), training.alias("training")
    )
    model, counts = train_language_model(rows.where("training"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = rows.select("doc_id", F.coalesce("text", F.lit("")).cast("binary"), "training")
    scored = texts.mapInArrow(_with_flag(_scored(shared)), f"{_SCORED}, held_out boolean")
    scored = stored(scored, "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x"))
    tail = tail.select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    tail = tail.join(counts.select("word", "n"), "word", "left")
    raised = F.log10(F.coalesce(F.col("n"), F.lit(0)) + 1.0).cast("decimal(20,12)")  # exact sums, in any order
    found = tail.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("more"),
        F.sum(raised * F.col("times").cast("decimal(18,0)")).cast("double").alias("logs"),
    )
    out = scored.drop("words", "times").join(found, "row", "left").na.fill(0, ["more"]).na.fill(0.0, ["logs"])
    below = float(np.log10(model.tokens + model.distinct + 1))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("more")).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("logs") - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (F.col("score") + F.col("logs")).alias("score"),
    )


def _with_flag(run):
    """``run`` over the first two columns; the third, ``training``, comes back as ``held_out``, in the same order."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags: list[bool] = []

        def first() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flags.extend(not x for x in batch.column(2).to_pylist())
                yield batch.select([0, 1])

        for out in run(first()):
            mine = pa.array(flags[: len(out)], pa.bool_())
            del flags[: len(out)]
            yield pa.RecordBatch.from_arrays([*out.columns, mine], names=[*out.schema.names, "held_out"])

    return both
