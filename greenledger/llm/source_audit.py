"""How far each source of a language departs from the language: count-cell ranking of term frequencies.

Terms of a group with the same count there and the same count in the language are one *cell*: they have
one frequency, one departure and need one evaluation. Cells of equal departure are merged, ranked by
cumulative multiplicity, and only the values that reach the report are expanded into terms, in UTF-8
order. Pairs of sources are summed over cells of their two counts in the same way.

Counting runs inside tasks (one pass over the bytes of the texts) and is combined before every shuffle.
A frequency is ``1 + floor(SCALE (count + SMOOTH) / (N + SMOOTH V))`` in exact integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.llm.common import stored

# The scale of a frequency, what every count is raised by, and the bytes that are part of a term.
SCALE, SMOOTH = 1_000_000_000, 5
_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Every other byte is a blank, A-Z become lower case.
_FOLD = bytes((b | 0x20 if 0x41 <= b <= 0x5A else b) if b in _LETTERS else 0x20 for b in range(256))
#: Distinct terms of all groups that a task counts before it hands them on.
HELD_TERMS = 400_000
#: Bytes of text that are cut into terms at a time.
SLICE = 1 << 20
#: Sources of a language that are compared in one block, and rows of counts, about, that a task compares.
SOURCE_BLOCK, SLICE_ROWS = 256, 100_000


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice; a slice ends between terms."""
    at = 0
    while at < len(text):
        part = text[at : at + SLICE].translate(_FOLD)
        end = len(part)
        if at + end < len(text):
            cut = part.rfind(b" ") + 1
            if cut:
                end = cut
            else:  # a term that fills the slice: take it whole
                more = text[at + end :].translate(_FOLD).find(b" ")
                end = len(text) - at if more < 0 else end + more
                part = text[at : at + end].translate(_FOLD)
        yield part[:end].split()
        at += end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, source, term, n, docs)`` of a task, combined; a row without a term counts the group's documents."""
    uses: dict = defaultdict(Counter)
    docs: dict = defaultdict(Counter)
    size: Counter = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), n in size.items():
            terms = list(docs[lang, source])
            count, seen = uses[lang, source], docs[lang, source]
            columns = [
                pa.array([lang] * (len(terms) + 1), pa.string()),
                pa.array([source] * (len(terms) + 1), pa.string()),
                pa.array([None, *terms], pa.binary()).cast(pa.string(), safe=False),
                pa.array([0, *map(count.__getitem__, terms)], pa.int64()),
                pa.array([n, *map(seen.__getitem__, terms)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        uses.clear(), docs.clear(), size.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key = (lang, source)
            count, seen, own = uses[key], docs[key], set()
            before = len(seen)
            size[key] += 1
            for terms in _slices(text):
                count.update(terms)
                own.update(terms)
            seen.update(own)
            held += len(seen) - before
            if held > HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """``(lang, source, term, n, docs)``: uses of a term in a group and documents that hold it; null counts as ''.

    The row of a group whose ``term`` is null carries the group's documents, so groups without a term are there too.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).cast("binary"))
    parts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _frequency(count: Column, total: Column, terms: Column) -> Column:
    """In DECIMAL(38,0), so counts up to 10**28 are exact; null where the language keeps no term."""
    whole = lambda c: c.cast("decimal(29,0)")
    above = (whole(count) + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)")
    below = whole(total) + whole(terms) * F.lit(SMOOTH).cast("decimal(2,0)")
    return F.lit(1) + F.call_function("div", above, F.nullif(below, F.lit(0)))


def kept_counts(counts: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """``(rows, groups)``: kept terms with p and q, and all groups with N, V and the p of a term that they lack.

    ``rows``: ``lang, source, term, n, lang_n, p, q``. ``groups``: ``lang, source, total, v, p0``.
    """
    counts = stored(counts, "audit-counts")
    terms = counts.where(F.col("term").isNotNull())
    kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = stored(kept.where(F.col("docs") >= min_docs).drop("docs"), "audit-kept")
    rows = stored(terms.drop("docs").join(kept, ["lang", "term"]), "audit-rows")
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (
        counts.where(F.col("term").isNull())
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "v", "lang_total"])
        .withColumn("p0", _frequency(zero, F.col("total"), F.col("v")))
    )
    groups = stored(groups, "audit-groups")
    p = _frequency(F.col("n"), F.col("total"), F.col("v"))
    q = _frequency(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    rows = rows.join(groups.drop("p0"), ["lang", "source"]).withColumns({"p": p, "q": q})
    return rows.select("lang", "source", "term", "n", "lang_n", "p", "q"), groups


def rising_terms(rows: DataFrame, top: int) -> DataFrame:
    """``(lang, source, item, value, rank)``: the ``top`` terms of each group that it uses more than its language.

    Cells by (count in the group, count in the language); equal values merged and ranked by cumulative
    multiplicity; of the values that begin within ``top``, the first terms in UTF-8 order.
    """
    group = ["lang", "source"]
    more = rows.where((F.col("n") > 0) & (F.col("p") > F.col("q")))
    cells = more.groupBy(*group, "n", "lang_n").agg(F.count(F.lit(1)).alias("m"), F.first("p").alias("p"), F.first("q").alias("q"))
    values = cells.withColumn("value", F.col("p") - F.col("q")).groupBy(*group, "value").agg(F.sum("m").alias("m"))
    down = Window.partitionBy(*group).orderBy(F.col("value").desc())
    first = values.withColumn("_k", F.row_number().over(down)).where(F.col("_k") <= top)
    before = F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1))
    first = first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
    wanted = more.withColumn("value", F.col("p") - F.col("q")).join(first.select(*group, "value", "before"), [*group, "value"])
    place = F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))
    ranked = wanted.withColumn("_k", place).where(F.col("_k") <= top).withColumn("rank", F.col("before") + F.col("_k"))
    return ranked.where(F.col("rank") <= top).select(*group, F.col("term").alias("item"), "value", F.col("rank").cast("int"))


def _cell_sums(table: pa.Table) -> pa.Table:
    """Sums of |p - p'| over the terms of one slice, for the pairs of its sources; each cell of two counts once.

    Terms are counted as far as they differ from a term that both sources lack; the first slice adds the
    language's V terms as such, so terms of other blocks are there too.
    """
    plain = table.to_pydict()
    lang, left, right = plain["lang"][0], plain["left"][0], plain["right"][0]
    all_terms = max(plain["v"]) if plain["slice"][0] == 0 else 0
    lacking = {s: (b, p) for s, t, b, p in zip(plain["source"], plain["term"], plain["block"], plain["p"], strict=True) if t is None}
    names = sorted(lacking)
    column = {s: i for i, s in enumerate(names)}
    term: dict[str, int] = {}
    at = [(term.setdefault(t, len(term)), column[s], p) for s, t, p in zip(plain["source"], plain["term"], plain["p"], strict=True) if t is not None]
    p = np.repeat(np.array([[lacking[s][1] or 0 for s in names]], np.int64), len(term), axis=0)
    if at:
        rows, cols, values = (np.array(x, np.int64) for x in zip(*at, strict=True))
        p[rows, cols] = values
    # a source's frequencies as codes: a cell of a pair is a pair of codes
    coded = [np.unique(p[:, i], return_inverse=True) for i in range(len(names))]
    block = np.array([lacking[s][0] for s in names])
    out = []
    for i, a in enumerate(names):
        level_a, code_a = coded[i]
        for j in range(len(names)):
            if block[i] != left or block[j] != right or (left == right and j <= i):
                continue
            level_b, code_b = coded[j]
            cell, m = np.unique(code_a * len(level_b) + code_b, return_counts=True)
            f = np.abs(level_a[cell // max(1, len(level_b))] - level_b[cell % max(1, len(level_b))])
            none = abs((lacking[a][1] or 0) - (lacking[names[j]][1] or 0))
            out.append((a, names[j], int(f @ m) + (all_terms - len(term)) * none))
    a, b, value = zip(*out, strict=True) if out else ((), (), ())
    columns = [pa.array([lang] * len(out), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(value, pa.int64())]
    return pa.Table.from_arrays(columns, names=["lang", "a", "b", "part"])


def source_pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value, rank)``: every other source of the language by summed departure.

    Terms are dealt in slices and sources in blocks, so a task holds about SLICE_ROWS rows of counts
    whatever the language's size; a row is repeated once per block of sources, not per source.
    """
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    blocks = -(-most // SOURCE_BLOCK) or 1
    slices = rows.count() * blocks // SLICE_ROWS + 1
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    slice_of = F.pmod(F.xxhash64("term"), F.lit(slices)).alias("slice")
    used = rows.select("lang", "source", "term", "p", slice_of, F.lit(0).cast("long").alias("v"))
    lack = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "v")
    lack = lack.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("slice", F.col("slice").cast("long"))
    every = used.unionByName(lack).withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    dealt = every.select("*", other).withColumns(
        {"left": F.least("block", "other"), "right": F.greatest("block", "other")}
    )
    parts = dealt.drop("other").groupBy("lang", "left", "right", "slice").applyInArrow(
        _cell_sums, "lang string, a string, b string, part long"
    )
    sums = stored(parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value")), "audit-pairs")
    both = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return both.withColumn("rank", F.row_number().over(order))


def source_divergence(
    docs: DataFrame,
    min_docs: int = 30,
    top: int = 50,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Audit of every (language, source) group: ``lang, source, part, item, value, rank``.

    Part ``pair`` ranks the language's other sources by the sum of |p - p'| over all kept terms (0 where
    the language keeps none), part ``term`` the ``top`` kept terms that the group uses more than the
    language does. Null text, language or source count as ''; empty texts and repeated rows count as
    documents like any others; an empty table gives no row; other columns, whatever their names, are
    not looked at. Texts are read whole, in slices. Ties stand in UTF-8 order of the item.
    """
    rows, groups = kept_counts(term_counts(docs, lang_col, source_col, text_col), min_docs)
    rows = stored(rows, "audit-frequencies")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_pairs(rows, groups).withColumn("part", F.lit("pair")).select(columns)
    return pairs.unionByName(rising_terms(rows, top).withColumn("part", F.lit("term")).select(columns))
