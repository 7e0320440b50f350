"""Benchmark decontamination with SimHash windows, in DataFrame functions only.

A benchmark item of n words is compared with windows of n words of the documents (a shorter document
is one window). Words are lower-cased runs of letters and digits; both sides are bags of their 5-word
shingles (an item of fewer words is one shingle), and the similarity is the weighted Jaccard of the
bags, a shingle's weight being the times it occurs.

1. Windows. A window and an item of m shingles each that are ``threshold`` similar share at least
   2 * threshold / (1 + threshold) of them. At 0.8 at most m / 9 differ, so some run of the window's
   shingles that the item has too is min(m, 4) long, and one of every ``stride`` <= min(m, 4)
   positions of the document hits it. Documents without a hit are settled. In the others every
   position is looked at, and each window of m positions of which all but m / 9 hold a shingle of
   some item of that size is taken, wherever in the item the shingle stands: the bags of a similar
   window share at least as many, also if the item repeats itself or its parts are in another order.
2. Candidates. A similar item shares one of the window's first shingles with it, rarest first (the
   more of the window's shingles some item has, the more of them are looked at, up to a fifth), so a
   window meets only items with a rare shingle in common, not all items of its size. Within these,
   the SimHash of each bag selects: ``radius + 1`` blocks of bits index the items, and of two
   fingerprints within the radius at least one block is equal, so the equi-join on (size, block,
   shingle) misses none of them. Only narrow rows go through it; shingles are fetched for the pairs
   within the radius.
3. Similarity. Those pairs are verified exactly on their shingles.

Work is done per text, once for all rows that hold it, and per item text; ids return at the end. So
a hot id, null included, pools nothing, and copies cost nothing.

A bit differs where the shared shingles are in balance: at a similarity of 0.8 in at most 3 of 16
bits (a text of 4 shingles against an item of 5), in 0.12 to 0.16 from 9 shingles on. The default
radius of 26 then loses at most 2 in 100,000 borderline pairs (binomial, ``missed``; tested).
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import broadcast_if_small, stored

SHINGLE = 5
#: Rows of 16 bytes up to which a table is broadcast; beyond, the join shuffles.
SMALL = 500_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null for null."""
    return F.array_remove(F.split(F.lower(text.cast("string")), r"[^\p{L}\p{N}]+"), "")


def _sql(template: str, **parts: str) -> Column:
    return F.expr(template.format(**parts))


def _shingles(n: str = "size(w)", k: str = str(SHINGLE), step: str = "1") -> Column:
    """Hashes of the shingles of column ``w`` at every ``step``-th word (none if it has fewer than k words)."""
    return _sql(
        "CASE WHEN {n} >= {k} THEN transform(sequence(0, {n} - {k}, {step}), i -> xxhash64(slice(w, i + 1, {k}))) "
        "ELSE CAST(array() AS array<bigint>) END",
        n=n,
        k=k,
        step=step,
    )


def simhash(hashes: str) -> Column:
    """SimHash of an array of hashes: bits set in over half of them. Two 32-bit counters share a long."""
    sums = (
        "transform(sequence(0, 31), j -> aggregate({h}, 0L, (a, x) -> a + (shiftright(x, j) & 4294967297L)))"
    )
    return _sql(
        "aggregate(transform(" + sums + ", (s, j) -> "
        "CASE WHEN 2 * (s & 4294967295L) > size({h}) THEN shiftleft(1L, j) ELSE 0L END | "
        "CASE WHEN 2 * shiftrightunsigned(s, 32) > size({h}) THEN shiftleft(1L, j + 32) ELSE 0L END), "
        "0L, (a, x) -> a | x)",
        h=hashes,
    )


def missed(radius: int, differs: float) -> float:
    """Chance that more than ``radius`` of 64 bits differ, each by the chance ``differs``."""
    return sum(comb(64, k) * differs**k * (1 - differs) ** (64 - k) for k in range(radius + 1, 65))


def _numbered(hashes: str) -> Column:
    """Each hash with how often it has occurred so far, so that sets of them are bags."""
    return _sql(
        "CASE WHEN size(array_distinct({h})) = size({h}) THEN transform({h}, x -> struct(x AS h, 1 AS n)) "
        "ELSE transform({h}, (x, i) -> struct(x AS h, size(filter(slice({h}, 1, i + 1), y -> y = x)) AS n)) END",
        h=hashes,
    )


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of radius + 1 blocks of 64 bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _block_values(fp: str, radius: int) -> Column:
    parts = [f"struct({i} AS b, shiftrightunsigned({fp}, {a}) & {m}L AS v)" for i, (a, m) in enumerate(_blocks(radius))]
    return F.explode(F.expr(f"array({', '.join(parts)})"))


def _first_block(xor: str, radius: int) -> Column:
    cases = " ".join(f"WHEN shiftrightunsigned({xor}, {a}) & {m}L = 0 THEN {i}" for i, (a, m) in enumerate(_blocks(radius)))
    return F.expr(f"CASE {cases} END")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("string").cast("binary")))


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, item, n, hs, fp)`` per item that has words, ``item`` told by its words; equal rows count once."""
    w = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).distinct()
    w = w.where(F.size("w") > 0).withColumn("n", F.size("w")).withColumn("item", _digest(F.array_join("w", " ")))
    w = w.withColumn("hs", F.when(F.col("n") >= SHINGLE, _shingles()).otherwise(F.array(F.expr("xxhash64(w)"))))
    return stored(w.withColumn("fp", simhash("hs")).drop("w"), "benchmark")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    radius: int = 26,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, start_word, n_words, similarity, distance)``: the best window of each matching pair.

    Of equally similar windows the first counts. Null, empty and wordless texts match nothing; null
    ids are matched like others, as one id. Rows of one id are one document for the result: its best
    window over them. Texts are taken whole, however long. Empty tables give no rows. Other columns
    are ignored, and ``threshold`` must be at least 0.8 (see the module).
    """
    if threshold < 0.8:
        raise ValueError("windows are complete for a threshold of 0.8 or more")
    items = benchmark_items(benchmark, item_col, item_text_col)
    sizes = [r[0] for r in items.where(F.col("n") < SHINGLE).select("n").distinct().collect()]  # 4 at most
    least = items.where(F.col("n") >= SHINGLE).agg(F.min("n")).first()[0] or SHINGLE
    stride = max(1, min(4, least - SHINGLE + 1))
    by_text = items.dropDuplicates(["item"]).drop("item_id")
    # Which shingles stand in items of which size, and in how many.
    seeds = by_text.select("n", F.explode(F.array_distinct("hs")).alias("h")).groupBy("n", "h").agg(F.count("*").alias("c"))
    seeds = stored(seeds, "benchmark-seeds")
    spread_seeds = broadcast_if_small(seeds, SMALL)

    def hits_in(rows: DataFrame, keys: list[str], stride: int) -> DataFrame:
        looked = [(str(SHINGLE), str(stride)), *((str(k), "1") for k in sizes)]
        hits = None
        for k, step in looked:
            at = rows.select(*keys, F.size("w").alias("len"), F.posexplode(_shingles(k=k, step=step)).alias("p", "h"))
            at = at.select(*keys, "len", (F.col("p") * int(step)).alias("p"), "h")
            kind = F.col("n") >= SHINGLE if k == str(SHINGLE) else F.col("n") == int(k)
            found = at.join(spread_seeds.where(kind), "h").select(*keys, "len", "n", "p", "c", "h")
            hits = found if hits is None else hits.unionByName(found)
        return hits

    texts = docs.select(
        F.col(id_col).alias("doc_id"), _digest(F.col(text_col)).alias("text_key"), words(F.col(text_col)).alias("w")
    )
    some = stored(hits_in(texts, ["doc_id", "text_key"], stride).select("doc_id", "text_key").distinct(), "hit-documents")
    hit_keys = broadcast_if_small(stored(some.select("text_key").distinct(), "hit-texts"), SMALL)
    # Each text once, in words, so later steps need not look at other documents again.
    again = texts.join(hit_keys, "text_key", "left_semi").select("text_key", "w")
    again = stored(again.groupBy("text_key").agg(F.first("w").alias("w")), "hit-words")
    hits = hits_in(again, ["text_key"], 1).groupBy("text_key", "len", "n")
    hits = hits.agg(F.sort_array(F.collect_set(F.struct("p", "c", "h"))).alias("ps"))
    # Shingles of the item and of a window, and how many of them at least a similar pair shares.
    hits = hits.withColumn("m", F.greatest(F.col("n") - (SHINGLE - 1), F.lit(1)))
    hits = hits.withColumn("mw", F.when(F.col("len") < F.col("n"), F.col("len") - (SHINGLE - 1)).otherwise(F.col("m")))
    hits = hits.withColumn("need", F.expr("CAST((4 * (m + mw) + 8) div 9 AS int)")).where("mw > 0 AND size(ps) >= need")
    # From the i-th hit on, windows that start after the hit before and reach the ``need``-th hit.
    starts = F.expr(
        "flatten(transform(filter(transform(sequence(0, size(ps) - need), i -> struct(i AS i, "
        "greatest(ps[i + need - 1].p - mw + 1, CASE WHEN i > 0 THEN ps[i - 1].p + 1 ELSE 0 END, 0) AS a, "
        "least(ps[i].p, greatest(len - n, 0)) AS b)), x -> x.a <= x.b), "
        "x -> transform(sequence(x.a, x.b), s -> struct(s AS s, x.i AS i))))"
    )
    windows = hits.select("*", F.explode(starts).alias("x"))
    # A window's hits, rarest first; the last ``need - 1`` of them cannot be all that it shares.
    windows = windows.withColumn(
        "own", F.expr("array_sort(transform(filter(slice(ps, x.i + 1, mw), y -> y.p < x.s + mw), y -> struct(y.c, y.h)))")
    )
    rare = F.expr("array_distinct(transform(slice(own, 1, size(own) - need + 1), y -> y.h))")
    windows = windows.select("text_key", "n", F.col("x.s").alias("s"), rare.alias("rare"))
    windows = stored(windows.groupBy("text_key").agg(F.collect_list(F.struct("s", "n", "rare")).alias("ws")), "windows")

    mine = again.join(windows, "text_key").select("text_key", "w", "ws", _shingles().alias("all"))
    cut = F.expr(
        "transform(ws, x -> struct(x.s AS s, x.n AS n, x.rare AS rare, CASE "
        f"WHEN x.n >= {SHINGLE} THEN slice(all, x.s + 1, x.n - {SHINGLE - 1}) "
        "ELSE array(xxhash64(slice(w, x.s + 1, x.n))) END AS hs, least(x.n, size(w)) AS words))"
    )
    cut = mine.select("text_key", F.explode(cut).alias("x")).select("text_key", "x.*")
    cut = stored(cut.withColumn("fp", simhash("hs")), "window-bags")

    def listed(rows: DataFrame, *names: str) -> DataFrame:
        out = rows.select(*names, "n", "rare", _block_values("fp", radius).alias("x"))
        return out.select(*names, "n", "x.b", "x.v", F.explode("rare").alias("h"))

    # An item's rarest shingles: a window of any length that is similar has four fifths of them all.
    order = by_text.select("item", "n", F.explode("hs").alias("h")).join(seeds, ["n", "h"]).groupBy("item", "n")
    order = order.agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("own"))
    order = order.select("item", F.expr("array_distinct(transform(slice(own, 1, size(own) div 5 + 1), y -> y.h))").alias("rare"))
    index = listed(by_text.join(order, "item"), "item", "fp").withColumnRenamed("fp", "ifp")
    index = broadcast_if_small(stored(index, "benchmark-index"), SMALL)
    pairs = listed(cut, "text_key", "s", "fp").join(index, ["n", "b", "v", "h"])
    pairs = pairs.where(_first_block("(fp ^ ifp)", radius) == F.col("b"))
    pairs = pairs.withColumn("distance", F.bit_count(F.expr("fp ^ ifp"))).where(F.col("distance") <= radius)
    pairs = stored(pairs.select("text_key", "s", "n", "item", "distance").distinct(), "window-pairs")
    pairs = pairs.join(cut.select("text_key", "s", "n", "words", "hs"), ["text_key", "s", "n"])
    pairs = pairs.join(by_text.select("item", F.col("hs").alias("ihs")), "item")
    pairs = pairs.withColumn("shared", F.size(F.array_intersect(_numbered("hs"), _numbered("ihs"))))
    alike = F.col("shared") / (F.size("hs") + F.size("ihs") - F.col("shared"))
    pairs = pairs.select("text_key", "item", "s", "words", "distance", alike.alias("similarity"))
    best = F.max(F.struct("similarity", (-F.col("s")).alias("s"), "words", (-F.col("distance")).alias("d"))).alias("x")
    pairs = pairs.where(F.col("similarity") >= threshold).groupBy("text_key", "item").agg(best)
    # Back to ids.
    pairs = pairs.join(items.select("item_id", "item"), "item").join(some, "text_key")
    pairs = pairs.groupBy("doc_id", "item_id").agg(F.max("x").alias("x"))
    return pairs.select(
        "doc_id",
        "item_id",
        (-F.col("x.s")).alias("start_word"),
        F.col("x.words").alias("n_words"),
        F.col("x.similarity").alias("similarity"),
        (-F.col("x.d")).alias("distance"),
    )
