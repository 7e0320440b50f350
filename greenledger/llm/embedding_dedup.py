"""Embedding near-deduplication with randomised-rotation binary codes.

Each unit vector o is rotated at random and stored as its sign code o' (a point of the cube's corners,
scaled to length 1) and the correction factor t = <o', o>. For a unit vector q, <o', q> / t estimates
<o, q> without bias over rotations, and the angles bound it: angle(o', q) <= angle(o', o) +
angle(o, q). So if cos(o, q) >= threshold, then <o', q> >= cos(acos t + acos threshold); a pair
below that bound is settled by its code, every other pair is recomputed exactly. The bound is
certain, not a confidence level, so no link is lost.

Pairs are only looked at within cells: the leading ``bits`` of the code name a vector's home cell. If
|x - y| <= r (r ** 2 = 2 - 2 * threshold), the code bits in which x and y differ are coordinates of
opposite sign, where (x_i - y_i) ** 2 >= x_i ** 2 + y_i ** 2. So |x_F| ** 2 + |y_F| ** 2 <= r ** 2 over
those coordinates F, and one of the two has |x_F| ** 2 <= r ** 2 / 2. Each vector therefore probes the
cells that differ from its home in a set F of bits with |x_F| ** 2 <= r ** 2 / 2; every link is met from
at least one side. Cells narrow as the largest label grows.

Equal vectors are collapsed before the search and counted after it. A hot cell is split into blocks of
bounded size, each met by every probe of the cell: blocks are compared, pairs are never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import connected_components, stored

#: Vectors of the largest label that one cell holds, about.
CELL = 256
#: Vectors of a block, about, and probes that are compared with it at a time.
BLOCK, PROBES = 4096, 1024
#: Vectors that are dealt to cells at a time.
DEALT = 1000
MAX_BITS = 20
SEED = 7
_SLACK = 1e-5


def rotation(dim: int) -> np.ndarray:
    """A random rotation, the same everywhere."""
    gauss = np.random.default_rng([SEED, dim]).standard_normal((dim, dim))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def probes(key: np.ndarray, budget: float) -> list[int]:
    """Sets F of key bits, as masks, with sum of key[F]**2 <= budget (the empty set too)."""
    square = key.astype(np.float64) ** 2
    order = np.argsort(square)
    found = [(0, 0.0)]
    for i in order:
        if square[i] > budget:
            break
        found += [(m | 1 << int(i), s + square[i]) for m, s in found if s + square[i] <= budget]
    return [m for m, _ in found]


class _Side:
    """Vectors of a block with their codes and correction factors."""

    def __init__(self, part: pd.DataFrame, bits: int):
        raw = np.array(part["v"].tolist(), dtype=np.float64).reshape(len(part), -1)
        self.id, self.n = part["id"].to_numpy(), part["n"].to_numpy()
        self.raw = raw / np.abs(raw).max(axis=1, keepdims=True)
        self.norm = np.linalg.norm(self.raw, axis=1)
        self.turned = turn(raw)
        self.sign = self.turned >= 0
        self.code = np.where(self.sign, 1, -1).astype(np.float32) / np.float32(math.sqrt(raw.shape[1]))
        self.factor = (self.code * self.turned).sum(axis=1)
        self.bits = min(bits, raw.shape[1])


def turn(raw: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows, rotated."""
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    return (unit @ rotation(raw.shape[1])).astype(np.float32)


def links(home: _Side, probe: _Side, threshold: float, half: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of linked (probe, home) pairs; a pair that both sides meet is kept by one of them."""
    k = home.bits
    floor = np.cos(np.minimum(np.pi, np.arccos(np.clip(home.factor, -1, 1)) + math.acos(threshold))) - _SLACK
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for at in range(0, len(probe.id), PROBES):
        part = slice(at, at + PROBES)
        rows, cols = np.nonzero(probe.turned[part] @ home.code.T >= floor)
        rows += at
        keep = probe.id[rows] != home.id[cols]
        rows, cols = rows[keep], cols[keep]
        for cut in range(0, len(rows), 1 << 16):
            r, c = rows[cut : cut + (1 << 16)], cols[cut : cut + (1 << 16)]
            cosine = np.einsum("ij,ij->i", probe.raw[r], home.raw[c]) / (probe.norm[r] * home.norm[c])
            r, c = r[cosine >= threshold], c[cosine >= threshold]
            differ = probe.sign[r, :k] != home.sign[c, :k]
            back = (home.turned[c, :k].astype(np.float64) ** 2 * differ).sum(axis=1) <= half
            keep = ~back | (probe.id[r] < home.id[c])
            found.append((r[keep], c[keep]))
    rows, cols = zip(*found, strict=True)
    return np.concatenate(rows), np.concatenate(cols)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node of its component in the graph (a, b)."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for ends in (x, y, label[x], label[y]):
            np.minimum.at(new, ends, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def embedding_near_dedup(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one row per row of ``vectors``.

    Two vectors are linked if their labels are equal and not null, their dimensions are equal and
    their cosine, in double precision, is at least ``threshold``. Vectors that are null, empty, zero
    or hold null or non-finite components link with nothing; so do rows with a null label. Repeated
    rows of one id are rows of their own and linked with each other; a null id counts as a link of
    others but never names a component. Other columns are ignored.
    """
    values = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), values.alias("v"), F.col(label_col).alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)
    text = F.concat_ws("|", F.col("label").cast("string"), F.array_join(F.col("v").cast("array<string>"), ","))
    key = F.when(F.coalesce(good, F.lit(False)), F.unhex(F.sha2(text.cast("binary"), 256)))
    rows = stored(rows.withColumn("key", key), "vectors")
    # Equal vectors are one class.
    classes = rows.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("vec_id").alias("least"),
        F.first("v").alias("v"),
        F.first("label").alias("label"),
    )
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("label", F.size("v")).count().agg(F.max("count")).first()[0] or 1
    bits = max(0, min(MAX_BITS, math.ceil(math.log2(largest / CELL))))
    half = (2 - 2 * threshold) / 2 + _SLACK  # r ** 2 / 2

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby(frame["v"].map(len)):
                for at in range(0, len(part), DEALT):
                    yield from dealt_out(part.iloc[at : at + DEALT], dim)

    def dealt_out(part: pd.DataFrame, dim: int) -> Iterator[pd.DataFrame]:
        turned = turn(np.array(part["v"].tolist(), dtype=np.float64))
        k = min(bits, dim)
        home = (turned[:, :k] >= 0).astype(np.int64) @ (1 << np.arange(k, dtype=np.int64))
        masks = [probes(x, half) for x in turned[:, :k]]
        row = np.repeat(np.arange(len(part)), [len(m) for m in masks])
        cell = home[row] ^ np.array([m for one in masks for m in one], dtype=np.int64)
        out = part.iloc[np.concatenate([np.arange(len(part)), row])]
        yield out.assign(dim=dim, cell=np.concatenate([home, cell]), home=np.arange(len(out)) < len(part))

    label_type = classes.schema["label"].dataType.simpleString()
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # as narrow as it came
    spread = classes.select("id", "n", "label", F.col("v").cast(kind).alias("v"))
    spread = spread.repartition(max(1, -(-classes.count() // 2000)), "id")
    schema = f"id long, n long, label {label_type}, v {kind}, dim int, cell long, home boolean"
    dealt = stored(spread.mapInPandas(deal, schema), "vector-cells")
    # Large cells: homes and probes are split into blocks, and each block meets each.
    cells = dealt.groupBy("label", "dim", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / BLOCK).cast("int").alias("homes"),
        F.ceil(F.sum((~F.col("home")).cast("int")) / BLOCK).cast("int").alias("others"),
    )
    own = lambda n: F.array(F.pmod(F.xxhash64("id"), n).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    blocks = dealt.join(cells.where("homes > 0 and others > 0"), ["label", "dim", "cell"])
    blocks = blocks.withColumn("hb", F.explode(F.when(F.col("home"), own(F.col("homes"))).otherwise(every(F.col("homes")))))
    blocks = blocks.withColumn("ob", F.explode(F.when(F.col("home"), every(F.col("others"))).otherwise(own(F.col("others")))))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        parts = group[group["home"]], group[~group["home"]]
        if not len(parts[0]) or not len(parts[1]):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        home, probe = (_Side(x, bits) for x in parts)
        r, c = links(home, probe, threshold, half)
        counts = [(probe.id, np.bincount(r, home.n[c], len(probe.id))), (home.id, np.bincount(c, probe.n[r], len(home.id)))]
        some = [(i[n > 0], n[n > 0]) for i, n in counts]
        a, b = forest(probe.id[r], home.id[c])
        ids = np.concatenate([i for i, _ in some])
        return pd.DataFrame(
            {
                "a": np.concatenate([ids, a]),
                "b": np.concatenate([ids, b]),
                "links": np.concatenate([*(n for _, n in some), np.zeros(len(a))]).astype(np.int64),
            }
        )

    narrow = blocks.select("label", "dim", "cell", "hb", "ob", "id", "n", "v", "home")
    found = narrow.groupBy("label", "dim", "cell", "hb", "ob").applyInPandas(compare, "a long, b long, links long")
    found = stored(found, "vector-links")
    comp = connected_components(found.where("a != b").select("a", "b"), "vectors")
    counted = found.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    named = classes.select("key", "id", "n", "least").join(counted, "id", "left")
    named = named.join(comp, F.col("id") == F.col("node"), "left").select(
        "key",
        "least",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("root"),
    )
    named = stored(named, "vector-named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("key", "n_links", "component_id")
    linked = rows.select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
