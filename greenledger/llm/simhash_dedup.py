"""SimHash near-deduplication by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits share a fingerprint that lies half-way between them. Every
distinct fingerprint emits the variants within half the radius, variants are dealt to buckets and
equal variants link the fingerprints that emitted them.

For an odd radius 2h+1 the halves are h and h+1. Fingerprints at the odd distance 2h+1 differ in the
parity of their bits, so only those with an odd number of ones need the variants at h+1; and of 2h+1
differing bits h+1 lie in the same 32-bit half, so those h+1 flips stay within one half. No pair is
lost by either rule.

Members of one variant are never paired off: two that flipped at most h bits are within the radius,
and so is such a one with one that flipped h+1, so all of them are linked to the smallest member
that flipped at most h (two that flipped h+1 may be further apart and are left to their other
variants). As fingerprints are distinct, a variant has at most as many members as a ball has points,
however hot a fingerprint is: buckets are even by construction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import connected_components, give_back, giving_back, stored

#: Variants that one bucket holds, about; 10 bytes each.
BUCKET_VARIANTS = 1_000_000
#: Fingerprints whose variants are made at a time.
CHUNK = 2048
SEED = 42
_MIX = np.uint64(0x9E3779B97F4A7C15)


def simhash(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole text: XXH64 (seed 42) of its ``shingle``-word shingles, repeats included.

    A-Z is lower-cased and words are runs of bytes other than space and x09-x0D. A text with fewer
    words is one shingle; null, empty and blank texts give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    spans = zip((end - size).tolist(), end[shingle - 1 :].tolist(), strict=False)
    hashes = np.array([digest(joined[x:y], SEED) for x, y in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` per row; fp is the fingerprint's 64 bits as a signed long."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(x.as_py(), shingle) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        giving_back(score), f"doc_id {kind}, fp long"
    )


def flips(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """XOR masks: those of every fingerprint, and the further ones of odd fingerprints."""
    h = radius // 2
    near = [sum(1 << i for i in c) for n in range(h + 1) for c in combinations(range(64), n)]
    far = []
    if radius % 2:
        halves = (range(32), range(32, 64))
        far = [sum(1 << i for i in c) for half in halves for c in combinations(half, h + 1)]
    return np.array(near, dtype=np.uint64), np.array(far, dtype=np.uint64)


def link_fingerprints(distinct: DataFrame, radius: int) -> DataFrame:
    """Links ``(a, b)`` whose connected components are those of all pairs of ``fp`` within ``radius`` bits.

    ``distinct(fp)`` must be stored and free of repeats.
    """
    near, far = flips(radius)
    masks = np.concatenate([near, far])
    n_near = len(near)
    buckets = max(1, -(-distinct.count() * (n_near + len(far) // 2) // BUCKET_VARIANTS))

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            every = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for at in range(0, len(every), CHUNK):
                fps = every[at : at + CHUNK]
                odd = fps[np.bitwise_count(fps) % 2 == 1] if len(far) else fps[:0]
                variant = np.concatenate([(fps[:, None] ^ near).ravel(), (odd[:, None] ^ far).ravel()])
                numbers = np.arange(len(masks), dtype="<u2")
                which = np.concatenate([np.tile(numbers[:n_near], len(fps)), np.tile(numbers[n_near:], len(odd))])
                bucket = variant * _MIX
                bucket >>= np.uint64(32)
                bucket %= np.uint64(buckets)
                bucket = bucket.astype(np.uint32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))]).tolist()
                variant, which = variant[order], which[order]
                del bucket, order
                rows = [
                    (i, variant[x:y].tobytes(), which[x:y].tobytes())
                    for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                    if y > x
                ]
                yield pd.DataFrame(rows, columns=["bucket", "variant", "which"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        found = shared_variants(group)
        give_back()  # a worker keeps nothing of a bucket
        return found

    def shared_variants(group: pd.DataFrame) -> pd.DataFrame:
        variant = np.frombuffer(b"".join(group["variant"]), dtype="<u8")
        which = np.frombuffer(b"".join(group["which"]), dtype="<u2")
        order = np.argsort(variant)
        variant, which = variant[order], which[order]
        del order
        same = np.concatenate([[False], variant[1:] == variant[:-1], [False]])
        shared = same[1:] | same[:-1]  # equal to the one before or the one after
        number = np.cumsum(~same[:-1][shared]) - 1
        variant, which = variant[shared], which[shared]
        if not len(variant):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        fp = variant ^ masks[which]
        is_near = which < n_near
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        top = np.uint64(2**64 - 1)
        hub = np.minimum.reduceat(np.where(is_near, fp, top), starts)
        has_hub = np.logical_or.reduceat(is_near, starts)
        size = np.diff(np.r_[starts, len(fp)])
        to = np.repeat(hub, size)
        keep = np.repeat(has_hub, size) & (fp != to)
        fp, to = fp[keep], to[keep]
        keep = np.bitwise_count(fp ^ to) <= radius
        pairs = np.unique(np.stack([fp[keep], to[keep]], axis=1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})

    spread = distinct.repartition(buckets, "fp")
    dealt = spread.mapInPandas(giving_back(emit), "bucket int, variant binary, which binary")
    return dealt.groupBy("bucket").applyInPandas(meet, "a long, b long")


def simhash_near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """``(doc_id, fingerprint, component_id, kept)``, one row per row of ``docs``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is
    the smallest id reachable and ``kept`` marks it. Null, empty and blank texts have fingerprint 0
    and are linked with each other like any other equal fingerprints. Repeated rows keep a row each.
    A null id belongs to its component but never names it (a component of null ids only has
    component_id null and keeps its rows). Other columns of ``docs`` are ignored.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    links = link_fingerprints(distinct.select("fp"), radius)
    comp = connected_components(links, "simhash")
    rooted = distinct.join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    rooted = stored(rooted, "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
