"""A training corpus from raw documents: toxicity, near copies, repeated passages, benchmark leaks, packing.

Each stage works on all documents that its predecessor kept. A document is told by its id and the hash
of its text, so rows without an id, or of one id with different texts, are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm.common import broadcast_if_small, stored
from greenledger.llm.decontaminate import contaminated
from greenledger.llm.packing import pack_documents
from greenledger.llm.queries import table, tokenizer_path
from greenledger.llm.simhash_dedup import simhash_near_dedup
from greenledger.llm.suffix_dedup import remove_passages, repeated_passages
from greenledger.llm.toxicity import drop_toxic, fit_from

#: Keys up to which a list of documents is broadcast; beyond, the join shuffles.
SMALL = 500_000


def _key(docs: DataFrame) -> Column:
    return F.struct(docs["doc_id"].alias("id"), F.xxhash64(docs["text"]).alias("text"))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``keys(key)``."""
    listed = broadcast_if_small(stored(keys.select("key.*").toDF("_gl_id", "_gl_text").distinct(), "left-out"), SMALL)
    same = docs["doc_id"].eqNullSafe(F.col("_gl_id")) & (F.xxhash64(docs["text"]) == F.col("_gl_text"))
    return docs.join(listed, same, "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field, fitted on the labelled ones among them, does not call toxic."""
    return drop_toxic(docs, fit_from(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: 3-word shingles, 3 bits."""
    keyed = docs.select(_key(docs).alias("key"), "text")
    found = stored(simhash_near_dedup(keyed, "key", "text", shingle=3, radius=3).select("doc_id", "kept"), "kept")
    left = _without(docs, found.where(~F.col("kept")).select(F.col("doc_id").alias("key")))
    again = found.where("kept").groupBy("doc_id").count().where("count > 1")
    if again.limit(1).count():  # rows that are there twice, id and text
        left = left.withColumn("_gl_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_gl_text"]).drop("_gl_text")
    return left


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words and more that stand earlier; those with nothing left go."""
    return remove_passages(docs, stored(repeated_passages(docs, passage=50), "passages"), length_col="n_chars")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is similar to a benchmark item."""
    keyed = docs.select(_key(docs).alias("key"), "text")
    leaks = contaminated(keyed, table(spark, sf_dir, "benchmark"), threshold=0.8, id_col="key")
    return _without(docs, leaks.select(F.col("doc_id").alias("key")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 tokens, with their ids."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=0, capacity=2048, keep_ids=True, forget=True)


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("passages", passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packing),
]

#: The stages' models, fingerprints and tokenizers are beyond SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
