"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm.chat_format import chat_windows, conversation_digests
from greenledger.llm.decontaminate import contaminated
from greenledger.llm.embedding_dedup import embedding_near_dedup
from greenledger.llm.lm_scoring import score_documents
from greenledger.llm.packing import pack_documents
from greenledger.llm.sharding import shard_documents
from greenledger.llm.simhash_dedup import simhash_near_dedup
from greenledger.llm.source_audit import source_divergence
from greenledger.llm.toxicity import fit_from, fold, toxic_spans
from greenledger.llm.suffix_dedup import repeated_passages
from greenledger.llm.token_alignment import align_tokenizers
from greenledger.llm.token_files import read_token_files, write_token_files
from greenledger.llm.warc import archive_pages, page_records, read_warc

#: Folder of the public tokenizers on every executor; a name in it is resolved by :func:`tokenizer_path`.
TOKENIZERS = os.environ.get("LLM_TOKENIZERS", "")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.sparkContext.master.startswith("local["):
        # one machine: workers find the package wherever the driver was started; a cluster is given it (--py-files)
        spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).parents[2])
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine >= 0.98 between all embeddings of a label."""
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-dedup of all documents: 3-word shingles, 3 bits."""
    return simhash_near_dedup(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def tokenizer_path(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted and read back."""
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, said)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return conversation_digests(chat_windows(turns))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of all documents that are similar to a benchmark item: 5 words, 0.8 or more."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8)


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that stand more than once in all documents."""
    return repeated_passages(table(spark, sf_dir, "documents"), passage=50)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files with Elias-Fano boundaries, read back."""
    docs = table(spark, sf_dir, "documents")
    return read_token_files(write_token_files(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC archives, read back through the chunked record table."""
    archives = archive_pages(spark, table(spark, sf_dir, "pages"), min_bytes=0)
    return page_records(read_warc(archives, with_data=False))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=0, capacity=2048)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together."""
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; the model never sees the held-out fifth of the labels."""
    docs = table(spark, sf_dir, "documents")
    scored = toxic_spans(docs, fit_from(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "spans")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures of every (language, source) group of all documents, over terms of 30 documents and more."""
    return source_divergence(table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under a log-bilinear model; the model and the counts never see the held-out seventh."""
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return score_documents(table(spark, sf_dir, "documents"), training=remainder != 2)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two tokenizers, aligned by bytes."""
    docs = table(spark, sf_dir, "documents")
    return align_tokenizers(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))[0]


def queries() -> dict[str, Query]:
    return {
        "op1_embeddings": op1_embeddings,
        "op2_simhash": op2_simhash,
        "op3_chat_format": op3_chat_format,
        "op4_decontaminate": op4_decontaminate,
        "op5_suffix_array": op5_suffix_array,
        "op6_token_files": op6_token_files,
        "op7_warc": op7_warc,
        "op8_sharding": op8_sharding,
        "op9_packing": op9_packing,
        "op10_toxicity": op10_toxicity,
        "op11_source_audit": op11_source_audit,
        "op12_lm_scoring": op12_lm_scoring,
        "op13_token_alignment": op13_token_alignment,
    }


#: Cosine in double precision over equal labels, and the vectors reachable over the links.
EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), n AS (SELECT a, count(*) AS n FROM link GROUP BY a), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, COALESCE(n.n, 0) AS n_links, COALESCE(LEAST(vec_id, low.b), vec_id) AS component_id,
  vec_id = COALESCE(LEAST(vec_id, low.b), vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id
"""

#: Base32 of SHA-1: five hex digits are four base32 digits.
WARC_SQL = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS h,
    min(page_id) OVER (PARTITION BY COALESCE(html, '')) AS first FROM pages
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""


#: Every group x kept term, without cells; HUGEINT keeps the arithmetic exact.
AUDIT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), n AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), l AS (SELECT lang, sum(c) AS n, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, COALESCE(sum(c), 0) AS n FROM g LEFT JOIN n USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, COALESCE(n.c, 0) AS c,
    1 + (1000000000 * (COALESCE(n.c, 0) + 5)) // (t.n + 5 * l.v) AS p,
    1 + (1000000000 * (kept.c + 5)) // (l.n + 5 * l.v) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang) JOIN t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (FROM pair UNION ALL FROM term) QUALIFY part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_embeddings": EMBEDDINGS_SQL, "op7_warc": WARC_SQL, "op11_source_audit": AUDIT_SQL}
