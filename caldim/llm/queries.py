"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.llm import (
    archives,
    decontaminate,
    embeddings,
    licenses,
    line_dedup,
    packing,
    prefix_trie,
    quality,
    repair,
    secrets,
    simhash,
    substring_dedup,
    suffix_dedup,
)
from caldim.llm.common import read


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 50-byte string of an earlier one covers."""
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"), length=50)


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.93 within a label."""
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"), limit=0.93)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents as files of a tree: directories of a source
    hold blocks of 64 ids, and those folders of 8; the first document of a
    block or folder is its LICENSE file."""
    docs = read(spark, sf_dir, "documents")
    block, folder = F.expr("doc_id div 64"), F.expr("pmod(doc_id, 64) div 8")
    top = F.concat_ws("/", "source", F.concat(F.lit("block"), block.cast("string")))
    inner = F.concat_ws("/", top, F.concat(F.lit("part"), folder.cast("string")))
    path = (
        F.when(F.expr("pmod(doc_id, 64) = 0"), F.concat(top, F.lit("/LICENSE")))
        .when(F.expr("pmod(doc_id, 8) = 0"), F.concat(inner, F.lit("/LICENSE")))
        .otherwise(F.concat(inner, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")))
    )
    files = docs.select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    return licenses.scan(files).withColumnRenamed("id", "doc_id")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces placed in sequences of at most 4096 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, and the weak candidates that they complete."""
    return secrets.scan(read(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, links at two or fewer bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a ten-word window of a benchmark item."""
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), size=10)


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC files of both versions to WARC files, read back."""
    return archives.round_trip(read(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those cut as boilerplate, and a digest of the rest."""
    cut = line_dedup.remove_boilerplate(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a 13-word window of an earlier one covers,
    and the longest window that it shares."""
    return substring_dedup.dedup(read(spark, sf_dir, "documents"), length=13)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the set damage."""
    conversations = read(spark, sf_dir, "conversations")
    return repair.audit_of(conversations, repair.damaged(conversations))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_embedding_near_dedup,
        op3_quality_classifier,
        op4_license_scan,
        op5_best_fit_packing,
        op6_secret_scan,
        op7_simhash_near_dedup,
        op8_decontamination,
        op9_arc_to_warc,
        op10_line_dedup,
        op11_prefix_trie,
        op12_substring_dedup,
        op13_conversation_repair,
    )
}

_FILES = """
    SELECT doc_id AS id, text, source || '/block' || (doc_id // 64) || CASE WHEN doc_id % 64 = 0 THEN '/LICENSE'
      WHEN doc_id % 8 = 0 THEN '/part' || (doc_id % 64 // 8) || '/LICENSE'
      ELSE '/part' || (doc_id % 64 // 8) || '/' || doc_id || '.txt' END AS path
    FROM documents"""

ORACLE: dict[str, str] = {
    "op2_embedding_near_dedup": embeddings.oracle_sql(),
    "op4_license_scan": licenses.oracle_sql(_FILES),
    "op6_secret_scan": secrets.oracle_sql(),
    "op8_decontamination": decontaminate.oracle_sql(),
    "op9_arc_to_warc": archives.ORACLE_SQL,
    "op10_line_dedup": line_dedup.oracle_sql(),
    "op11_prefix_trie": prefix_trie.oracle_sql(),
    "op12_substring_dedup": substring_dedup.oracle_sql(),
    "op13_conversation_repair": repair.oracle_sql(),
}
