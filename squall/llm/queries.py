"""The registered ``opN_<name>`` queries: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm import (
    bbit_minhash,
    binpack,
    license_digests,
    line_spread,
    merkle_manifest,
    pfair,
    prefix_trie,
    quality_lines,
    quality_rank,
    suffix_index,
    taat_topk,
    token_files,
    toxicity_crf,
)
from squall.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-frequency verdict of every document."""
    return quality_lines.line_frequency_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "n_line_words", "n_kept_line_words", "n_frequent_lines")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed as cross-site boilerplate, per document."""
    return line_spread.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed_lines", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed as 50-byte repeats of earlier documents."""
    return suffix_index.suffix_dedup(table(spark, sf_dir, "documents"), columns=["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every 50th embedding."""
    return taat_topk.embedding_top_k(table(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document piece in a sequence."""
    return binpack.best_fit_pack(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair.mix_sources(docs)


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document (four-word shingles)."""
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written to files and read back through their index."""
    return token_files.write_and_read_back(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity_crf.score_documents(docs, toxicity_crf.fit(docs, labels), columns=["doc_id"]).select(
        "doc_id", toxicity_crf.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_spans")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences found in every document."""
    return license_digests.license_scan(table(spark, sf_dir, "documents"))


def op11_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rank.score_documents(docs, quality_rank.fit(docs, labels), columns=["doc_id"]).select(
        "doc_id", quality_rank.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and check of every document."""
    return merkle_manifest.merkle_manifest(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_line_dedup, op3_suffix_dedup, op4_exact_topk, op5_best_fit_packing,
        op6_source_mixing, op7_minhash_dedup, op8_token_files, op9_toxicity, op10_license_scan,
        op11_quality_ranking, op12_merkle_manifest, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    """Operators that SQL can express; the others are tested by brute force."""
    return {"op1_quality_rules": quality_lines.SQL, "op2_line_dedup": line_spread.SQL,
            "op4_exact_topk": taat_topk.SQL, "op10_license_scan": license_digests.sql(),
            "op12_merkle_manifest": merkle_manifest.SQL, "op13_prefix_trie": prefix_trie.SQL}
