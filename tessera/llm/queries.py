"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (best_fit, collocations, host_rules, html_consensus, kn_quality, license_digests, mix_sources, pii_boost,
               prefix_trie, sentencepiece_codec, simhash_pivots, topk_nra, toxicity_bags)
from .common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return sentencepiece_codec.digests(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                       public_tokenizers.path("piece_bpe_32k.model"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every 50th vector."""
    return topk_nra.search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii_boost.detect(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of every document and the verdict with its host's."""
    return host_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix_sources.mix(read(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    return kn_quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_consensus.main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_pivots.near_duplicates(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity_bags.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digest, licence and quoted notices of every document."""
    return license_digests.scan(read(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(prefix_trie.rebuilt(read(spark, sf_dir, "conversations"))).drop(*prefix_trie.KEY)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return best_fit.digests(best_fit.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_sentencepiece, op2_topk_search, op3_pii, op4_quality_rules, op5_mix_sources,
        op6_quality_classifier, op7_html_text, op8_simhash, op9_toxicity, op10_license_scan,
        op11_prefix_trie, op12_best_fit, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": host_rules.oracle_sql(), "op5_mix_sources": mix_sources.oracle_sql(),
            "op10_license_scan": license_digests.oracle_sql(), "op11_prefix_trie": prefix_trie.oracle_sql(),
            "op13_collocations": collocations.oracle_sql()}
