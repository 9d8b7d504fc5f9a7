"""Corpus pipeline: documents in, token ids of the mixed, cleaned corpus out.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns what
it keeps.  All but the last return the columns of ``docs``.  The stages work on whole tables
and handle nulls, empty texts, ties, repeated rows and empty tables as the operators that
they call say; a stage's side table (``labels``) is read from ``sf_dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import kn_quality, mix_sources, pii_boost, sentencepiece_codec, simhash_pivots
from tessera.llm.common import read
from tessera.session import apply_defaults, checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity the quality classifier accepts."""
    return kn_quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that of the smallest id."""
    return simhash_pivots.keep_one(docs, shingle=3, max_bits=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind; ``n_chars`` follows."""
    return pii_boost.redact(docs, chars="n_chars" if "n_chars" in docs.columns else None)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mix_sources.repeat(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and digests of ids and decoded text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model), model)
    return coded.withColumns({"ids_sha256": F.sha2("ids", 256),
                              "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256)}).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", tokens),
]

#: SQL cannot express the language model, the fingerprints or the merges; the tests hold the
#: pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet to a folder of this run, in the
    shared folder of ``spark.checkpoint.dir``, and read from there by the next."""
    apply_defaults(spark)
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.schema(docs.schema).parquet(f"{folder}/{k}")
    return docs
