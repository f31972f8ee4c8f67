"""The registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import balltree, bpe, chat, divergence, jaccard, langid, mixing, neighbours, packing, parsing, suffixes, surrogates, tokencount
from starloom.llm.common import table

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return neighbours.near_dedup(table(spark, sf_dir, "embeddings"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document text with surrogates for personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymise_checked(docs, surrogates.EXAMPLE_KEY).withColumn("n_entities", F.size("entities").cast("long"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token count of every whole document text. The costs are Zipf's
    law of a token's rank in the vocabulary: a stand-in, not a model fitted to
    a corpus (the vocabularies at hand have no unigram probabilities)."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and link count of every document."""
    return jaccard.join(table(spark, sf_dir, "documents")).drop("text_hash")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 100-byte strings that start earlier."""
    return suffixes.digests(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited text and the next document."""
    return parsing.beside_next(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken into the mix."""
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return chat.render(table(spark, sf_dir, "conversations"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole document text."""
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document text."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie from each other, and the
    terms that set each apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return balltree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training windows."""
    return packing.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_embedding_neardup, op2_pii_surrogates, op3_token_counts, op4_ngram_jaccard, op5_suffix_dedup, op6_fingerprints, op7_mixing, op8_chat, op9_byte_bpe, op10_language_id, op11_source_divergence, op12_ranked_search, op13_packing)}
