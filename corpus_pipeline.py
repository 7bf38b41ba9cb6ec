"""A corpus pipeline of five stages over ``documents``: quality rules, exact dedup, SimHash near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last
return the columns of ``documents``; the last returns a row for each document of the mixture: doc_id, n_tokens,
ids_sha256, decoded_sha256.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import exact_dedup, mixing, piece_codec, quality, simhash
from ledgerline.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts up to white space one stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: shingles of three words, links of at most three bits."""
    return simhash.keep_smallest(docs, words=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's repetition rate says."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document of the mixture, as digests."""
    return piece_codec.encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL can't express the divergence from mined references, the fingerprints or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
