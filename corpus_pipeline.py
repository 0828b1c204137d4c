"""The corpus pipeline: five stages over ``documents``, each one operator of ``lakeops.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's documents. All but the last return the
columns of ``documents``. Every stage works on all its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import bpe, exact_dedup, langid, mixing, simhash
from lakeops.llm.common import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CACHED_WORDS = 80_000  # the workers of the last stage have the memory of the others' behind them


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the table has, null languages filled in; null texts, texts without a letter and noise go."""
    return langid.in_known_language(docs, F.lit(True))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id."""
    return simhash.without_near_copies(docs, shingle_words=4, radius=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document of the mix."""
    return bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, cached=CACHED_WORDS)


STAGES = [
    ("language", known_language),
    ("exact_dedup", no_copies),
    ("near_dedup", no_near_copies),
    ("mix", source_mix),
    ("tokens", token_digests),
]

# Mixtures of languages, fingerprints and merges have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
