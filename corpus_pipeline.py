"""From raw documents to encoded training data in five stages.

Each stage reads what its predecessor wrote. The first four return the columns of
`documents`: unknown languages go, one document of each group of near copies
stays, long repeated strings go but for their first place, and sources are
repeated to their target weights in random order. The last one encodes every
text and decodes it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import bpe, jaccard, languages, mixing, repeats
from ledgermill.scale import stage

MIX_POWER = 0.7
# Passages that documents share are meant from about 50 words on. In these languages 50 words take 309 bytes,
# 99 % of all runs of 50 words at least 248.
REPEAT_BYTES = 240
REPEAT_GRAM = 36  # bytes by whose hash stretches of text are anchored; fewer bytes, longer stretches
VOCABULARY = "byte_bpe_50k.json"


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return languages.kept_languages(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.first_of_classes(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(docs, size="n_chars", keep_first=True, length=REPEAT_BYTES, gram=REPEAT_GRAM)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(docs, power=MIX_POWER).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", known_languages),
    ("jaccard_join", one_of_near_copies),
    ("suffix_dedup", without_repeats),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]

# The joins by sampled paths and the merges of a vocabulary have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
