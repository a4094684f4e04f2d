"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import (
    bpe,
    jaccard,
    languages,
    licenses,
    line_dedup,
    line_quality,
    mixing,
    neighbours,
    prefix_trie,
    repair,
    repeats,
    token_counts,
    wrappers,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BYTE_BPE = "byte_bpe_50k.json"
MIX_POWER = 0.7  # sources weigh as their bytes to this power


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op8_bpe_segment_tree(spark, sf_dir):
    return bpe.encoding_digests(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query
def op10_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query
def op1_chosen_path_join(spark, sf_dir):
    return jaccard.jaccard_join(read(spark, sf_dir, "documents"))


@query
def op2_wrapper_induction(spark, sf_dir):
    return wrappers.extract_main_text(read(spark, sf_dir, "pages"))


@query
def op3_previous_factors(spark, sf_dir):
    return repeats.repeat_digests(read(spark, sf_dir, "documents"), with_text=True)


@query
def op4_posting_lists(spark, sf_dir):
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


@query
def op5_line_frequency(spark, sf_dir):
    return line_quality.line_quality(read(spark, sf_dir, "documents")).drop("left_chars")


@query
def op6_license_diagonals(spark, sf_dir):
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


@query
def op7_language_fusion(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return languages.identify_languages(docs).select("doc_id", "language", "confidence", "rejected")


@query
def op9_poisson_mix(spark, sf_dir):
    return mixing.poisson_mix(read(spark, sf_dir, "documents"), power=MIX_POWER)


@query
def op11_auction_repair(spark, sf_dir):
    found = repair.repair_figures(repair.damaged(read(spark, sf_dir, "conversations")))
    return found.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


@query
def op12_prefix_ranges(spark, sf_dir):
    convs = prefix_trie.with_shared_heads(prefix_trie.paths(read(spark, sf_dir, "conversations")))
    ends = F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return prefix_trie.prefix_nodes(convs).select("*", ends).drop("ends")


@query
def op13_line_dedup(spark, sf_dir):
    found = line_dedup.without_repeated_lines(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
