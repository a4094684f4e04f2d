"""Taxonomy and keyword vocabulary as small DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNCLASSIFIED_KEY = "unclassified"
UNCLASSIFIED = "Unclassified"


class VocabularyError(ValueError):
    pass


def _flatten(spark: SparkSession, nested: Mapping[str, Sequence[str]], outer: str, inner: str) -> DataFrame:
    begins = accumulate((len(values) for values in nested.values()), initial=0)
    lists = [(begin, key, list(values)) for begin, (key, values) in zip(begins, nested.items(), strict=False)]
    table = spark.createDataFrame(lists, f"begin bigint, {outer} string, items array<string>")
    return table.select("begin", outer, F.posexplode("items").alias("at", inner)).select(
        outer, inner, (F.col("begin") + F.col("at")).alias("pos")
    )


def taxonomy_frame(spark: SparkSession, nested: Mapping[str, Sequence[str]]) -> DataFrame:
    """{category: [subcategory]} as (category, subcategory, pos)."""
    return _flatten(spark, nested, "category", "subcategory")


def training_frame(spark: SparkSession, nested: Mapping[str, Sequence[str]]) -> DataFrame:
    """{subcategory: [keyword]} as (subcategory, keyword, pos)."""
    return _flatten(spark, nested, "subcategory", "keyword")


def keyword_labels(taxonomy: DataFrame, training: DataFrame) -> DataFrame:
    """(keyword, subcategory, category, pos), one row per keyword.

    A keyword or subcategory listed twice takes the label listed last and keeps
    the position it was first listed at. Empty keywords never match and are left out.
    """
    parents = taxonomy.groupBy("subcategory").agg(F.max_by("category", "pos").alias("category"))
    keywords = (
        training.filter(F.col("keyword") != "")
        .groupBy("keyword")
        .agg(F.max_by("subcategory", "pos").alias("subcategory"), F.min("pos").alias("pos"))
    )
    return keywords.join(parents, "subcategory", "left").select("keyword", "subcategory", "category", "pos")


def unknown_subcategories(taxonomy: DataFrame, training: DataFrame) -> DataFrame:
    """Trained subcategories the taxonomy does not list."""
    return training.select("subcategory").distinct().join(taxonomy, "subcategory", "left_anti")


def repeated_keywords(training: DataFrame) -> DataFrame:
    """Keywords trained for several subcategories, with the one that applies."""
    return (
        training.groupBy("keyword")
        .agg(
            F.count_distinct("subcategory").alias("subcategories"),
            F.max_by("subcategory", "pos").alias("applied"),
        )
        .filter("subcategories > 1")
    )


def examples(names: DataFrame, total: int, shown: int = 20) -> str:
    """The first of `total` names in order, and how many more there are."""
    first = [r[0] for r in names.orderBy(names.columns[0]).limit(shown).collect()]
    return f"{first}" + (f" and {total - shown} more" if total > shown else "")


def require_known_subcategories(taxonomy: DataFrame, training: DataFrame) -> None:
    unknown = unknown_subcategories(taxonomy, training)
    total = unknown.count()
    if total:
        raise VocabularyError(f"subcategories missing from the taxonomy: {examples(unknown, total)}")


def name_candidates(spark: SparkSession, aliases: Sequence[str], labels: DataFrame) -> DataFrame:
    """(keyword, pos): the aliases, then the trained keywords."""
    listed = [(alias, at - len(aliases)) for at, alias in enumerate(aliases)]
    known = spark.createDataFrame(listed, "keyword string, pos bigint")
    both = known.unionByName(labels.select("keyword", "pos"))
    return both.groupBy("keyword").agg(F.min("pos").alias("pos"))
