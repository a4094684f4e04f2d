"""Canonical names and categories of rows, scored once per distinct text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.text import clean_name, strip_diacritics
from ledgermill.operators.matching import (
    CUTOFF,
    best_keywords,
    best_names,
    counted_texts,
    text_key,
    token_set_join,
    tokenise,
)
from ledgermill.operators.vocabulary import UNCLASSIFIED, UNCLASSIFIED_KEY
from ledgermill.scale import attach, fits_broadcast, small_copy, stage


def canonical_name(raw: Column, keyword: Column) -> Column:
    """The matched keyword without diacritics, else the cleaned text."""
    return F.coalesce(strip_diacritics(keyword), clean_name(raw))


def add_canonical(
    rows: DataFrame,
    column: str,
    candidates: DataFrame,
    output: str,
    spread: Sequence[str] = (),
    cutoff: int = CUTOFF,
) -> DataFrame:
    """Adds the canonical name of `column`, empty for NULL and empty texts."""
    texts = stage(counted_texts(rows, [column]), "texts")
    names = best_names(tokenise(texts), candidates, cutoff)
    hits = stage(_named(texts, names).select("text_id", "canonical"), "names")
    named = attach_hits(rows, column, hits, "_name", spread, counts=texts)
    return named.withColumn(output, F.coalesce("_name.canonical", F.lit(""))).drop("_name")


def _named(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(text_id, canonical): every distinct text with its name, cleaned here once."""
    found = texts.join(names.select("text_id", "keyword"), "text_id", "left")
    return found.select("text_id", canonical_name(F.col("text"), F.col("keyword")).alias("canonical"))


def attach_hits(
    rows: DataFrame,
    column: str,
    hits: DataFrame,
    output: str,
    spread: Sequence[str] = (),
    fits: bool | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Adds the struct `output` of what `hits` has for the text in `column`; `fits` tells
    whether `hits` may be broadcast and `counts` (text_id, n) how many rows have each text,
    if that was measured before. Empty texts have no hits, like NULL."""
    found = hits.select(F.col("text_id").alias("_text_id"), F.struct(*hits.drop("text_id").columns).alias(output))
    keyed = rows.withColumn("_text_id", text_key(F.nullif(F.col(column), F.lit(""))))
    counts = None if counts is None else counts.select(F.col("text_id").alias("_text_id"), "n")
    return attach(keyed, found, ["_text_id"], spread=spread, fits=fits, counts=counts).drop("_text_id")


def better_of(first: str, second: str) -> Column:
    """The struct with the higher `score`; the first on ties."""
    second_wins = F.col(f"{second}.score") > F.coalesce(F.col(f"{first}.score"), F.lit(-1.0))
    return F.when(second_wins, F.col(second)).otherwise(F.col(first))


def _categories(rows: DataFrame, chosen: Column) -> DataFrame:
    return rows.withColumns(
        {
            "category": F.coalesce(chosen["category"], F.lit(UNCLASSIFIED)),
            "subcategory": F.coalesce(chosen["subcategory"], F.lit(UNCLASSIFIED)),
        }
    )


def _labelled(best: DataFrame, labels: DataFrame) -> DataFrame:
    """(text_id, score, category, subcategory) of the best keyword per text."""
    return attach(best, labels.select("keyword", "category", "subcategory"), ["keyword"], "inner").drop("keyword")


def add_category(
    rows: DataFrame,
    first: str,
    second: str,
    labels: DataFrame,
    spread: Sequence[str] = (),
    cutoff: int = CUTOFF,
) -> DataFrame:
    """Adds category and subcategory from whichever of two text columns scores
    higher, the first one on ties; rows without a match are Unclassified."""
    texts = stage(counted_texts(rows, [first, second]), "texts")
    tokens = tokenise(texts)
    hits = stage(_labelled(best_keywords(tokens, labels, cutoff), labels), "categories")
    fits = fits_broadcast(hits)
    out = attach_hits(rows, first, hits, "_first", spread, fits, texts)
    out = attach_hits(out, second, hits, "_second", spread, fits, texts)
    return _categories(out, better_of("_first", "_second")).drop("_first", "_second")


def add_canonical_and_category(
    rows: DataFrame,
    party: str,
    description: str,
    candidates: DataFrame,
    labels: DataFrame,
    output: str,
    spread: Sequence[str] = (),
    cutoff: int = CUTOFF,
) -> DataFrame:
    """`add_canonical` of `party` and `add_category` of both columns in one pass:
    texts are split once and compared once, as the name candidates include every keyword."""
    texts = stage(counted_texts(rows, [party, description]), "texts")
    tokens = tokenise(texts)
    labels = small_copy(labels)
    whole = stage(token_set_join(tokens, candidates, cutoff), "whole-text-scores")
    names = best_names(tokens, candidates, cutoff, whole)
    of_keywords = attach(whole.drop("pos"), labels.select("keyword", "pos"), ["keyword"], "inner")
    best = _labelled(best_keywords(tokens, labels, cutoff, of_keywords), labels)
    hits = stage(_named(texts, names).join(best, "text_id", "left"), "text-hits")
    fits = fits_broadcast(hits)
    out = attach_hits(rows, party, hits, "_party", spread, fits, texts)
    out = attach_hits(out, description, hits, "_description", spread, fits, texts)
    out = _categories(out, better_of("_party", "_description"))
    return out.withColumn(output, F.coalesce("_party.canonical", F.lit(""))).drop("_party", "_description")


def category_map(rows: DataFrame, dim_category: DataFrame, key: str = "transaction_sk") -> DataFrame:
    """(`key`, category_sk) of expense rows that carry category and subcategory."""
    spending = rows.filter("include_in_expense").select(key, "category", "subcategory")
    return attach(
        spending, dim_category.select("category", "subcategory", "category_sk"), ["category", "subcategory"]
    ).select(key, "category_sk")


def unclassified_rate(facts: DataFrame) -> DataFrame:
    """One row: facts, unclassified facts and their share."""
    open_facts = F.count_if(F.col("category_sk") == UNCLASSIFIED_KEY)
    total = F.count(F.lit(1))
    return facts.agg(
        total.alias("facts"),
        open_facts.alias("unclassified"),
        F.when(total == 0, F.lit(0.0)).otherwise(open_facts / total).alias("rate"),
    )
