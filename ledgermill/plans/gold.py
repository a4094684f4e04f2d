"""Star schema from silver rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.keys import date_key, name_key
from ledgermill.operators.dimensions import (
    category_dimension,
    date_dimension,
    method_dimension,
    party_dimension,
    require_unique_keys,
)
from ledgermill.operators.facts import expense_fact, income_fact, resolve_key
from ledgermill.operators.naming import add_canonical_and_category
from ledgermill.operators.vocabulary import (
    keyword_labels,
    name_candidates,
    require_known_subcategories,
    taxonomy_frame,
    training_frame,
)
from ledgermill.scale import small_copy, stage


# What `enrich` and the checks read of silver rows, and facts and dimensions of the enriched ones.
GOLD_INPUT = [
    "transaction_sk", "transaction_date", "counterparty_details", "description", "transaction_amount", "transaction_currency",
    "payment_method", "event_type", "include_in_expense", "_line_block", "_line_seq",
]
ENRICHED = [
    "transaction_sk", "transaction_date", "transaction_amount", "transaction_currency", "payment_method", "event_type",
    "include_in_expense", "counterparty_canonical", "date_sk", "counterparty_sk", "category_sk", "payment_method_sk",
]


def enrich(
    silver: DataFrame,
    taxonomy: DataFrame,
    training: DataFrame,
    aliases: Sequence[str] = (),
    spread: Sequence[str] = ("_line_block", "_line_seq"),
) -> DataFrame:
    """Silver rows with canonical name, category and all surrogate keys.

    The category is a column rather than a map joined on the transaction key, so
    repeated transactions are not multiplied. The party key is the function of
    the canonical name that the dimension itself uses, so no join is needed.
    """
    spark = silver.sparkSession
    spread = [c for c in spread if c in silver.columns] or ["transaction_sk"]
    labels = small_copy(keyword_labels(taxonomy, training))
    rows = add_canonical_and_category(
        silver,
        "counterparty_details",
        "description",
        name_candidates(spark, aliases, labels),
        labels,
        "counterparty_canonical",
        spread,
    )
    rows = resolve_key(rows, small_copy(category_dimension(taxonomy)), ["category", "subcategory"], "category_sk")
    rows = rows.join(
        F.broadcast(method_dimension(spark).select("payment_method", "payment_method_sk")), "payment_method", "left"
    )  # seven rows
    return rows.withColumns(
        {
            "date_sk": date_key(F.col("transaction_date")),
            "counterparty_sk": name_key(F.col("counterparty_canonical")),
        }
    )


def build_gold(
    silver: DataFrame,
    categories: Mapping[str, Sequence[str]],
    training: Mapping[str, Sequence[str]],
    aliases: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The two facts and four dimensions by name."""
    spark = silver.sparkSession
    taxonomy, trained = taxonomy_frame(spark, categories), training_frame(spark, training)
    require_known_subcategories(taxonomy, trained)
    dim_category = category_dimension(taxonomy)
    require_unique_keys(dim_category, "category_sk")
    rows = stage(enrich(silver, taxonomy, trained, aliases).select(*ENRICHED), "enriched")
    return {
        "fact_expenses": expense_fact(rows),
        "fact_income": income_fact(rows),
        "dim_category": dim_category,
        "dim_date": date_dimension(rows, "transaction_date"),
        "dim_counterparty": party_dimension(rows, "counterparty_canonical"),
        "dim_payment_method": method_dimension(spark),
    }
