"""Ordered rule classification: the first rule whose condition holds wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]

# Payment methods and their reporting group.
PAYMENT_METHODS = {
    "card": "consumer",
    "blik": "consumer",
    "transfer": "consumer",
    "sepa_transfer": "wire",
    "currency_exchange": "wire",
    "pending": "pending",
    "other": "other",
}

# Event types that are not spending.
EXCLUDED_EVENTS = [
    "fx_swap",
    "internal_transfer",
    "credit_card_repayment",
    "loan_repayment",
    "pending_block",
    "investment_outflow",
    "income_salary",
    "income_interest",
    "income_consulting",
    "income_sale",
    "expense_reimbursement",
    "transfer_family",
    "unclassified",
]

# Income event types and the source each one reports.
INCOME_SOURCES = {
    "income_salary": "salary",
    "income_consulting": "consulting",
    "income_sale": "sale",
}


PENDING = "pending"


def income_source(event_type: Column) -> Column:
    """The source an income event reports; NULL for every other event."""
    sources = F.lit(None).cast("string")
    for event, source in INCOME_SOURCES.items():
        sources = F.when(event_type == event, F.lit(source)).otherwise(sources)
    return sources


def classify(rules: Sequence[Rule], otherwise: str) -> Column:
    """Label of the first matching rule. A NULL condition does not match."""
    (label, condition), *rest = rules
    chain = F.when(condition, F.lit(label))
    for label, condition in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def payment_method(details: Column) -> Column:
    """Method of a lowercased detail text. Labels, texts and their order."""
    return classify(
        [
            ("currency_exchange", details.like("%kantor%") | details.like("przelew kurs%")),
            ("card", details.like("tr.kart%")),
            ("blik", details.like("%blik%")),
            ("sepa_transfer", details.like("przelew sepa%")),
            ("transfer", details.like("przelew%")),
            ("pending", F.coalesce(details, F.lit("")) == ""),
        ],
        otherwise="other",
    )


def event_type(
    method: Column, party: Column, description: Column, account: Column, patterns: Mapping[str, str]
) -> Column:
    """Event type of a transaction. Labels, texts and their order.

    `patterns` holds the eight private patterns by name; a missing one is a KeyError.
    """
    family = party.rlike(patterns["family_member_rlike"])
    wired = method.isin("sepa_transfer", "transfer")
    return classify(
        [
            ("fx_swap", method == "currency_exchange"),
            (
                "investment_outflow",
                wired
                & (party.like(patterns["own_name_investment_pattern"]) | (account == patterns["investment_iban"])),
            ),
            (
                "internal_transfer",
                (description == "own transfer")
                | party.like("%revolut%")
                | party.rlike(patterns["own_name_rlike"]),
            ),
            (
                "credit_card_repayment",
                party.like("%spłata zadłużenia karty kredytowej%")
                | description.like("%credit card repayment%"),
            ),
            ("loan_repayment", description.like("%rata kredytu%")),
            ("income_salary", party.like(patterns["employer_name"]) | description.like("%wynagrodzenie%")),
            ("income_consulting", party.like(patterns["consulting_client"])),
            ("income_sale", family & description.like("%vendita%")),
            (
                "transfer_family",
                party.like(patterns["spouse_like"]) | party.like(patterns["spouse_like_alt"]) | family,
            ),
            (
                "expense_tax",
                description.like("%obc.podatek%")
                | party.like("%urząd skarbowy%")
                | party.like("%ministerstwo finansow%"),
            ),
            ("expense", description.like("%blokada%")),
            ("pending_block", method == "pending"),
            ("expense", method.isin("card", "blik", "transfer", "sepa_transfer")),
        ],
        otherwise="unclassified",
    )


def is_expense(event: Column) -> Column:
    return ~event.isin(EXCLUDED_EVENTS)


def add_classification(rows: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Adds payment_method, event_type and include_in_expense."""
    return (
        rows.withColumn("payment_method", payment_method(F.col("details")))
        .withColumn(
            "event_type",
            event_type(
                F.col("payment_method"),
                F.col("counterparty_details"),
                F.col("description"),
                F.col("account_number"),
                patterns,
            ),
        )
        .withColumn("include_in_expense", is_expense(F.col("event_type")))
    )
