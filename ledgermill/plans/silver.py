"""Typed and classified transactions from raw rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import parsing as p
from ledgermill.functions.keys import content_key
from ledgermill.operators.reconcile import (
    control_totals,
    drop_repeats,
    lookback,
    rejected_names,
    unread_day,
)
from ledgermill.operators.rules import add_classification
from ledgermill.scale import stage
from ledgermill.sources.exports import FALLBACK_CHARSET, POSITION_COLUMNS, PROVENANCE_COLUMNS, read_exports


class DataLossError(ValueError):
    pass


@dataclass(frozen=True)
class Silver:
    rows: DataFrame
    files: DataFrame
    totals: DataFrame


STRICT_CASTS = {
    "posting_date": p.exact_date,
    "transaction_amount": p.locale_decimal,
    "blocked_amount": p.locale_decimal,
    "foreign_payment_amount": p.locale_decimal,
    "balance_after_transaction": p.locale_double,
}


def strict_casts() -> dict[str, Column]:
    return {name: cast(name) for name, cast in STRICT_CASTS.items()}


def type_rows(raw: DataFrame, *extra: Column, also: Column | None = None) -> DataFrame:
    """Typed rows of all raw rows that carry a transaction date, and of those that
    `also` selects, with `extra` columns over the raw ones.

    One projection and one filter over the scan. The content key is taken over
    the raw texts, so it does not depend on the cleaning below it.
    """
    day = p.lenient_date("transaction_date")
    parts = [
        day.cast("string"),
        p.blank_to_null("transaction_id"),
        F.col("counterparty_details"),
        F.col("transaction_amount"),
    ]
    return raw.filter(day.isNotNull() if also is None else day.isNotNull() | also).select(
        content_key(parts).alias("transaction_sk"),
        day.alias("transaction_date"),
        STRICT_CASTS["posting_date"]("posting_date").alias("posting_date"),
        p.tidy_lower("counterparty_details").alias("counterparty_details"),
        p.tidy_lower("description").alias("description"),
        p.clean_identifier("account_number").alias("account_number"),
        p.tidy("bank_name").alias("bank_name"),
        p.tidy_lower("details").alias("details"),
        p.clean_identifier("transaction_id").alias("transaction_id"),
        p.locale_decimal("transaction_amount").alias("transaction_amount"),
        p.tidy("transaction_currency").alias("transaction_currency"),
        p.locale_decimal("blocked_amount").alias("blocked_amount"),
        p.tidy("blocked_currency").alias("blocked_currency"),
        p.locale_decimal("foreign_payment_amount").alias("foreign_payment_amount"),
        p.tidy("foreign_payment_currency").alias("foreign_payment_currency"),
        p.tidy("account").alias("account"),
        p.locale_double("balance_after_transaction").alias("balance_after_transaction"),
        *[c for c in PROVENANCE_COLUMNS + POSITION_COLUMNS if c in raw.columns],
        *extra,
    )


def silver_rows(
    raw: DataFrame, patterns: Mapping[str, str], *extra: Column, also: Column | None = None
) -> DataFrame:
    return add_classification(type_rows(raw, *extra, also=also), patterns)


def audited_rows(raw: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """`silver_rows` with what is wrong with each: `_rejected` names the columns whose
    text could not be cast, `_lost` holds the date of a row that names a real day and
    would be left out. Such a row is kept here, so that one pass finds both."""
    lost = unread_day("transaction_date", p.lenient_date("transaction_date"))
    return silver_rows(
        raw,
        patterns,
        rejected_names(strict_casts()).alias("_rejected"),
        lost.alias("_lost"),
        also=lost.isNotNull(),
    )


def require_readable(rows: DataFrame) -> None:
    """Raise when `_rejected` names a column whose text could not be cast."""
    names = rows.filter("_rejected != ''").select(F.explode(F.split("_rejected", ",")).alias("name"))
    found = names.groupBy("name").count().collect()  # at most one row per cast column
    if found:
        raise DataLossError(f"texts that could not be read: {sorted((r.name, r['count']) for r in found)}")


def require_complete(rows: DataFrame) -> None:
    """Raise when `_lost` marks a row, whatever the declared totals of its file say:
    differences of several files, or of a lost and an undeclared row, cancel out."""
    found = rows.agg(F.count("_lost").alias("n"), F.min("_lost").alias("example")).first()
    if found.n:
        raise DataLossError(f"{found.n} rows with a real date were dropped, such as {found.example}")


def build_silver(
    spark: SparkSession,
    folder: str,
    patterns: Mapping[str, str],
    lookback_days: int | None = None,
    drop_duplicates: bool = False,
    pattern: str = "*.csv",
    fallback: str = FALLBACK_CHARSET,
) -> Silver:
    """Read, type and classify a folder of exports, written once for all readers."""
    export = read_exports(spark, folder, pattern, fallback)
    audited = stage(audited_rows(export.rows, patterns), "silver")
    require_complete(audited)
    require_readable(audited)
    rows = audited.drop("_rejected", "_lost")
    declared = export.files.filter("accepted").select(
        F.col("source_file").alias("_source_file"), "declared"
    )
    totals = control_totals(rows, declared, "_source_file")
    if drop_duplicates:
        rows = drop_repeats(rows, "transaction_sk")
    if lookback_days is not None:
        rows = lookback(rows, "transaction_date", lookback_days)
    return Silver(rows, export.files, totals)
