"""Row-count and row-loss reconciliation between raw and typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.parsing import is_real_date, without_blanks


def lookback(rows: DataFrame, date_column: str, days: int) -> DataFrame:
    """Rows dated at most `days` days before the latest date in the data."""
    latest = rows.agg(F.max(date_column).alias("latest")).scalar()
    return rows.filter(F.col(date_column) >= F.date_sub(latest, days))


def control_totals(kept: DataFrame, declared: DataFrame, source: str) -> DataFrame:
    """Per source: declared rows, kept rows and their difference.

    `declared` has (`source`, declared), one row per source.
    """
    counts = kept.groupBy(source).agg(F.count(F.lit(1)).alias("kept"))
    return declared.join(counts, source, "left").select(
        source,
        "declared",
        F.coalesce("kept", F.lit(0)).alias("kept"),
        (F.col("declared") - F.coalesce("kept", F.lit(0))).alias("difference"),
    )


def lost_rows(raw: DataFrame, kept: DataFrame, keys: Sequence[str], date_column: str) -> DataFrame:
    """Raw rows that name a real day and yet have no row, by `keys`, among `kept`."""
    return raw.filter(is_real_date(date_column)).join(kept.select(*keys), list(keys), "left_anti")


def unread_day(date_column: str, typed: Column) -> Column:
    """The text of a row that names a real day although `typed`, its reading, is NULL; else NULL."""
    return F.when(typed.isNull() & is_real_date(date_column), F.col(date_column))


def unparsed_dates(raw: DataFrame, date_column: str, typed: Column) -> DataFrame:
    """The rows `lost_rows` finds when `kept` is just `raw` filtered on `typed`
    being present: a plain filter, with no join."""
    return raw.filter(unread_day(date_column, typed).isNotNull())


def rejected_names(casts: Mapping[str, Column]) -> Column:
    """Comma-separated names of the raw columns holding a non-blank text that the
    cast could not read. `casts` maps a raw column to the typed expression over it."""
    return F.concat_ws(",", *[F.when(_rejected(name, typed), F.lit(name)) for name, typed in casts.items()])


def _rejected(name: str, typed: Column) -> Column:
    return typed.isNull() & (without_blanks(name) != "")


def rejected_casts(raw: DataFrame, casts: Mapping[str, Column]) -> DataFrame:
    """(column_name, rejected): how many texts of each column its cast could not read."""
    counts = raw.agg(*[F.count_if(_rejected(name, typed)).alias(name) for name, typed in casts.items()])
    return counts.unpivot([], list(casts), "column_name", "rejected")


def drop_repeats(rows: DataFrame, key: str) -> DataFrame:
    """One row per content key. Rows sharing a key agree on everything the key
    covers; map-side aggregation keeps a heavily repeated key cheap."""
    others = [c for c in rows.columns if c != key]
    kept = rows.groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
    return kept.select(key, "_row.*").select(*rows.columns)
