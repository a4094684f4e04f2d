"""Dimension tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.keys import category_key, date_key, name_key
from ledgermill.operators.rules import PAYMENT_METHODS
from ledgermill.operators.vocabulary import UNCLASSIFIED, UNCLASSIFIED_KEY, examples


class KeyCollision(ValueError):
    pass


def calendar_bounds(rows: DataFrame, date_column: str) -> DataFrame:
    """One row: 1 January of the first year and 31 December of the last."""
    return rows.agg(F.min(date_column).alias("lo"), F.max(date_column).alias("hi")).select(
        F.trunc("lo", "year").alias("first_day"),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("last_day"),
    )


def calendar_days(bounds: DataFrame) -> DataFrame:
    """One row per day between `first_day` and `last_day`; none when they are NULL."""
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date")
    )
    weekday = F.weekday("date") + 1
    return days.select(
        date_key(F.col("date")).alias("date_sk"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )


def date_dimension(rows: DataFrame, date_column: str) -> DataFrame:
    """Every day of the calendar years the rows touch; empty for empty rows."""
    return calendar_days(calendar_bounds(rows, date_column))


def method_dimension(spark: SparkSession, methods: Mapping[str, str] = PAYMENT_METHODS) -> DataFrame:
    rows = [(method, method, group) for method, group in methods.items()]
    return spark.createDataFrame(
        rows, "payment_method_sk string, payment_method string, payment_category string"
    )


def party_dimension(rows: DataFrame, name_column: str) -> DataFrame:
    """One member per canonical name. The empty name, whose key is the unknown one,
    is a member even if no row has it."""
    nameless = rows.sparkSession.createDataFrame([("",)], "counterparty_details string")
    names = rows.select(F.coalesce(name_column, F.lit("")).alias("counterparty_details"))
    members = names.union(nameless).distinct()
    return members.select(name_key(F.col("counterparty_details")).alias("counterparty_sk"), "counterparty_details")


def category_dimension(taxonomy: DataFrame) -> DataFrame:
    """Every (category, subcategory) of the taxonomy and the unclassified member."""
    listed = taxonomy.select(
        category_key(F.col("category"), F.col("subcategory")).alias("category_sk"), "category", "subcategory"
    )
    member = taxonomy.sparkSession.createDataFrame(
        [(UNCLASSIFIED_KEY, UNCLASSIFIED, UNCLASSIFIED)], listed.schema
    )
    return listed.unionByName(member)


def key_collisions(dimension: DataFrame, key: str) -> DataFrame:
    """(key, members) of the keys that more than one row carries."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")


def require_unique_keys(dimension: DataFrame, key: str) -> None:
    repeated = key_collisions(dimension, key).select(key)
    total = repeated.count()
    if total:
        raise KeyCollision(f"{key} is not unique: {examples(repeated, total)}")
