"""Checked publication of the star schema."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.facts import expense_report
from ledgermill.operators.quality import DataQualityError, enforce, gate_checks
from ledgermill.plans.gold import build_gold
from ledgermill.plans.silver import build_silver
from ledgermill.scale import discard, move, stage
from ledgermill.sinks.tables import SinkError, append_report, write_table
from ledgermill.sinks.versions import commit_version, new_version, read_version, version_path
from ledgermill.sources.exports import FALLBACK_CHARSET

logger = logging.getLogger(__name__)

FACTS = ["fact_expenses", "fact_income"]
# One row per day, category or payment method, whatever the number of transactions.
SMALL_TABLES = ["dim_date", "dim_category", "dim_payment_method"]
LOGGED_FILES = 50


@dataclass(frozen=True)
class Publication:
    """The published `tables`, and per file of the folder whether it was accepted
    (`files`) and how its declared and kept rows compare (`totals`)."""

    tables: dict[str, DataFrame]
    files: DataFrame
    totals: DataFrame


def _write(df: DataFrame, name: str, path: str, fmt: str) -> None:
    write_table(df, path, fmt, "year" if name in FACTS else None, single_file=name in SMALL_TABLES and fmt != "delta")


def checked_tables(tables: Mapping[str, DataFrame], silver: DataFrame) -> dict[str, DataFrame]:
    """The tables, written once and only returned if they pass the gate."""
    staged = {name: stage(df, name) for name, df in tables.items()}
    enforce(gate_checks(staged, silver))
    return staged


def publish(
    tables: Mapping[str, DataFrame], silver: DataFrame, folder: str, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Write every table, facts by year, if they pass the gate.

    Parquet is written once, beside its place, checked there and moved into place,
    so that what is published is what was checked. Other formats lose types that
    the checks need, so they are written from the checked Parquet.
    """
    folder = folder.rstrip("/")
    spark = silver.sparkSession
    if fmt != "parquet":
        staged = checked_tables(tables, silver)
        for name, df in staged.items():
            _write(df, name, f"{folder}/{name}", fmt)
        return staged
    pending = f"{folder}.pending-{uuid.uuid4().hex}"
    try:
        for name, df in tables.items():
            _write(df, name, f"{pending}/{name}", fmt)
        written = {n: spark.read.schema(df.schema).parquet(f"{pending}/{n}").select(*df.columns) for n, df in tables.items()}
        enforce(gate_checks(written, silver))
        for name in tables:
            move(spark, f"{pending}/{name}", f"{folder}/{name}")
    finally:
        discard(spark, pending)
    return {n: spark.read.schema(df.schema).parquet(f"{folder}/{n}").select(*df.columns) for n, df in tables.items()}


def publish_version(
    tables: Mapping[str, DataFrame], silver: DataFrame, folder: str, keep: int = 2
) -> dict[str, DataFrame]:
    """Write every table into a new version of `folder`, facts by year, and make it the current
    one if it passes the gate. Readers (`read_version`) see all tables of one version at any
    time, also if this stops halfway; then the unfinished version stays unseen."""
    spark = silver.sparkSession
    version = new_version()
    path = version_path(folder, version)
    try:
        for name, df in tables.items():
            _write(df, name, f"{path}/{name}", "parquet")
        written = {n: spark.read.schema(df.schema).parquet(f"{path}/{n}").select(*df.columns) for n, df in tables.items()}
        enforce(gate_checks(written, silver))
    except DataQualityError:
        discard(spark, path)
        raise
    commit_version(spark, folder, version, keep)
    return read_version(spark, folder, version)


def report_of(tables: Mapping[str, DataFrame]) -> DataFrame:
    return expense_report(
        tables["fact_expenses"],
        tables["dim_date"],
        tables["dim_counterparty"],
        tables["dim_category"],
    )


def log_files(files: DataFrame, totals: DataFrame) -> None:
    """Warn of rejected files, absent optional columns and totals that differ, and sum up."""
    counts = files.agg(F.count(F.lit(1)).alias("n"), F.count_if("accepted").alias("accepted")).first()
    lacking = files.filter(F.col("accepted") & (F.size("absent") > 0))
    notes = [
        ("rejected %s: %s", files.filter("not accepted").select("source_file", "reason")),
        ("%s has no column %s", lacking.select("source_file", F.array_join("absent", ", "))),
        ("%s: declared and kept rows differ by %s", totals.filter("difference != 0").select(totals.columns[0], "difference")),
    ]
    for text, rows in notes:
        found = rows.orderBy(rows.columns[0]).limit(LOGGED_FILES + 1).collect()
        for name, what in found[:LOGGED_FILES]:
            logger.warning(text, name, what)
        if len(found) > LOGGED_FILES:
            logger.warning("... and more, %d in all", rows.count())
    logger.info("%d of %d files accepted", counts.accepted, counts.n)


def run(
    spark: SparkSession,
    folder: str,
    out: str,
    patterns: Mapping[str, str],
    categories: Mapping[str, Sequence[str]],
    training: Mapping[str, Sequence[str]],
    fmt: str = "parquet",
    lookback_days: int | None = None,
    aliases: Sequence[str] = (),
    report: str | None = None,
    drop_duplicates: bool = False,
    pattern: str = "*.csv",
    fallback: str = FALLBACK_CHARSET,
    keep_versions: int | None = None,
) -> Publication:
    """Folder of exports to published star schema, or to an appended report when
    `report` names its folder. With `keep_versions` the tables are a new version of `out`.
    Files that were left out are logged and returned."""
    silver = build_silver(spark, folder, patterns, lookback_days, drop_duplicates, pattern, fallback)
    log_files(silver.files, silver.totals)
    tables = build_gold(silver.rows, categories, training, aliases)
    if report is None and keep_versions is not None:
        if fmt != "parquet":
            raise SinkError("versions are kept as parquet")
        return Publication(publish_version(tables, silver.rows, out, keep_versions), silver.files, silver.totals)
    if report is None:
        return Publication(publish(tables, silver.rows, out, fmt), silver.files, silver.totals)
    staged = checked_tables(tables, silver.rows)
    append_report(report_of(staged), report, "csv" if fmt == "csv" else "parquet")
    return Publication(staged, silver.files, silver.totals)


def run_checks(tables: Mapping[str, DataFrame], silver: DataFrame) -> list[Row]:
    return enforce(gate_checks(tables, silver))
