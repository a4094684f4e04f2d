"""Loading of new export files only, into transactions partitioned by year.

`folder/files` lists every file that was loaded: path, size, time of change and content
hash, one row per file and load. A run lists the exports, leaves out those that are
listed with the same size and time without opening them, and reads the rest. A file
whose hash is listed under another name, or twice in the run, is loaded once.

The years that the new rows, or replaced rows, belong to are written again: their
present rows without those of the same files, and the new ones, by dynamic partition
overwrite. The list is written after that, so a run that stops halfway loads the same
files again and replaces what it had written. Running again with nothing new changes
nothing. Several runs give the rows of one run over all files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.plans.silver import audited_rows, require_complete, require_readable
from ledgermill.scale import attach, discard, stage
from ledgermill.sources.exports import FALLBACK_CHARSET, hashes_of, lines_of, parse_lines

LISTED = "path string, size bigint, changed timestamp, hash string, loaded_at timestamp"


@dataclass(frozen=True)
class Load:
    """Files found, read (new or changed) and loaded (not a copy of a loaded one), the years
    written, and the rows with a real date that were left out (0 unless `strict` is off)."""

    found: int
    read: int
    loaded: int
    years: list[int]
    lost: int = 0


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """path, size and changed of the matching files; their contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def loaded_files(spark: SparkSession, target: str) -> DataFrame:
    """The latest entry of every file that was loaded."""
    path = f"{target}/files"
    if not _exists(spark, path):
        return spark.createDataFrame([], LISTED)
    latest = Window.partitionBy("path").orderBy(F.col("loaded_at").desc())
    rows = spark.read.schema(LISTED).parquet(path).withColumn("_n", F.row_number().over(latest))
    return rows.filter("_n = 1").drop("_n")


def read_rows(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target.rstrip('/')}/rows")


def load_new(
    spark: SparkSession,
    folder: str,
    target: str,
    patterns: Mapping[str, str],
    pattern: str = "*.csv",
    fallback: str = FALLBACK_CHARSET,
    strict: bool = True,
) -> Load:
    """Bring the transactions of new and changed files of `folder` into `target`.

    Lost rows and unreadable values stop the load; without `strict` such rows are left out
    and counted, and such values are null."""
    target = target.rstrip("/")
    known = loaded_files(spark, target)
    found = stage(list_files(spark, folder, pattern), "found-files")
    new = found.join(known.select("path", "size", "changed"), ["path", "size", "changed"], "left_anti")
    paths = [r.path for r in new.select("path").collect()]  # names that the driver listed itself
    n_found = found.count()
    if not paths:
        return Load(n_found, 0, 0, [])
    hashed = stage(hashes_of(spark, paths).join(new, "path"), "new-hashes")
    first = hashed.groupBy("hash").agg(F.min("path").alias("path"))
    others = known.join(hashed.select("path"), "path", "left_anti")  # entries of files that did not change
    wanted = stage(first.join(others.select("hash").distinct(), "hash", "left_anti"), "wanted-files")
    # Rows to replace: those of the same contents, and of what changed files held before, unless another file still holds it.
    held = others.select("hash").union(hashed.select("hash"))
    before = known.join(hashed.select("path"), "path").select("hash").join(held, "hash", "left_anti")
    gone = stage(before.union(wanted.select("hash")).distinct(), "replaced-hashes")
    rows, lost = None, 0
    if not wanted.isEmpty():
        lines = lines_of(spark, [r.path for r in wanted.select("path").collect()])
        parsed = parse_lines(lines, wanted.select("path", "hash"), fallback)
        audited = stage(audited_rows(parsed.rows, patterns), "new-rows")
        if strict:
            require_complete(audited)
            require_readable(audited)
        lost = audited.filter("_lost IS NOT NULL").count()
        rows = audited.filter("_lost IS NULL").drop("_rejected", "_lost").withColumn("year", F.year("transaction_date"))
    years = _merge(spark, rows, gone, f"{target}/rows")
    hashed.select("path", "size", "changed", "hash", F.current_timestamp().alias("loaded_at")).write.mode("append").parquet(
        f"{target}/files"
    )
    return Load(n_found, len(paths), wanted.count(), years, lost)


def _merge(spark: SparkSession, rows: DataFrame | None, gone: DataFrame, path: str) -> list[int]:
    """Replace the rows of the hashes `gone` by `rows`, writing only the years that change."""
    touched = rows.select("year").distinct() if rows is not None else None
    kept = None
    if _exists(spark, path):
        present = spark.read.parquet(path)
        marked = gone.withColumnRenamed("hash", "_hash").withColumn("_gone", F.lit(True))
        flagged = attach(present, marked, ["_hash"], "left", spread=["transaction_sk", "_line_seq"])
        left = flagged.filter("_gone").select("year").distinct()
        touched = left if touched is None else touched.union(left).distinct()
        years = [r.year for r in touched.collect()]  # calendar years
        kept = flagged.filter(F.col("_gone").isNull() & F.col("year").isin(years)).drop("_gone")
    else:
        years = [r.year for r in touched.collect()] if touched is not None else []
    parts = [df for df in (kept, rows) if df is not None]
    if not years or not parts:
        return sorted(years)
    merged = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    merged = stage(merged, "merged-years")  # the write below replaces what it is made from
    written = merged.hint("rebalance", "year").write.partitionBy("year").mode("overwrite")
    written.option("partitionOverwriteMode", "dynamic").parquet(path)
    filled = {r.year for r in merged.select("year").distinct().collect()}
    for year in set(years) - filled:  # nothing is left of it, so the write did not touch it
        discard(spark, f"{path}/year={year}")
    return sorted(years)
