"""Writers for Parquet, CSV and Delta tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

FORMATS = ["parquet", "csv", "delta"]


class SinkError(ValueError):
    pass


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    mode: str = "overwrite",
    single_file: bool = False,
) -> None:
    """Write one table.

    A partitioned table is rebalanced by its partition column first: each
    partition value gets few files, and a value holding much of the data is
    split over several tasks. `single_file` is for tables whose caller knows that
    they are small: one task writes them, after all tasks have computed them.
    """
    if fmt not in FORMATS:
        raise SinkError(f"unknown format {fmt}; use one of {FORMATS}")
    if partition_by and single_file:
        raise SinkError("a partitioned table has a file for each partition at least")
    if partition_by:
        writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by)
    elif single_file:
        writer = df.repartition(1).write
    else:
        writer = df.write
    if fmt == "csv":
        writer = writer.option("header", True)
    try:
        writer.mode(mode).format(fmt).save(path)
    except Exception as error:
        if fmt == "delta" and "DATA_SOURCE_NOT_FOUND" in str(error):
            raise SinkError("delta tables need the Delta Lake package on Spark's classpath") from error
        raise


def append_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append rows to a report folder. Every CSV part carries the header, so the
    folder reads back as one table however often it was appended to."""
    writer = report.write.mode("append")
    if fmt == "csv":
        writer = writer.option("header", True)
    elif fmt != "parquet":
        raise SinkError(f"reports are written as csv or parquet, not {fmt}")
    writer.format(fmt).save(path)
