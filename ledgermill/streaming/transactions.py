"""Raw export rows as a stream: typed, classified, without repeats, gated batch by batch.

Typing and classification keep no state and are those of the batch plan. Repeats are
dropped by content key within a watermark on the transaction date, so the state holds
the keys of `delay` days and not of all time. Each batch is checked before it is
written, to a folder of its own that is overwritten if the batch is run again: after a
failure the stream goes on from its checkpoint without loss or repeats.

A row that comes more than `delay` later than the newest one seen is dropped by Spark;
`run_available` counts such rows and raises unless they are allowed for.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgermill.operators.quality import enforce, no_nulls, unique_key
from ledgermill.plans.silver import DataLossError, audited_rows, require_complete, require_readable
from ledgermill.scale import stage
from ledgermill.sources.exports import BUSINESS_COLUMNS

DELAY = "90 days"
RAW_SCHEMA = StructType([StructField(name, StringType()) for name in BUSINESS_COLUMNS])


def raw_stream(spark: SparkSession, folder: str, files_at_once: int | None = None, pattern: str = "*.parquet") -> DataFrame:
    """Rows of raw texts from Parquet files as they arrive in `folder`."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("pathGlobFilter", pattern)
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.parquet(folder)


def without_repeats(rows: DataFrame, delay: str = DELAY) -> DataFrame:
    """Rows whose content key was not seen within `delay` of transaction dates. Rows whose date
    cannot be read have the time of the oldest day, and are left to the gate of their batch."""
    timed = rows.withColumn("event_time", F.coalesce(F.col("transaction_date"), F.col("_lost")).cast("timestamp"))
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["transaction_sk"]).drop("event_time")


def batch_checks(rows: DataFrame) -> DataFrame:
    checks = [no_nulls(rows, ["transaction_sk", "transaction_date"], "batch"), unique_key(rows, "transaction_sk", "batch")]
    return reduce(DataFrame.unionByName, checks)


def gated_append(path: str, strict: bool = True):
    """A writer of one batch: nothing is written unless the batch passes its checks. Without
    `strict`, rows whose real date is not read are left out and unreadable values are null."""

    def write(rows: DataFrame, batch: int) -> None:
        rows = stage(rows, "stream-batch")
        if strict:
            require_complete(rows)
            require_readable(rows)
        rows = rows.filter("_lost IS NULL").drop("_rejected", "_lost")
        enforce(batch_checks(rows))
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write


def run_available(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    patterns: Mapping[str, str],
    delay: str = DELAY,
    files_at_once: int | None = None,
    allow_late: bool = False,
    strict: bool = True,
) -> int:
    """Process the files that have arrived since the last run; the number of rows that came too late."""
    rows = without_repeats(audited_rows(raw_stream(spark, folder, files_at_once), patterns), delay)
    query = (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(gated_append(out.rstrip("/"), strict))
        .start()
    )
    query.awaitTermination()
    late = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    if late and not allow_late:
        raise DataLossError(f"{late} rows came more than {delay} late")
    return late


def read_stream_output(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")
