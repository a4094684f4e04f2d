"""Helpers that keep joins and lineage safe at any data size.

Two decisions recur throughout the package: whether a side of a join is small
enough to broadcast, and where to put a result that several later steps read.
Both are made here, from measured sizes and the session's own settings.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Session settings the package is tuned with. Expressions over many text columns
# generate methods beyond what the JVM compiles; the limit makes Spark split them.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 128 * 1024 * 1024
COPY_ROWS = 10_000
HOT_SHARE = 4096
SALTS = 64


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="ledgermill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and return the written table.

    Later readers get pruned columnar scans, real size statistics and no
    lineage to recompute when an executor is lost.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with compiled(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Actions within the block take the method limit of `SESSION_SETTINGS`, whatever the caller's
    session has: with Spark's own limit wide projections become methods that the JVM only interprets."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, str(min(int(before), int(SESSION_SETTINGS[METHOD_LIMIT]))))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files under `path`, as the storage lists them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def move(spark: SparkSession, path: str, to: str) -> None:
    """Put the folder `path` in the place of `to`, which it replaces."""
    conf = spark._jsc.hadoopConfiguration()
    source, target = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(to)
    storage = target.getFileSystem(conf)
    storage.delete(target, True)
    storage.mkdirs(target.getParent())
    if not storage.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


class Scratch:
    """Staged tables that are deleted together when the block that made them ends.

    What the block returns must not read them any more: it is staged itself, or
    made of tables that were staged outside. Then nothing that may have to be
    computed again after the loss of an executor refers to a deleted file.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.n = 0

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        discard(self.spark, self.folder)


def _row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes: texts and nested values measured, the rest fixed."""
    total = F.lit(8 * len(schema))
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return total.cast("bigint")


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether `df` has at most `rows` rows and about `size` bytes, both measured."""
    measured = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("size")
    ).first()
    return measured.n <= rows and measured["size"] <= size


def widen(df: DataFrame, key: str) -> DataFrame:
    """`df` spread over all cores by `key` where its input is too small to fill them.

    One small file is one task however many cores there are, which costs most
    before text work. Input with a split for every core is left alone.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def bounded_arrow(df: DataFrame, rows: int) -> pa.Table | None:
    """`df` on the driver if it has at most `rows` rows, else None. Rebuilding the
    DataFrame from it gives Spark its exact size and no history to recompute."""
    table = df.limit(rows + 1).toArrow()
    return table if table.num_rows <= rows else None


def small_copy(df: DataFrame, rows: int = COPY_ROWS) -> DataFrame:
    """`df` rebuilt from its rows if they are few, else written to the shared folder."""
    table = bounded_arrow(df, rows)
    return stage(df, "copy") if table is None else df.sparkSession.createDataFrame(table, df.schema)


def attach(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str | Column] = (),
    limit: int = BROADCAST_ROWS,
    fits: bool | None = None,
    *,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join `rows` to `table`, which has at most one row per key `on`.

    A table within `limit` rows and `BROADCAST_BYTES` is broadcast and `rows` stay
    where they are; `fits` tells the outcome if it was measured before.
    A larger one is joined by shuffle, with the hot keys of `rows` salted:
    keys holding more than 1/`HOT_SHARE` of all rows, hence fewer than
    `HOT_SHARE` of them, are replicated `SALTS` times on the table side.
    `spread` lists the columns that tell rows of one key apart; the salt is a
    hash of them, so a recomputed task sends every row to the same place.
    `counts` has the keys with their numbers of rows `n`, if these were counted
    before; then `rows` are not read once more to find the hot ones.
    """
    on = list(on)
    if how not in ("left", "inner"):
        raise ValueError(f"attach supports left and inner joins, not {how}")
    if fits_broadcast(table, limit) if fits is None else fits:
        return rows.join(F.broadcast(table), on, how)
    if not spread:
        return rows.join(table, on, how)

    if counts is None:
        per_key = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        total = rows.agg(F.count(F.lit(1)).alias("_n"))
    else:
        per_key, total = counts.withColumnRenamed("n", "_n"), counts.agg(F.sum("n").alias("_n"))
    hot = per_key.filter(F.col("_n") * HOT_SHARE > total.scalar()).select(*on, F.lit(True).alias("_hot"))
    hot = stage(hot, "hot-keys")  # fewer than HOT_SHARE rows by construction
    missing = F.lit(False)  # rows with a NULL key match nothing, yet must not meet in one task
    for key in on:
        missing = missing | F.col(key).isNull()
    no_salt, every_salt = F.array(F.lit(0)), F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted_rows = rows.join(F.broadcast(hot), on, "left").withColumn(
        "_salt",
        F.when(F.col("_hot") | missing, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).otherwise(0),
    )
    salted_table = table.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every_salt).otherwise(no_salt))
    )
    return (
        salted_rows.drop("_hot")
        .join(salted_table.drop("_hot"), [*on, "_salt"], how)
        .drop("_salt")
    )


def spread_join(
    rows: DataFrame, table: DataFrame, on: Sequence[str], spread: Sequence[str], salts: int = 16
) -> DataFrame:
    """Inner join of two sides that both repeat their keys and neither of which can be
    broadcast. Every key is split into `salts` parts by a hash of `spread`, and the
    table, the smaller side, repeated for each, so no key meets in one task."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"]).drop("_salt")
