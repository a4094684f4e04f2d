"""Whole versions of a set of tables behind one pointer.

    folder/versions/<id>/<table>    the tables of one version, never changed
    folder/CURRENT                  the ids of the kept versions, the current one first

A version is written beside the others. Readers see it when the pointer is renamed
over the old one, which file systems do in one step, so they find all tables of one
version at any moment, whatever happens to the writer. Versions that the pointer no
longer names are deleted after that; the one before the current stays, for readers
that opened it.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from ledgermill.scale import discard

POINTER = "CURRENT"


class NoVersionError(FileNotFoundError):
    pass


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _storage(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _replace(spark: SparkSession, source: str, target: str) -> None:
    fs = spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    where = _path(spark, target).toUri()
    context = fs.FileContext.getFileContext(where, spark._jsc.hadoopConfiguration()) if where.getScheme() else fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, source), _path(spark, target), overwrite)


def version_path(folder: str, version: str) -> str:
    return f"{folder.rstrip('/')}/versions/{version}"


def new_version() -> str:
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def kept_versions(spark: SparkSession, folder: str) -> list[str]:
    """The versions that readers may open, the current one first."""
    pointer, storage = f"{folder.rstrip('/')}/{POINTER}", _storage(spark, folder)
    if not storage.exists(_path(spark, pointer)):
        return []
    stream = storage.open(_path(spark, pointer))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def commit_version(spark: SparkSession, folder: str, version: str, keep: int = 2) -> None:
    """Make `version` the current one, keeping `keep` versions in all."""
    folder = folder.rstrip("/")
    before = kept_versions(spark, folder)
    after = [version, *[v for v in before if v != version]][: max(keep, 1)]
    pending = f"{folder}/{POINTER}.{uuid.uuid4().hex}"
    stream = _storage(spark, folder).create(_path(spark, pending), False)
    try:
        stream.write("\n".join(after).encode())
    finally:
        stream.close()
    _replace(spark, pending, f"{folder}/{POINTER}")
    for old in set(before) - set(after):
        discard(spark, version_path(folder, old))


def read_version(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the current one unless told otherwise."""
    if version is None:
        kept = kept_versions(spark, folder)
        if not kept:
            raise NoVersionError(f"nothing was published in {folder}")
        version = kept[0]
    path = version_path(folder, version)
    tables = _storage(spark, folder).listStatus(_path(spark, path))
    names = sorted(t.getPath().getName() for t in tables if t.isDirectory())
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
