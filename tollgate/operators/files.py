"""Disk that steps hand back: shuffle files and folders that nothing reads any more."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end. Otherwise the files stay until
    the driver's garbage collector finds them unused, which may be after the last of many steps."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def _opened(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder with its files; one that is not there is left alone."""
    fs, path = _opened(spark, folder)
    if not fs.delete(path, True) and fs.exists(path):
        raise OSError(f"{folder} was not deleted")


def move_folder(spark: SparkSession, folder: str, to: str) -> None:
    """Renames a folder within its file system; `to` must not be there."""
    fs, path = _opened(spark, folder)
    if not fs.rename(path, _opened(spark, to)[1]):
        raise OSError(f"{folder} was not renamed to {to}")
