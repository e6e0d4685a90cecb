"""The few file-system questions a job asks, answered by Hadoop's own file system client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _client(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths in `folder` that match a glob, sorted; an absent folder has none."""
    target, fs = _client(spark, f"{folder.rstrip('/')}/{pattern}")
    return sorted(status.getPath().toString() for status in (fs.globStatus(target) or []))


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _client(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    target, fs = _client(spark, path)
    fs.mkdirs(target)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another name on the same file system."""
    source, fs = _client(spark, path)
    target, _ = _client(spark, to)
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {path} to {to}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; an absent one is fine."""
    target, fs = _client(spark, path)
    fs.delete(target, True)
