"""Directory operations on whatever file system the cluster shares."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def make_directory(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.delete(target, True)


def delete_if_empty(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    if system.exists(target) and not system.listStatus(target):
        system.delete(target, False)


def age_seconds(spark: SparkSession, path: str) -> float:
    """How long ago a file was written."""
    system, target = _open(spark, path)
    written = system.getFileStatus(target).getModificationTime()
    return (spark._jvm.System.currentTimeMillis() - written) / 1000


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one go, in place of one that is there."""
    system, target = _open(spark, path)
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None where there is none."""
    system, target = _open(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, as full names."""
    system, target = _open(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(target) or []]


def partition_value(path: str) -> str:
    """``7`` for ``.../batch_id=7``."""
    return path.rstrip("/").rsplit("=", 1)[1]
