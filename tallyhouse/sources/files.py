"""Small file-system helpers over Hadoop's FileSystem, so that any shared store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """True when the path, or at least one match of a glob, is there."""
    fs, target = _resolve(spark, path)
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def make_until_exit(spark: SparkSession, path: str) -> None:
    """A folder that is deleted, with all that is in it, when the driver ends."""
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)
