"""Small files and folders, through the file system that Spark itself uses for a path."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, in order; none if it is not there."""
    system, located = _located(spark, path)
    if not system.exists(located):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(located))


def read_small(spark: SparkSession, path: str) -> str:
    system, located = _located(spark, path)
    stream = system.open(located)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A new file that appears whole or not at all: it is written under another, hidden name
    and renamed. Fails if the file is there already."""
    system, located = _located(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(
        located.getParent(), f"_{located.getName()}.{uuid.uuid4().hex}"
    )
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(located) or not system.rename(hidden, located):
        system.delete(hidden, False)
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    """A file or a folder with all it holds; nothing if it is not there."""
    system, located = _located(spark, path)
    system.delete(located, True)
