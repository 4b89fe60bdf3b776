"""Folders of tables, through the file system that Spark reads them with."""

from __future__ import annotations

import uuid
from collections.abc import Collection
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _open(spark, path)
    return system.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path: one listing, no file below is looked at."""
    system, place = _open(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder; 0 if there is none."""
    system, place = _open(spark, path)
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def make(spark: SparkSession, path: str) -> None:
    system, place = _open(spark, path)
    system.mkdirs(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    system, place = _open(spark, source)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    system, place = _open(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below a path."""
    system, place = _open(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isFile())


def publish(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; a name that is taken is refused."""
    system, place = _open(spark, path)
    aside = place.suffix(f".{uuid.uuid4().hex[:8]}.tmp")
    out = system.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if system.exists(place) or not system.rename(aside, place):
        system.delete(aside, False)
        raise FileExistsError(path)


def content(spark: SparkSession, path: str) -> str:
    system, place = _open(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_value(folder: str) -> str | None:
    """The value in a folder name ``column=value``; None for the null partition."""
    value = unquote(folder.partition("=")[2])
    return None if value == NULL_PARTITION else value


def partition_paths(
    spark: SparkSession, root: str, partition_by: str, values: Collection[str | None]
) -> list[str]:
    """Folders of the given partitions that are there."""
    named = [f for f in folders(spark, root) if f.startswith(f"{partition_by}=")]
    return [f"{root}/{f}" for f in named if partition_value(f) in values]
