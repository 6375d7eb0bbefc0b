"""Small file-system steps through the session's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, none if there is no such folder."""
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, place = _at(spark, path)
    return fs.getContentSummary(place).getLength()


def touch(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.create(place, True).close()


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """Writes a small new file whole or not at all: under another name first, then renamed."""
    fs, place = _at(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    if fs.exists(place) or not fs.rename(part, place):
        raise FileExistsError(path)
