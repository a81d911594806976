"""Small text files and folders on whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if there is none."""
    fs, place = _at(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small text file; None if there is none."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a small text file whole or not at all: readers never see a part of it."""
    fs, place = _at(spark, path)
    _, draft = _at(spark, f"{path}.{uuid.uuid4().hex[:12]}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(place, False)
    if not fs.rename(draft, place):
        raise OSError(f"cannot publish {path}")
