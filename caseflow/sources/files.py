"""Files on any file system Spark can reach, through Hadoop's FileSystem."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of a glob pattern, by file name."""
    fs, p = _open(spark, pattern)
    return sorted((str(s.getPath().toString()) for s in fs.globStatus(p) or []), key=lambda x: x.rsplit("/", 1)[-1])


def files(spark: SparkSession, path: str) -> list[str]:
    """A file, or the data files of a folder by name."""
    fs, p = _open(spark, path)
    found = fs.listStatus(p)
    paths = [str(s.getPath().toString()) for s in found if s.isFile()]
    return sorted(x for x in paths if x.rsplit("/", 1)[-1][0] not in "._")


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, read by itself."""
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file whole."""
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8", "replace")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small text file; an error where it is there already."""
    fs, p = _open(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def age(spark: SparkSession, path: str) -> float:
    """Seconds since the newest change of a file, or of a folder and of what is directly in it."""
    fs, p = _open(spark, path)
    newest = max([fs.getFileStatus(p).getModificationTime(), *[s.getModificationTime() for s in fs.listStatus(p)]])
    return max(0.0, time.time() - newest / 1000)
