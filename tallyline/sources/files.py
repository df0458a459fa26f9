"""Files of the shared stores, through Spark's own file-system layer: any scheme Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file or a folder with all below it; False if it was not there."""
    fs, where = _at(spark, path)
    return fs.delete(where, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no folder."""
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the data files right in a folder, without markers and hidden files."""
    return [f"{folder}/{n}" for n in names(spark, folder) if not n.startswith(("_", "."))]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file that appears whole or not at all; False if the name is taken.

    It is written under a hidden name and renamed. A rename that finds its target taken fails on
    distributed file systems; the look beforehand covers the local one, which would replace it.
    """
    fs, where = _at(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(
        where.getParent(), f".{where.getName()}.{spark._jvm.java.util.UUID.randomUUID()}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    done = not fs.exists(where) and fs.rename(hidden, where)
    if not done:
        fs.delete(hidden, False)
    return done
