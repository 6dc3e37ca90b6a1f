"""Folders and small text files on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file; False if it is not there."""
    p, fs = _fs(spark, path)
    return fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, in order; none if it is not there."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> list[str]:
    """Move the data files of one folder into another under new names; returns their paths."""
    _, fs = _fs(spark, source)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(target))
    moved = []
    for name in children(spark, source):
        if not name.startswith(("_", ".")):
            moved.append(f"{target}/{prefix}{name}")
            fs.rename(path(f"{source}/{name}"), path(moved[-1]))
    return moved


def set_modified(spark: SparkSession, paths: list[str], millis: int) -> bool:
    """Give files a modification time; False where the file system keeps its own."""
    for name in paths:
        p, fs = _fs(spark, name)
        fs.setTimes(p, millis, -1)
        if fs.getFileStatus(p).getModificationTime() != millis:
            return False
    return True


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Create a small text file as a whole: written beside its place, then renamed into it.

    A reader sees all of it or nothing.  ``path`` must be new: files are never replaced.
    """
    folder, name = path.rsplit("/", 1)
    aside, fs = _fs(spark, f"{folder}/_{name}-{uuid.uuid4().hex[:12]}")
    fs.mkdirs(aside.getParent())
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not fs.rename(aside, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)):
        fs.delete(aside, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it is not there, '' if its checksum tells that it is damaged."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    except Py4JJavaError as error:
        if "ChecksumException" not in error.java_exception.getClass().getName():
            raise
        return ""
    finally:
        stream.close()


def published(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished files under a folder, in order."""
    return [name for name in children(spark, path) if not name.startswith(("_", "."))]


def version(spark: SparkSession, path: str) -> str:
    """Changes when the files under ``path`` do (size, count and time of the newest listing)."""
    p, fs = _fs(spark, path)
    total = fs.getContentSummary(p)
    return f"{total.getLength()}-{total.getFileCount()}-{fs.getFileStatus(p).getModificationTime()}"
