"""Folders of any Hadoop file system, handled from the driver: names only, never their rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and all below it, if it is there."""
    fs, where = _of(spark, path)
    fs.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _of(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in the folder ``path``; none, if it isn't there."""
    fs, where = _of(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def write_small(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """A small file, written from the driver; if there is one, it fails or overwrites it."""
    fs, where = _of(spark, path)
    out = fs.create(where, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    fs, where = _of(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def statuses(spark: SparkSession, path: str) -> Iterator[tuple[str, int, int]]:
    """(path, length, modification time in ms) of every file at or below ``path``, page by page.

    ``path`` may be a glob.  Hidden names and empty files are included.
    """
    fs, where = _of(spark, path)
    for found in fs.globStatus(where) or ():
        files = fs.listFiles(found.getPath(), True)
        while files.hasNext():
            f = files.next()
            yield f.getPath().toString(), f.getLen(), f.getModificationTime()


def date_in_order(spark: SparkSession, path: str) -> bool:
    """Date the files named ``part-...`` in the folder ``path`` a second apart, in the order of their names.

    False where the file system does not keep the times (object stores don't).
    """
    fs, where = _of(spark, path)
    found = sorted((s.getPath().getName(), s.getModificationTime(), s.getPath()) for s in fs.listStatus(where)
                   if s.getPath().getName().startswith("part-"))
    first = min((time for _, time, _ in found), default=0) - 1000 * len(found)
    for i, (_, _, file) in enumerate(found):
        fs.setTimes(file, first + 1000 * i, -1)
    dated = {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(where)}
    times = [dated[name] for name, _, _ in found]
    return all(a < b for a, b in zip(times, times[1:], strict=False))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _of(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isDirectory()


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as listings write it."""
    fs, where = _of(spark, path)
    return fs.makeQualified(where).toString()
