"""Folders as the file system lists them, whichever one Spark is set up for.

Names, sizes and a few small notes are handled on the driver; all data is read and
written by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    is_folder: bool
    size: int


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies in a folder; nothing where there is none.  Hidden names are left out."""
    system, at = _at(spark, path)
    if not system.exists(at):
        return []
    found = [(s.getPath().getName(), s.isDirectory(), s.getLen()) for s in system.listStatus(at)]
    return [Entry(*one) for one in found if one[0][0] not in "._"]


def content(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files below a folder and their bytes."""
    system, at = _at(spark, path)
    summary = system.getContentSummary(at)
    return summary.getFileCount(), summary.getLength()


def make(spark: SparkSession, path: str) -> None:
    """Have a folder, with those above it."""
    system, at = _at(spark, path)
    system.mkdirs(at)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; none may be there."""
    system, at = _at(spark, path)
    system.delete(at, True)


def put_text(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file; it appears under its name as a whole, in place of none."""
    folder, _, name = path.rpartition("/")
    system, at = _at(spark, path)
    _, hidden = _at(spark, f"{folder}/.{name}")
    out = system.create(hidden, True)
    out.write(bytearray(content.encode()))
    out.close()
    system.delete(at, False)
    if not system.rename(hidden, at):
        raise OSError(f"could not write {path}")


def text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    system, at = _at(spark, path)
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
