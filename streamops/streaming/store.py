"""Small values of a streaming query, kept as files in its shared folder.

Files go through Spark's Hadoop file system, so any store that Spark can write
works.  A value is written aside and renamed, so a reader finds a whole value
or none; every failure but "not there" is raised."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The value, or None if it was never written."""
    p, fs = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write or replace the value."""
    p, fs = _open(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"could not move {path}.tmp into place")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target must not exist."""
    a, fs = _open(spark, source)
    b, _ = _open(spark, target)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    p, fs = _open(spark, path)
    fs.delete(p, True)
