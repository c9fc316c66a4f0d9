"""Small file operations on the store a path names (HDFS, object store,
local), through Spark's Hadoop configuration. They act on commit records and
folders, a handful per job, never on rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    p, fs = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; the target's parent is made, the target must
    not exist."""
    s, fs = _fs(spark, source)
    t, _ = _fs(spark, target)
    fs.mkdirs(t.getParent())
    if fs.exists(t) or not fs.rename(s, t):
        raise FileExistsError(target)


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates ``path`` with ``text`` in one step: the text is written beside it
    and renamed without overwriting. False if the path exists already, so of two
    writers one wins. On HDFS the rename is atomic; an object store needs a
    Hadoop file system whose rename is."""
    jvm = spark.sparkContext._jvm
    p, fs = _fs(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(p).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(p), options)
        return True
    except Exception:
        if not fs.exists(p):
            raise
        fs.delete(beside, False)
        return False
