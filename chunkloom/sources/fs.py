"""Small files on whatever file system a path names (local, HDFS, object stores), through Hadoop's interface."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes under another name first and renames over the old file, so a reader never sees half a file or none."""
    fs, p = _at(spark, path)
    _, other = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(other, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    rename(spark, other.toString(), path)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or a folder, over what is there: in one step where the file system can."""
    jvm = spark._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), spark._jsc.hadoopConfiguration()) if b.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    fs, _ = _at(spark, target)
    if fs.exists(b) and fs.getFileStatus(b).isDirectory():
        fs.delete(b, True)  # a folder that is not empty can't be renamed over
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fs.mkdirs(b.getParent())
    context.rename(a, b, options)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder; nothing happens where there is none."""
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def copy(spark: SparkSession, source: str, target: str) -> int:
    """Copies a file or a folder, also to another file system; files that are there with the same length stay.  Their number."""
    a, p = _at(spark, source)
    b, q = _at(spark, target)
    jvm, n = spark._jvm, 0
    if a.getFileStatus(p).isFile():
        if not b.exists(q) or b.getFileStatus(q).getLen() != a.getFileStatus(p).getLen():
            jvm.org.apache.hadoop.fs.FileUtil.copy(a, p, b, q, False, True, spark._jsc.hadoopConfiguration())
        return 1
    for s in a.listStatus(p):
        n += copy(spark, s.getPath().toString(), f"{target}/{s.getPath().getName()}")
    return n


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match, sorted; none where the folder is missing."""
    fs, p = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))


def count_files(spark: SparkSession, root: str) -> int:
    fs, p = _at(spark, root)
    if not fs.exists(p):
        return 0
    n, it = 0, fs.listFiles(p, True)
    while it.hasNext():
        it.next()
        n += 1
    return n


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; a local session without that setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.removeprefix('file://')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")
