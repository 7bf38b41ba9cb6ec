"""Files of a table, through Hadoop's file system API, so any store Spark can reach works.

Used on the driver only, for a handful of calls per table: existence, rename, delete, first line.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.exists(jpath)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _open(spark, path)
    fs.delete(jpath, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """An existing path goes when the driver's process ends."""
    fs, jpath = _open(spark, path)
    fs.deleteOnExit(jpath)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, jold = _open(spark, old)
    if not fs.rename(jold, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {old} to {new}")


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file in UTF-8, without its line end; empty for an empty file."""
    fs, jpath = _open(spark, path)
    java = spark.sparkContext._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(fs.open(jpath), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, jpath = _open(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(jpath)] if fs.exists(jpath) else []


def sizes(spark: SparkSession, path: str, suffix: str) -> list[int]:
    """Bytes of the files of a folder whose names end so, hidden ones left out."""
    fs, jpath = _open(spark, path)
    held = fs.listStatus(jpath) if fs.exists(jpath) else []
    return [f.getLen() for f in held if f.getPath().getName().endswith(suffix) and f.getPath().getName()[0] not in "_."]


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file in UTF-8."""
    fs, jpath = _open(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small text file in one step, written beside and renamed; False if there is such a file already."""
    jvm = spark.sparkContext._jvm
    fs, jpath = _open(spark, path)
    parent, name = _siblings(path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{parent}/_{name}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    source, target = fs.makeQualified(beside), fs.makeQualified(jpath)
    try:
        if fs.getUri().getScheme() == "file":  # a local rename replaces, a hard link doesn't
            jvm.java.nio.file.Files.createLink(jvm.java.io.File(target.toUri().getPath()).toPath(), jvm.java.io.File(source.toUri().getPath()).toPath())
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(source, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception as exc:
        if "FileAlreadyExistsException" in str(exc):
            return False
        raise
    finally:
        fs.delete(beside, False)


def _siblings(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def previous_path(path: str) -> str:
    """Where a table's previous version lies for the moment of a swap."""
    parent, name = _siblings(path)
    return f"{parent}/_previous-{name}"


def recover(spark: SparkSession, path: str) -> None:
    """Undo a swap that stopped between its two renames: the previous version comes back."""
    if not exists(spark, path) and exists(spark, previous_path(path)):
        rename(spark, previous_path(path), path)


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished table ``new`` in the place of ``path``: two renames, then the old version goes."""
    recover(spark, path)
    old = previous_path(path)
    if exists(spark, path):
        delete(spark, old)
        rename(spark, path, old)
    rename(spark, new, path)
    delete(spark, old)


def new_path(path: str, run: str) -> str:
    """A sibling of ``path`` for a run's output, hidden from scans of the parent."""
    parent, name = _siblings(path)
    return f"{parent}/_new-{name}-{run}"
