"""Listing and removing folders through Spark's own file-system layer (any Hadoop path)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; empty if it is not there."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=value`` folders."""
    prefix = column + "="
    return [n[len(prefix):] for n in names(spark, path) if n.startswith(prefix)]


def remove(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder into place in one rename; what stands there already is an error."""
    fs, new = _open(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), new):
        raise OSError(f"cannot move {source} to {target}")


def rename(spark: SparkSession, source: str, target: str) -> bool:
    fs, old = _open(spark, source)
    return fs.rename(old, spark._jvm.org.apache.hadoop.fs.Path(target))


def touch(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.create(target, True).close()


def write_new(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small text file that appears whole; fails if it is there already.

    The draft is renamed without overwriting, which the file system decides in one step.
    """
    jvm = spark._jvm
    fs, target = _open(spark, f"{folder}/{name}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(draft, target, no_overwrite)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise FileExistsError(f"{folder}/{name}") from error
        raise
