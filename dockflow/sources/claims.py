"""Names that one writer alone can take: empty files, created only if absent.

On the local file system and on HDFS creation is exclusive. An object store must offer the same
(a conditional put); one that silently replaces a file is not safe for writers at the same time.
"""

from __future__ import annotations

import os
from itertools import count

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    system, target = _file(spark, path)
    system.mkdirs(target.getParent())
    if system.getScheme() == "file":
        try:
            with open(os.fspath(system.makeQualified(target).toUri().getPath()), "x"):
                return True
        except FileExistsError:
            return False
    try:
        system.create(target, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or system.exists(target):
            return False
        raise
    return True


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers that were created in a folder, ascending; none if there is no folder."""
    system, target = _file(spark, folder)
    if not system.exists(target):
        return []
    names = [str(status.getPath().getName()) for status in system.listStatus(target)]
    return sorted(int(name) for name in names if name.isdigit())


def claim(spark: SparkSession, folder: str, least: int = 1) -> int:
    """A number of ``least`` or more that nobody else has or will have."""
    first = max([least, *(n + 1 for n in numbers(spark, folder)[-1:])])
    return next(n for n in count(first) if create_once(spark, f"{folder}/{n}"))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file; None if the file is empty."""
    system, target = _file(spark, path)
    stream = spark._jvm.java.io.InputStreamReader(system.open(target), "UTF-8")
    reader = spark._jvm.java.io.BufferedReader(stream)
    try:
        return reader.readLine()
    finally:
        reader.close()
