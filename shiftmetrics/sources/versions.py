"""Numbered folders, of which only complete ones count.

A writer takes the next number, writes into its folder and marks it ready as
the last step.  Readers look at ready folders only, so a writer that is lost
on the way leaves what was there before as it was.  One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

READY = "_READY"


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    path, fs = _path(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[2:]) for n in names if n.startswith("n=") and n[2:].isdigit())


def folder(root: str, n: int) -> str:
    return f"{root}/n={n}"


def ready(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the complete folders, in order."""
    found = []
    for n in _numbers(spark, root):
        path, fs = _path(spark, f"{folder(root, n)}/{READY}")
        if fs.exists(path):
            found.append(n)
    return found


def names(spark: SparkSession, root: str, n: int) -> list[str]:
    """What lies in a folder."""
    path, fs = _path(spark, folder(root, n))
    return [s.getPath().getName() for s in fs.listStatus(path)]


def begin(spark: SparkSession, root: str) -> int:
    """A new number: larger than all, complete or not."""
    return max(_numbers(spark, root), default=0) + 1


def finish(spark: SparkSession, root: str, n: int) -> None:
    path, fs = _path(spark, f"{folder(root, n)}/{READY}")
    fs.create(path, True).close()


def drop(spark: SparkSession, root: str, numbers: list[int]) -> None:
    """Remove folders that nothing refers to any more."""
    for n in numbers:
        path, fs = _path(spark, folder(root, n))
        fs.delete(path, True)
