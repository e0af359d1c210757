"""Moving finished folders into place, through the Hadoop file system of the path."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system of the path, class of its paths)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, Path = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(Path(path))] if fs.exists(Path(path)) else []


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a table is laid out by, outermost first, from the names of its folders."""
    columns = []
    while folder := next((name for name in children(spark, path) if "=" in name), None):
        columns.append(folder.split("=", 1)[0])
        path = f"{path}/{folder}"
    return columns


def exists(spark: SparkSession, path: str) -> bool:
    fs, Path = file_system(spark, path)
    return fs.exists(Path(path))


def remove(spark: SparkSession, path: str) -> bool:
    fs, Path = file_system(spark, path)
    return fs.delete(Path(path), True)


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of another; the old one is kept until the new one is there.

    Two renames: short, but not atomic. A run that dies between them leaves `<target>.old-...`.
    """
    fs, Path = file_system(spark, target)
    if not fs.exists(Path(staged)):
        raise OSError(f"nothing at {staged} to move to {target}")
    old = f"{target}.old-{uuid.uuid4().hex}"
    fs.mkdirs(Path(target).getParent())
    had = fs.exists(Path(target))
    if had and not fs.rename(Path(target), Path(old)):
        raise OSError(f"cannot move {target} aside")
    moved = False
    try:
        moved = fs.rename(Path(staged), Path(target))
    finally:
        if not moved and had:
            fs.rename(Path(old), Path(target))
    if not moved:
        raise OSError(f"cannot move {staged} to {target}")
    if had:
        fs.delete(Path(old), True)
