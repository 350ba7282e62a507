"""Folders of a table: listed and removed through the file system that Spark itself uses for the path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names right below ``path``, sorted; none if it isn't there.  Names Spark passes over (``_`` and ``.``) are left out."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    found = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(n for n in found if n[0] not in "_.")


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the folders ``column=value`` right below ``path``."""
    head = f"{column}="
    return [n[len(head):] for n in names(spark, path) if n.startswith(head)]


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder and all below it; no error if it isn't there."""
    files, where = _at(spark, path)
    files.delete(where, True)
