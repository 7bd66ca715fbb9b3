"""The few directory operations Spark's readers do not offer, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def child_directories(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, full path) of the directories directly below ``path``."""
    fs, p = _path(spark, path)
    return [
        (status.getPath().getName(), status.getPath().toString())
        for status in fs.listStatus(p)
        if status.isDirectory()
    ]


def delete_directory(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def delete_files(spark: SparkSession, uris: list[str]) -> None:
    """Delete files by the names that Spark gives its rows, which are encoded as URIs."""
    for uri in uris:
        p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)
