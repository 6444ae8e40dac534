"""Folders and small files, wherever Spark can reach them."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def place(path: str) -> tuple[fs.FileSystem, str]:
    """For tasks, which have no JVM: the file system of a path or an address, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, p = file_system(spark, path)
    return hadoop.exists(p)


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, as a whole: written beside its place, and renamed to it when what stood there is gone."""
    hadoop, p = file_system(spark, path)
    _, part = file_system(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = hadoop.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    hadoop.delete(p, False)
    hadoop.rename(part, p)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())


def make_folder(spark: SparkSession, path: str) -> bool:
    hadoop, p = file_system(spark, path)
    return hadoop.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    hadoop, p = file_system(spark, path)
    return hadoop.delete(p, True)


def files_in(spark: SparkSession, path: str) -> list[str]:
    hadoop, p = file_system(spark, path)
    return [s.getPath().getName() for s in hadoop.listStatus(p)]
