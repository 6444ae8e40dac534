"""Tables that cut lineage: written to the folder that every executor shares, then read again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_own: list[str] = []
_folders: set[str] = set()
#: Paths of tables that were written inside scratch(), the innermost last.
_made: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one of our own only where that is unset (local tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="lexloom-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path for one table that nothing else uses, in a folder of this application, which is deleted when the driver ends."""
    folder = f"{shared_dir(spark)}/lexloom/{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_clean, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _clean(spark: SparkSession, folder: str) -> None:
    """What can still be deleted: with a session that was stopped, only folders of this machine's file system."""
    try:
        _delete(spark, folder)
    except Exception:  # noqa: BLE001 - the session, or its JVM, may be gone
        if folder.startswith("file:"):
            shutil.rmtree(folder.removeprefix("file:"), ignore_errors=True)


def keep(df: DataFrame, name: str, *, lasting: bool = False) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back, so that a lost executor costs no recomputation. Inside scratch()
    a table that is not lasting is deleted at its end."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if _made and not lasting:
        _made[-1].append(path)
    df.write.parquet(path)
    pa.default_memory_pool().release_unused()  # what the driver has gathered before, and needs no more
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end all tables that keep() wrote in it, but the lasting ones: what is still to be read must have been kept as such."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, at: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table that keep() wrote and that nothing reads any more."""
    for at in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, at)


def row_key(doc_id: str, text: str) -> Column:
    """128 bits that stand for a row's id and text; a null text is as an empty one."""
    said = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    return F.unhex(F.md5(F.concat_ws(":", F.col(doc_id).cast("long").cast("string"), said).cast("binary")))
