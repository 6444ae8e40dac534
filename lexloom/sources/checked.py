"""Records of files that are read with patience and checked: none is lost without a reason that is counted."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from lexloom.sources.files import file_bytes, folders
from lexloom.sources.paths import place
from lexloom.sources.services import retried

#: Why a file or record is left out. Fixed values, in the order in which they are judged.
REASONS = ("unreadable", "empty", "damaged", "no id", "no chunks")
_CORRUPT = "_corrupt_record"


def file_paths(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """(path) of the files under a folder, empty ones too, which Spark's scans pass over: a task for each folder right under it. Names that
    begin with a mark of hidden files, _ or ., are left out with all that is below."""
    tops = [(path, False), *((f"{path}/{f}", True) for f in folders(spark, path) if f[0] not in "_.")]

    def each(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for top, deep in zip(frame.column("top").to_pylist(), frame.column("deep").to_pylist(), strict=True):
                where, root = place(top)
                scheme = top[: len(top) - len(root)] if top.endswith(root) else ""
                found = where.get_file_info(fs.FileSelector(root, recursive=deep, allow_not_found=True))
                own = [x.path for x in found if x.is_file and x.path.endswith(suffix) and not any(p[0] in "_." for p in x.path[len(root) :].split("/") if p)]
                yield pa.RecordBatch.from_arrays([pa.array([scheme + p for p in own], pa.string())], names=["path"])

    return spark.createDataFrame(tops, "top string, deep boolean").repartition(len(tops)).mapInArrow(each, "path string")


def contents(files: DataFrame, read: Callable[[str], bytes] = file_bytes, attempts: int = 3, delay: float = 2.0) -> DataFrame:
    """(path, content, error) of files (path): read by the tasks, one file at a time, again after delay, 2 * delay, ... seconds. What can't be
    read has its error, what isn't UTF-8 too."""

    def each(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for path in frame.column("path").to_pylist():
                content, error = None, None
                try:
                    content = retried(lambda p=path: read(p), attempts, delay).decode()
                except Exception as e:  # noqa: BLE001 - whatever a file system raises is a reason
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([content], pa.string()), pa.array([error], pa.string())], names=["path", "content", "error"])

    return files.select("path").mapInArrow(each, "path string, content string, error string")


def checked(files: DataFrame, schema: StructType, id_: str | None = None, chunks: str | None = None) -> DataFrame:
    """(path, record, reason, detail): a row for each record of contents(), an object or each of an array; and one for each file without.

    reason is null for good records. Files that can't be read, that hold nothing, or are no JSON of the schema have one row with their reason, and
    so have records whose id is null or empty, or without any chunks, if these columns are named.
    """
    wanted = StructType([*schema.fields]).add(_CORRUPT, StringType())
    text = F.trim("content")
    # Each record is parsed as one, so that a value of another type shows in it.
    each = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(text))
    rows = files.select("path", "error", text.rlike(r"^(|\[\s*\]|null)$").alias("_blank"), F.explode_outer(F.when(F.col("error").isNull(), each)).alias("_one"))
    rows = rows.withColumn("_r", F.from_json("_one", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    damaged: Column = F.col("_r").isNull() | F.col(f"_r.{_CORRUPT}").isNotNull()
    reason = F.when(F.col("error").isNotNull(), REASONS[0]).when(F.col("_blank"), REASONS[1]).when(damaged, REASONS[2])
    if id_:
        reason = reason.when(F.coalesce(F.col(f"_r.{id_}").cast("string"), F.lit("")) == "", REASONS[3])
    if chunks:
        reason = reason.when(F.coalesce(F.size(f"_r.{chunks}"), F.lit(0)) <= 0, REASONS[4])
    record = F.struct(*(F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields))
    return rows.select("path", F.when(reason.isNull(), record).alias("record"), reason.alias("reason"), F.coalesce("error", F.when(damaged, F.left("_one", F.lit(200)))).alias("detail"))


def good(rows: DataFrame) -> DataFrame:
    """The records that nothing is wrong with, and _source_file."""
    return rows.where("reason is null").select("record.*", F.col("path").alias("_source_file"))


def rejects(rows: DataFrame) -> DataFrame:
    return rows.where("reason is not null").select("path", "reason", "detail")


def counted(rows: DataFrame, seen: Observation) -> DataFrame:
    """checked() that says how many rows were good, and how many had each reason, when an action of its own frame has passed them."""
    return rows.observe(seen, F.count(F.when(F.col("reason").isNull(), 1)).alias("good"), *(F.count(F.when(F.col("reason") == r, 1)).alias(r.replace(" ", "_")) for r in REASONS))


def read_json(spark: SparkSession, path: str, schema: StructType, id_: str | None = None, chunks: str | None = None, suffix: str = ".json", **how) -> DataFrame:
    """checked() of all files under a path. To split it into good() and rejects() write it first: each reads all files otherwise."""
    return checked(contents(file_paths(spark, path, suffix), **how), schema, id_, chunks)
