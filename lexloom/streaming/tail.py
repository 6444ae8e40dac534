"""A stream of the lines that are appended to files: each whole line once, by the byte at which it begins, also after a restart."""

from __future__ import annotations

import io
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from lexloom.sources.paths import place

#: Bytes that one task reads, some more for its last line; and bytes that are read at once.
SPLIT, STEP = 64 << 20, 1 << 16


class Range(InputPartition):
    """Lines of a file that begin at start or after it, and before end."""

    def __init__(self, file: str, start: int, end: int) -> None:
        self.file, self.start, self.end = file, start, end


def whole_lines_end(f, size: int, least: int = 0) -> int:
    """The byte after the last line that has its end, from `least` on: what follows may still be written to."""
    at = size
    while at > least:
        begin = max(least, at - STEP)
        f.seek(begin)
        found = f.read(at - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        at = begin
    return least


def lines(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(byte, line) of the lines of a range. A range that begins inside a line leaves that to the one before."""
    at = start
    if start:
        f.seek(start - 1)
        if f.read(1) != b"\n":
            at += len(f.readline())
    else:
        f.seek(0)
    while at < end and (own := f.readline()):
        yield at, own.rstrip(b"\r\n")
        at += len(own)


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, suffix: str, split: int) -> None:
        self.path, self.suffix, self.split = path, suffix, split
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's name
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        where, root = place(self.path)
        own = where.get_file_info(root)
        for info in [own] if own.is_file else where.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.is_file and info.path.endswith(self.suffix):
                have = self.known.get(info.path, 0)
                if info.size > have:
                    with where.open_input_file(info.path) as f:
                        self.known[info.path] = whole_lines_end(f, info.size, have)
        return dict(sorted(self.known.items()))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._learn(start)
        out = []
        for file, last in end.items():
            first = int(start.get(file, 0))
            out += [Range(file, at, min(at + self.split, int(last))) for at in range(first, int(last), self.split)]
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        where, _ = place(self.path)
        with where.open_input_file(partition.file) as f:
            # Buffered, so that a line is no call of the file system.
            for at, line in lines(io.BufferedReader(f, 1 << 20), partition.start, partition.end):
                yield partition.file, at, line.decode(errors="replace")

    def commit(self, end: dict) -> None:
        self._learn(end)

    def _learn(self, offsets: dict) -> None:
        """Offsets never go back: after a restart those of the checkpoint are known again."""
        for file, at in offsets.items():
            self.known[file] = max(self.known.get(file, 0), int(at))


class Tail(DataSource):
    """Options: path (a folder, or one file), suffix, split."""

    @classmethod
    def name(cls) -> str:
        return "lexloom_tail"

    def schema(self) -> str:
        return "file string, at long, line string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return _Reader(self.options["path"], self.options.get("suffix", ".jsonl"), int(self.options.get("split", SPLIT)))


def growing_lines(spark: SparkSession, path: str, suffix: str = ".jsonl", split: int = SPLIT) -> DataFrame:
    """(file, at, line) of the files under a path as they grow. A line without its end waits for it; a file that shrinks or goes
    has no more lines until it is longer than before."""
    spark.dataSource.register(Tail)
    return spark.readStream.format("lexloom_tail").option("suffix", suffix).option("split", split).load(path)


def growing_records(spark: SparkSession, path: str, schema: str, suffix: str = ".jsonl") -> DataFrame:
    """Records of JSON lines as they are appended, with _file and _at; blank and damaged lines are left out."""
    rows = growing_lines(spark, path, suffix)
    parsed = F.from_json("line", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    fine = rows.where(F.trim("line") != "").withColumn("r", parsed).where("r is not null and r._corrupt is null")
    return fine.select("r.*", F.col("file").alias("_file"), F.col("at").alias("_at")).drop("_corrupt")
