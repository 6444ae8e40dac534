"""Services asked in batches by Spark's tasks: which keys exist, and rows that they give by offset."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def retried(call: Callable, attempts: int, delay: float):
    """call(), again after delay, 2 * delay, ... seconds when it raises; the last error is raised."""
    for attempt in range(attempts):
        try:
            return call()
        except Exception:  # noqa: BLE001 - whatever a client raises
            if attempt + 1 == attempts:
                raise
            time.sleep(delay * 2**attempt)
    return None


def probed(items: DataFrame, lookup: Callable[[str, list], set], key: str, index: str, batch: int = 500, attempts: int = 3, delay: float = 2.0, name: str = "found") -> DataFrame:
    """(index, key, found) of items: lookup(index, keys) gives those of up to `batch` keys that the index has. A batch that fails at
    last has null. Keys of several indexes may come mixed; a task holds one batch of each. A null key is never found."""
    kinds = dict(items.select(key, index).dtypes)

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict = {}

        def answer(of) -> pa.RecordBatch:
            keys = waiting.pop(of)
            try:
                have = retried(lambda: set(lookup(of, keys)), attempts, delay)
                found = [k in have for k in keys]
            except Exception:  # noqa: BLE001 - the batch's answer is unknown
                found = [None] * len(keys)
            return pa.RecordBatch.from_arrays([pa.array([of] * len(keys), frame.schema.field(index).type), pa.array(keys, frame.schema.field(key).type), pa.array(found, pa.bool_())], names=[index, key, name])

        for frame in frames:
            for of, k in zip(frame.column(index).to_pylist(), frame.column(key).to_pylist(), strict=True):
                own = waiting.setdefault(of, [])
                own.append(k)
                if len(own) >= batch:
                    yield answer(of)
        for of in list(waiting):
            yield answer(of)

    asked = items.where(F.col(key).isNotNull()).select(index, key).mapInArrow(ask, f"`{index}` {kinds[index]}, `{key}` {kinds[key]}, `{name}` boolean")
    return asked.unionByName(items.where(F.col(key).isNull()).select(index, key, F.lit(False).alias(name)))


def probed_coverage(items: DataFrame, found: str = "found", by: str = "index", least: float = 0.99) -> DataFrame:
    """(by, total, found, ratio, uploaded) of probed(): ratio is null, and so is uploaded, where an answer is unknown."""
    known = F.count(found) == F.count("*")
    out = items.groupBy(by).agg(F.count("*").alias("total"), F.when(known, F.count(F.when(F.col(found), 1))).alias("found"))
    ratio = F.col("found") / F.col("total")
    return out.select(by, "total", "found", ratio.alias("ratio"), (ratio >= least).alias("uploaded"))


def length_of(fetch_page: Callable[[int, int], list], attempts: int = 3, delay: float = 2.0, first: int = 1000) -> int:
    """How many rows a service has that gives them by offset, by asking for single rows: doubling until there is none, then halving. Some
    2 * log2(rows) calls."""
    has = lambda at: bool(retried(lambda: fetch_page(at, 1), attempts, delay))
    if not has(0):
        return 0
    low, high = 0, first
    while has(high):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if has(middle) else (low, middle)
    return high


class _Pages(DataSourceReader):
    """Pages of a service, a task each; those of an unknown total are found when the scan is planned."""

    def __init__(self, fetch_page: Callable[[int, int], list[tuple]], size: int, total: int | None, attempts: int, delay: float) -> None:
        self.fetch_page, self.size, self.total, self.attempts, self.delay = fetch_page, size, total, attempts, delay

    def partitions(self) -> list[InputPartition]:
        total = length_of(self.fetch_page, self.attempts, self.delay, self.size) if self.total is None else self.total
        return [InputPartition(at) for at in range(0, total, self.size)] or [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from (tuple(r) for r in retried(lambda: self.fetch_page(partition.value, self.size), self.attempts, self.delay))


def paged(spark: SparkSession, schema: str, fetch_page: Callable[[int, int], list[tuple]], total: int | None = None, size: int = 1000, attempts: int = 3, delay: float = 2.0) -> DataFrame:
    """The rows of a service that gives them by offset: fetch_page(offset, size), a task for each page. Without a total the last page is
    found first, and all are read in parallel. Calls that fail are tried again inside the task."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return "lexloom_paged"

        def schema(self) -> str:
            return schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Pages(fetch_page, size, total, attempts, delay)

    spark.dataSource.register(Paged)
    return spark.read.format("lexloom_paged").load()
