"""Rows sent to a service by Spark's tasks, as a sink with commit and abort: what fails becomes a table of its own."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from lexloom.sources.paths import delete, exists, make_folder, place, read_text

#: Failed rows that a task holds before it writes them.
HELD = 10_000
_FAILED = pa.schema([("key", pa.string()), ("error", pa.string())])


class Sent(WriterCommitMessage):
    """What one task sent: counts, and its file of failed rows, if any."""

    def __init__(self, ok: int, failed: int, file: str | None) -> None:
        self.ok, self.failed, self.file = ok, failed, file


class Sender:
    """Batches to a service: what fails is tried again after delay, 2 * delay, ... seconds, only the failed rows of a batch."""

    def __init__(self, put: Callable, key: str, batch: int, attempts: int, delay: float) -> None:
        self.put, self.key, self.batch, self.attempts, self.delay = put, key, batch, attempts, delay

    def send(self, rows: list[Row], token: str) -> list[tuple[str, str]]:
        """(key, error) of the rows that failed at last."""
        left, errors = rows, {}
        for attempt in range(self.attempts):
            if attempt:
                time.sleep(self.delay * 2 ** (attempt - 1))
            try:
                failed = self.put(left, f"{token}-{attempt}")
                errors = dict(failed) if isinstance(failed, dict) else dict.fromkeys(failed or (), "refused")
            except Exception as e:  # noqa: BLE001 - whatever a client raises, the batch is tried again
                errors = {r[self.key]: f"{type(e).__name__}: {e}" for r in left}
            left = [r for r in left if r[self.key] in errors]
            if not left:
                break
        return [(str(r[self.key]), errors[r[self.key]]) for r in left]


class _Writer(DataSourceWriter):
    def __init__(self, sender: Sender, failed: str, job: str) -> None:
        self.sender, self.failed, self.job = sender, failed, job

    def write(self, iterator: Iterator[Row]) -> Sent:
        task = TaskContext.get()
        part, sent, lost, rows, number = task.partitionId(), 0, 0, [], 0
        name = f"part-{self.job}-{part:06d}-{task.attemptNumber()}.parquet"
        where, root = place(self.failed)
        writer, held = None, []

        def spill() -> None:
            nonlocal writer, held
            if held:
                writer = writer or pq.ParquetWriter(f"{root}/_staging-{self.job}/{name}", _FAILED, filesystem=where)
                writer.write_table(pa.Table.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], schema=_FAILED))
                held = []

        def flush() -> None:
            nonlocal sent, lost, number, rows, held
            # The token says which rows these are: a task that runs again sends the same batches under the same tokens.
            bad = self.sender.send(rows, f"{self.job}-{part}-{number}")
            sent, lost, number, rows, held = sent + len(rows) - len(bad), lost + len(bad), number + 1, [], held + bad
            if len(held) >= HELD:
                spill()

        for row in iterator:
            rows.append(row)
            if len(rows) >= self.sender.batch:
                flush()
        if rows:
            flush()
        spill()
        if writer:
            writer.close()
        return Sent(sent, lost, name if writer else None)

    def commit(self, messages: list[Sent | None]) -> None:
        where, root = place(self.failed)
        done = [m for m in messages if m is not None]
        for m in done:
            if m.file:
                where.move(f"{root}/_staging-{self.job}/{m.file}", f"{root}/{m.file}")
        with where.open_output_stream(f"{root}/summary-{self.job}.json") as f:
            f.write(json.dumps({"ok": sum(m.ok for m in done), "failed": sum(m.failed for m in done)}).encode())
        where.delete_dir(f"{root}/_staging-{self.job}")

    def abort(self, messages: list[Sent | None]) -> None:
        where, root = place(self.failed)
        where.delete_dir(f"{root}/_staging-{self.job}")


def bulk(rows: DataFrame, put: Callable[[list[Row], str], Iterable | dict | None], key: str, failed: str, batch: int = 500, attempts: int = 3, delay: float = 2.0) -> Row:
    """(total, uploaded, failed, success_rate): rows sent to a service in batches by the tasks.

    put gets a batch and its token, and gives the keys that failed, or a map of these to errors; these are sent again. An exception
    fails the whole batch. What fails at last is added to the table at `failed`, which failed_rows() reads, when the job is done; a job that dies adds
    nothing. put must be idempotent by key, or by the token without what follows its last dash: a task that is lost runs again with the same rows, if their order is fixed.
    """
    spark, job = rows.sparkSession, uuid.uuid4().hex[:12]
    sender = Sender(put, key, batch, attempts, delay)
    make_folder(spark, f"{failed}/_staging-{job}")

    class Bulk(DataSource):
        @classmethod
        def name(cls) -> str:
            return "lexloom_bulk"

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return _Writer(sender, failed, job)

    spark.dataSource.register(Bulk)
    rows.write.format("lexloom_bulk").mode("append").save()
    said = json.loads(read_text(spark, f"{failed}/summary-{job}.json"))
    delete(spark, f"{failed}/summary-{job}.json")
    total = said["ok"] + said["failed"]
    return Row(total=total, uploaded=said["ok"], failed=said["failed"], success_rate=100.0 * said["ok"] / total if total else 0.0)


def failed_rows(spark: SparkSession, failed: str) -> DataFrame:
    """(key, error) of all rows that bulk() could not send; none if there is no such table."""
    schema = "key string, error string"
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(failed) if exists(spark, failed) else spark.createDataFrame([], schema)
