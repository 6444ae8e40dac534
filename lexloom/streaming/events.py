"""Structured Streaming: files of records, each id once, counts, and an upsert for every batch."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener

from lexloom.operators.incremental import first_seen
from lexloom.sources.sinks import upsert_table


def arriving(spark: SparkSession, path: str, schema: str, fmt: str = "json", files_per_trigger: int = 100) -> DataFrame:
    """Records of files as they arrive in a folder; files must appear whole."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def once(stream: DataFrame, key: str, time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Each key once. With a time column, keys are forgotten after the delay, so that the state is bounded; without one they are kept for
    ever: for keys of which there are only so many."""
    if time:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def into_table(stream: DataFrame, path: str, checkpoint: str, key: str, order: str | None = None):
    """Upsert every batch into a table, whose touched folders alone are rewritten; stops when all that has arrived is done. Of a batch's
    rows of one key the last by order stays, or without one the greatest row. A batch that is repeated changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        upsert_table(batch, path, key, [order] if order else None)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def processed(stream: DataFrame, checkpoint: str, key: str, done: Callable[[], DataFrame], work: Callable[[DataFrame], DataFrame], harvest: Callable[[int, Row], None]) -> StreamingQuery:
    """Work on what arrives: done() gives the keys (in a column of the key's name) that are skipped, work(batch) rows of (key, ok), and
    harvest gets each batch's number and (processed, skipped, failed). Keys that a batch repeats are worked on once."""

    def each(batch: DataFrame, number: int) -> None:
        have = done().select(key).distinct().withColumn("_done", F.lit(True))
        rows = first_seen(batch, key, *batch.columns).join(have, key, "left").persist()
        try:
            skipped = rows.where("_done").count()
            result = work(rows.where("_done is null").drop("_done")).agg(F.count(F.when(F.col("ok"), 1)).alias("p"), F.count(F.when(~F.coalesce("ok", F.lit(False)), 1)).alias("f")).first()
        finally:
            rows.unpersist()
        harvest(number, Row(processed=result.p, skipped=skipped, failed=result.f))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Watch(StreamingQueryListener):
    """What Spark reports of one query: when rows last arrived, whether it has ended, and the sums of its observed metrics (observed()).

    A batch counts once, however often it is reported.
    """

    def __init__(self, run_id: str | None = None, name: str = "harvest") -> None:
        self.run_id, self.name = run_id, name
        self.changed, self.ended = threading.Condition(), False
        self.last, self.batches = time.time(), {}

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if self.run_id not in (None, str(p.runId)):
            return
        with self.changed:
            if p.numInputRows:
                self.last = time.time()
            if self.name in p.observedMetrics:
                self.batches[str(p.runId), p.batchId] = p.observedMetrics[self.name].asDict()
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if self.run_id in (None, str(event.runId)):
            with self.changed:
                self.ended = True
                self.changed.notify_all()

    def totals(self) -> dict[str, int]:
        out: dict[str, int] = {}
        with self.changed:
            for own in self.batches.values():
                for k, v in own.items():
                    out[k] = out.get(k, 0) + (v or 0)
        return out

    def wait(self, idle: float) -> bool:
        """Wait until no rows have arrived for so long (True), or the query has ended. Nothing is asked of the query meanwhile."""
        with self.changed:
            while not self.ended:
                left = self.last + idle - time.time()
                if left <= 0:
                    return True
                self.changed.wait(left)
        return False


def observed(stream: DataFrame, ok: Column, name: str = "harvest") -> DataFrame:
    """The stream, with counts of rows that are ok (processed), that are not (failed), and of which that is unknown (skipped), for a Watch."""
    return stream.observe(name, F.count(F.when(ok, 1)).alias("processed"), F.count(F.when(~ok, 1)).alias("failed"), F.count(F.when(ok.isNull(), 1)).alias("skipped"))


def stop_when_idle(query: StreamingQuery, seconds: float = 300) -> Watch:
    """Stop a running query when nothing has arrived for so long; return when it has ended. An error of the query is raised. The result has
    the sums of its observed metrics, as far as they were reported since."""
    spark = SparkSession.active()
    watch = Watch(str(query.runId))
    spark.streams.addListener(watch)
    try:
        if query.isActive and watch.wait(seconds):
            query.stop()
        query.awaitTermination()
    finally:
        spark.streams.removeListener(watch)
    if query.exception():
        raise query.exception()
    return watch


class _First(StatefulProcessor):
    """The first row of each key; a key is forgotten some time after it was seen."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "at long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        known = self.seen.exists()
        for frame in rows:
            if not known and len(frame):
                known = True
                self.seen.update((0,))
                yield frame.head(1)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.seen.update((0,))

    def close(self) -> None:
        pass


def first_of(stream: DataFrame, key: str, done: DataFrame | None = None, ttl: float | None = None) -> DataFrame:
    """The first row of each key that is not among the done ones (a table with a column of the key's name), whose keys begin the state of the
    first run. A key is forgotten ttl seconds after its row, so that the state is bounded by what arrives in that time; such a query looks for
    expired keys in batches without rows too, and so doesn't end by itself (stop_when_idle() ends it). Without ttl no key is forgotten. Which of a batch's rows of one key comes first is any. Needs the RocksDB state store (use_rocksdb())."""
    initial = None
    if done is not None:
        initial = done.select(F.col(key).alias(key)).where(F.col(key).isNotNull()).distinct().groupBy(key)
    return stream.groupBy(key).transformWithStateInPandas(statefulProcessor=_First(None if ttl is None else int(ttl * 1000)), outputStructType=stream.schema, outputMode="Append", timeMode="None" if ttl is None else "ProcessingTime", initialState=initial)


def use_rocksdb(spark: SparkSession) -> None:
    """State on the executors' disks, with checkpoints of what changed: for states larger than memory, and for first_of()."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def counts(stream: DataFrame, by: str) -> DataFrame:
    return stream.groupBy(by).agg(F.count("*").alias("n"))
