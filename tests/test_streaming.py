"""Streams with state that is bounded and begins from what is done, and that are watched without polling."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from lexloom.streaming import events as E


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    E.use_rocksdb(spark)
    yield
    spark.conf.set(name, before)


def write(path, *keys):
    path.write_text("\n".join(json.dumps({"k": k, "v": f"v{k}"}) for k in keys))


def test_first_of_each_key_that_is_not_done(spark, tmp_path, rocksdb):
    src, out, checkpoint = (tmp_path / x for x in ("src", "out", "cp"))
    src.mkdir()
    done = spark.createDataFrame([("b",), ("b",), (None,)], "k string")

    def run():
        stream = E.first_of(E.arriving(spark, str(src), "k string, v string"), "k", done)
        stream.writeStream.format("json").option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start(str(out)).awaitTermination()
        return sorted(r.k or "" for r in spark.read.schema("k string, v string").json(str(out)).collect())

    write(src / "1.json", "a", "b", "a", "c", None)
    assert run() == ["", "a", "c"]
    # A restart: what was seen and what was done is still known.
    write(src / "2.json", "b", "c", "d", "d", None)
    assert run() == ["", "a", "c", "d"]


def test_keys_are_forgotten(spark, tmp_path, rocksdb):
    src = tmp_path / "src"
    src.mkdir()
    stream = E.first_of(E.arriving(spark, str(src), "k string, v string"), "k", ttl=15)
    q = stream.writeStream.format("memory").queryName("ttl_test").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="100 milliseconds").start()
    count = lambda n: next((True for _ in range(300) if spark.table("ttl_test").count() >= n or time.sleep(0.1)), False)
    rows = lambda: q.lastProgress["stateOperators"][0]["numRowsTotal"]
    try:
        write(src / "1.json", "a", "b", "c")
        assert count(3)
        write(src / "2.json", "a", "d")
        assert count(4) and spark.table("ttl_test").count() == 4
        assert next((True for _ in range(400) if rows() == 0 or time.sleep(0.1)), False)
        write(src / "3.json", "a")
        assert count(5)
    finally:
        q.stop()
    assert sorted(r.k for r in spark.table("ttl_test").collect()) == ["a", "a", "b", "c", "d"]


def test_watch_stops_an_idle_query_and_counts_its_rows(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    write(src / "1.json", *"aabc")
    stream = E.observed(E.arriving(spark, str(src), "k string, v string"), F.when(F.col("k") != "c", F.col("k") == "a"))
    q = stream.writeStream.format("memory").queryName("watch_test").trigger(processingTime="200 milliseconds").start()
    later = threading.Timer(2.5, lambda: write(src / "2.json", *"abcc"))
    later.start()
    began = time.time()
    watch = E.stop_when_idle(q, seconds=6)
    later.join()
    assert not q.isActive and time.time() - began >= 8 and spark.table("watch_test").count() == 8
    assert watch.totals() == {"processed": 3, "failed": 2, "skipped": 3}


def test_watch_of_a_query_that_fails(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    q = E.arriving(spark, str(src), "k string").selectExpr("if(k = 'x', raise_error('gone'), k) as k").writeStream.format("memory").queryName("fail_test").trigger(processingTime="200 milliseconds").start()
    threading.Timer(1.5, lambda: write(src / "1.json", "x")).start()
    with pytest.raises(Exception, match="gone"):
        E.stop_when_idle(q, seconds=60)
