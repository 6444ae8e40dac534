"""Sources and sinks that must survive what goes wrong: keyed tables, growing files, services that fail, damaged records."""

import json
import os
import random
import time

import pytest
from pyspark.sql import Observation, functions as F
from pyspark.sql.types import StructType

from lexloom import jobs
from lexloom.operators import incremental as I
from lexloom.operators import roles
from lexloom.operators.tables import first_cells, table_values
from lexloom.sources import bulk, checked, files, keyed, services, sinks
from lexloom.streaming import tail


def rows_of(spark, path):
    return sorted(map(tuple, sinks.read_table(spark, path).collect()), key=repr)


def parts(path):
    return {f"{f.parent.name}/{f.name}": f.stat().st_mtime_ns for f in path.glob("rows/*/*.parquet")}


def test_upsert_rewrites_touched_folders_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_table(spark.range(1000).selectExpr("id as k", "'old' as v"), path, "k", buckets=50)
    before = parts(tmp_path / "t")
    touched = sinks.upsert_table(spark.createDataFrame([(i, "new") for i in range(0, 1000, 200)], "k int, v string"), path, "k")
    after = parts(tmp_path / "t")
    changed = {f.split("/")[0] for f in before.keys() ^ after.keys()}
    assert len(touched) <= 5 and changed == {f"_bucket={b}" for b in touched}
    assert all(before[f] == after[f] for f in before.keys() & after.keys()) and len(before.keys() & after.keys()) >= 45
    got = {r.k: r.v for r in sinks.read_table(spark, path).collect()}
    assert len(got) == 1000 and {k for k, v in got.items() if v == "new"} == set(range(0, 1000, 200))
    # Only touched folders are read: the scan of the old rows is pruned.
    plan = keyed._stored(spark, f"{path}/rows", sinks.read_table(spark, path).schema).where(F.col("_bucket").isin(touched))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan


def test_upsert_of_repeated_null_and_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_table(spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k long, v string"), path, "k")
    new = spark.createDataFrame([(1, "c", 1), (1, "b", 3), (1, "z", 2), (None, "m", 1), (3, None, 1)], "k int, v string, at int")
    sinks.upsert_table(new, path, "k", ["at"])
    assert rows_of(spark, path) == sorted([(1, "b", 3), (None, "m", 1), (2, "b", None), (3, None, 1)], key=repr)
    sinks.upsert_table(new, path, "k", ["at"])
    sinks.upsert_table(new.where("false"), path, "k")
    assert rows_of(spark, path) == sorted([(1, "b", 3), (None, "m", 1), (2, "b", None), (3, None, 1)], key=repr)
    with pytest.raises(ValueError, match="key"):
        sinks.upsert_table(new, path, "v")
    got = I.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string"), "k").collect()
    assert list(map(tuple, got)) == [(1, "c")]


def test_upsert_that_is_killed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.upsert_table(spark.createDataFrame([(i, "a") for i in range(20)], "k int, v string"), path, "k", buckets=4)
    dying = spark.createDataFrame([(1, "b")], "k int, v string").selectExpr("k", "if(k = 1, raise_error('gone'), v) as v")
    with pytest.raises(Exception, match="gone"):
        sinks.upsert_table(dying, path, "k")
    assert {v for _, v in rows_of(spark, path)} == {"a"}
    # Killed after the new folders were written, and before or while they are put in their place.
    new = spark.createDataFrame([(1, "b"), (99, "c")], "k int, v string")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        calls = []
        m.setattr(keyed, "finish", lambda *a: killed() if calls else calls.append(1))
        with pytest.raises(KeyboardInterrupt):
            sinks.upsert_table(new, path, "k")
    want = sorted([(i, "b" if i == 1 else "a") for i in range(20)] + [(99, "c")], key=repr)
    assert rows_of(spark, path) == want
    bucket = next(p for p in (tmp_path / "t" / "rows").iterdir() if p.name.startswith("_bucket") and (tmp_path / "t" / "pending").glob(f"*/merged/{p.name}"))
    for f in bucket.iterdir():
        f.unlink()
    touched = keyed._touched(spark, keyed._pending(spark, path) + "/merged")
    if int(bucket.name.split("=")[1]) in touched:
        assert rows_of(spark, path) == want
    sinks.upsert_table(spark.createDataFrame([(100, "d")], "k int, v string"), path, "k")
    assert not any((tmp_path / "t" / "pending").iterdir())


def test_upsert_into_a_replaced_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path)
    sinks.upsert_table(spark.createDataFrame([(2, "c")], "k int, v string"), path, "k")
    assert rows_of(spark, path) == [(1, "a"), (2, "c")] and not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]
    sinks.replace_table(sinks.read_table(spark, path).where("k = 2"), path)
    assert rows_of(spark, path) == [(2, "c")]
    sinks.upsert_table(spark.createDataFrame([(3, "d")], "k int, v string"), path, "k")
    assert rows_of(spark, path) == [(2, "c"), (3, "d")]


# --- growing files


def run_tail(spark, src, out, checkpoint, **how):
    q = tail.growing_records(spark, str(src), "k int, v string").writeStream.format("json").option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start(str(out))
    q.awaitTermination()
    return sorted((r.k, r.v) for r in spark.read.schema("k int, v string").json(str(out)).collect())


def test_lines_that_are_appended_arrive_once(spark, tmp_path):
    src, out, checkpoint = (tmp_path / x for x in ("src", "out", "cp"))
    src.mkdir()
    f = src / "a.jsonl"
    f.write_text('{"k": 1, "v": "é"}\n\n{"k": 2}\nnot json\n{"k": 3, "v": "ha')
    assert run_tail(spark, src, out, checkpoint) == [(1, "é"), (2, None)]
    with f.open("a") as g:
        g.write('lf"}\n{"k": 4}\n')
    (src / "b.jsonl").write_text('{"k": 5}\r\n')
    (src / "c.txt").write_text('{"k": 6}\n')
    # Another query with the same checkpoint: a restart.
    assert run_tail(spark, src, out, checkpoint) == [(1, "é"), (2, None), (3, "half"), (4, None), (5, None)]
    assert len(run_tail(spark, src, out, checkpoint)) == 5
    (src / "b.jsonl").write_text("")
    with f.open("a") as g:
        g.write('{"k": 7}\n')
    assert len(run_tail(spark, src, out, checkpoint)) == 6


def test_a_running_tail(spark, tmp_path):
    """Rows that are appended between batches of one running query."""
    f = tmp_path / "a.jsonl"
    f.write_text('{"k": 0}\n')
    q = tail.growing_records(spark, str(f), "k int").writeStream.format("memory").queryName("tail_test").trigger(processingTime="200 milliseconds").start()
    try:
        for k in range(1, 4):
            with f.open("a") as g:
                g.write(f'{{"k": {k}}}\n{{"half')
            q.processAllAvailable()
            with f.open("a") as g:
                g.write('": 1}\n')
            q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.k for r in spark.table("tail_test").where("k is not null").collect()) == [0, 1, 2, 3]


def test_ranges_of_lines(tmp_path):
    rnd = random.Random(1)
    data = "\n".join("x" * rnd.randint(0, 9) for _ in range(200)).encode() + b"\nrest"
    f = tmp_path / "f"
    f.write_bytes(data)
    with f.open("rb") as g:
        end = tail.whole_lines_end(g, len(data))
        assert end == len(data) - 4
        want = list(tail.lines(g, 0, end))
        for step in (1, 3, 7, 50):
            assert [x for at in range(0, end, step) for x in tail.lines(g, at, min(at + step, end))] == want
    assert [line for _, line in want] == data[:end].split(b"\n")[:-1]


# --- services


def test_bulk_sends_the_failed_again(spark, tmp_path):
    marks, failed = tmp_path / "marks", str(tmp_path / "failed")
    marks.mkdir()

    def put(rows, token):
        out = {}
        for r in rows:
            mark = marks / str(r.k)
            if r.k % 10 == 3:
                out[r.k] = "never"
            elif r.k % 10 == 5 and not mark.exists():
                mark.write_text(token)
                out[r.k] = "once"
        if any(r.k == 77 for r in rows):
            raise OSError("down")
        return out

    rows = spark.range(100).selectExpr("cast(id as int) as k").coalesce(2)
    got = bulk.bulk(rows, put, "k", failed, batch=7, attempts=2, delay=0.01)
    lost = {r.key: r.error for r in bulk.failed_rows(spark, failed).collect()}
    assert (got.total, got.failed) == (100, len(lost)) and {int(k) for k in lost} >= set(range(3, 100, 10)) and lost["3"] == "never" and lost["77"].startswith("OSError")
    assert got.success_rate == 100.0 - len(lost)
    assert tuple(bulk.bulk(rows.where("false"), put, "k", failed)) == (0, 0, 0, 0.0) and bulk.failed_rows(spark, failed).count() == len(lost)
    assert bulk.failed_rows(spark, str(tmp_path / "none")).count() == 0 and not list((tmp_path / "failed").glob("_staging*"))


def test_bulk_that_dies_adds_nothing(spark, tmp_path):
    failed = str(tmp_path / "failed")
    rows = spark.range(10).selectExpr("if(id = 9, raise_error('gone'), id) as k").coalesce(1)
    with pytest.raises(Exception, match="gone"):
        bulk.bulk(rows, lambda rows, token: [r.k for r in rows], "k", failed, batch=2, attempts=1)
    assert bulk.failed_rows(spark, failed).count() == 0 and not list((tmp_path / "failed").iterdir())


def test_bulk_of_very_many_failures(spark, tmp_path):
    """Failed keys are written by the tasks: the driver gets counts."""
    failed = str(tmp_path / "failed")
    got = bulk.bulk(spark.range(0, 200_000, 1, 8), lambda rows, token: [r.id for r in rows], "id", failed, batch=5000, attempts=1)
    assert got.failed == 200_000 == bulk.failed_rows(spark, failed).select("key").distinct().count() and len(list((tmp_path / "failed").glob("part-*"))) == 8


def test_probed(spark):
    def lookup(index, keys):
        assert len(keys) <= 50
        if index == "down":
            raise OSError(index)
        return {k for k in keys if k % 100 or index == "whole"}

    items = spark.range(1000).selectExpr("id as k", "element_at(array('most', 'down', 'whole'), cast(id % 3 as int) + 1) as i").unionByName(spark.createDataFrame([(None, "whole")], "k long, i string"))
    got = {r.i: tuple(r)[1:] for r in services.probed_coverage(services.probed(items, lookup, "k", "i", 50, 2, 0.01), by="i").collect()}
    assert got["down"] == (333, None, None, None) and got["most"] == (334, 330, 330 / 334, False) and got["whole"] == (334, 333, 333 / 334, True)


def test_paged(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def service(n, fail=()):
        def page(at, size):
            (calls / f"{at}-{time.time_ns()}").touch()
            if at in fail and len(list(calls.glob(f"{at}-*"))) < 2:
                raise OSError("busy")
            return [(i, f"t{i}") for i in range(at, min(at + size, n))]

        return page

    for n in (0, 1, 9, 10, 11, 20, 1234):
        assert services.length_of(lambda at, size, n=n: [None] * max(0, min(size, n - at)), first=10) == n
        assert sorted(map(tuple, services.paged(spark, "id long, term string", service(n), size=10).collect())) == [(i, f"t{i}") for i in range(n)]
    for f in calls.iterdir():
        f.unlink()
    assert services.paged(spark, "id long, term string", service(100, fail=(30,)), 100, 10, delay=0.01).count() == 100
    seen = []
    services.length_of(lambda at, size: seen.append(at) or at < 10**6, first=10)
    assert len(seen) < 45


def test_checked_files(spark, tmp_path):
    bad = {"a": '{"id": "1", "chunks": [1]}', "b": '[{"id": "2", "chunks": [1]}, {"id": "", "chunks": [1]}, {"id": "4", "chunks": []}]', "c": "", "d": " [] ", "e": '{"id": ', "f": '{"chunks": [2]}', "g": "[3]", "h": '{"id": "8", "chunks": "x"}', "i": "null"}
    for name, text in bad.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "k.json").write_text('{"id": "11", "chunks": [5]}')
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "l.json").write_text("x")
    (tmp_path / "j.json").write_bytes(b'{"id": "\xff"}')
    tries = tmp_path / "tries"
    tries.mkdir()

    def read(path):
        name = os.path.basename(path)
        (tries / f"{name}-{time.time_ns()}").touch()
        if name == "a.json" and len(list(tries.glob("a.json*"))) < 3:
            raise OSError("later")
        if name == "f.json":
            raise OSError("never")
        return files.file_bytes(path)

    schema = StructType.fromDDL("id string, chunks array<int>")
    seen = Observation()
    rows = checked.counted(checked.read_json(spark, str(tmp_path), schema, "id", "chunks", read=read, delay=0.01), seen).persist()
    got = sorted(((os.path.basename(r.path)[0], r.reason) for r in rows.collect()), key=str)
    assert got == [("a", None), ("b", "no chunks"), ("b", "no id"), ("b", None), ("c", "empty"), ("d", "empty"), ("e", "damaged"), ("f", "unreadable"), ("g", "damaged"), ("h", "damaged"), ("i", "empty"), ("j", "unreadable"), ("k", None)]
    assert sorted(r.id for r in checked.good(rows).collect()) == ["1", "11", "2"] and checked.rejects(rows).count() == 10
    assert seen.get == {"good": 3, "unreadable": 2, "empty": 3, "damaged": 3, "no_id": 1, "no_chunks": 1}
    assert len(list(tries.glob("f.json*"))) == 3


# --- pages, tables, inventories, models from outside


def test_pages_of_one_file_are_dealt_to_all_tasks(spark, tmp_path):
    """Each page carries the task that read it; order and failures are kept."""
    (tmp_path / "a.pdf").write_bytes(b"%PDF-" + b"x" * 2000)
    (tmp_path / "b.pdf").write_bytes(b"%PDF-bad" + b"x" * 2000)
    (tmp_path / "c.pdf").write_bytes(b"no pdf" * 1000)

    def recognise(content, i):
        from pyspark import TaskContext

        if i == 7:
            raise ValueError(i)
        return f"page {i} in task {TaskContext.get().partitionId()}."

    rows = files.pdf_page_texts(spark, str(tmp_path), lambda c: 1 / 0 if c.startswith(b"%PDF-bad") else 1000, recognise).persist()
    a = [r for r in rows.collect() if r.path.endswith("a.pdf")]
    assert sorted(r.page for r in a) == list(range(1000)) and [r.page for r in a if r.text is None] == [7]
    assert len({r.text.split()[-1] for r in a if r.text}) == max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    got = {r.path[-5:]: r for r in files.assembled(rows).collect()}
    assert set(got) == {"a.pdf", "b.pdf"} and got["b.pdf"].text is None and (got["a.pdf"].page_count, got["b.pdf"].page_count) == (1000, 0)
    assert [int(t.split()[1]) for t in got["a.pdf"].text.split("\n\n")] == [i for i in range(1000) if i != 7]


def test_cells_of_tables(spark):
    row = lambda *c: "<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"
    assert first_cells("<table>" + row("a", "1", "x") + row("b", "2") + row("c") + "</table>") == [("a", "1"), ("b", "2")]
    # Unclosed cells, rows and tables; head cells; tags in capitals; cells without a row.
    assert first_cells("<TABLE><TR><TH id=x>a<TD>1<TR><td>b</td> <td>2 <table><tr><td>c<td>3") == [("a", "1"), ("b", "2 <table><tr><td>c<td>3"), ("c", "3")]
    assert first_cells("<td>a</td><td>1</td>") == [("a", "1")] and first_cells("") == [] and first_cells("<table></table></table><tr><td>") == []
    # An inner table is no part of the label, but of the value.
    inner = "<table>" + row("number", "7") + "</table>"
    assert first_cells("<table>" + row(f"x{inner}y", "menu") + row("z", inner) + "</table>") == [("xy", "menu"), ("number", "7"), ("z", inner), ("number", "7")]
    pages = spark.createDataFrame([("<table>" + row(f"lay{inner}out", "wrong") + row("Act Year:", " 1950 ") + row("year", "1951") + "</table>",), (None,), ("<b>" * 1000,)], "h string")
    got = [tuple(r.v) for r in pages.select(table_values(F.col("h"), {"n": "Number", "y": "year", "none": "(.*"}).alias("v")).collect()]
    assert got == [("7", "1950", ""), ("", "", ""), ("", "", "")]
    began = time.time()
    first_cells("<td>" * 300_000 + "<table>" * 1000)
    assert time.time() - began < 20


def test_inventories_by_digest(spark, tmp_path):
    rows = [(y, f"n{i}") for y in (2020, 2021, 2022) for i in range(50)]
    old = spark.createDataFrame([*rows, (2020, "n1"), (2020, None)], "year int, name string")
    new = spark.createDataFrame([(y, n) for y, n in rows if (y, n) != (2021, "n7")] + [(2023, "x")], "year int, name string")
    for name, df in (("old", old), ("new", new)):
        sinks.write_inventory(df, str(tmp_path / name), "year", "name")
    a, b = (spark.read.parquet(str(tmp_path / n / "digests")) for n in ("old", "new"))
    assert sorted(r.year for r in I.changed_partitions(a, b, "year").collect()) == [2021, 2023]
    names = spark.read.parquet(str(tmp_path / "old" / "names"))
    assert names.count() == 150 and names.where("year = 2021").count() == 50
    one, two = (I.name_digests(old.where(f"name {c} 'n3'"), "year", "name").where("year = 2020").first() for c in ("<", ">="))
    both = a.where("year = 2020").first()
    assert int(one.digest) + int(two.digest) == int(both.digest) and one.file_count + two.file_count == both.file_count


def test_model_from_outside(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def make():
        def model(texts):
            (log / f"{time.time_ns()}").write_text(",".join(str(len(t)) for t in texts))
            return [[len(t.split()), t.count("a"), 2.0] for t in texts]

        return model

    rows = spark.createDataFrame([(i, "a b " * (i % 40)) for i in range(300)] + [(300, None), (301, "x " * 1000)], "i int, text string")
    got = {r.i: r for r in roles.classified(rows, make, ["x", "y", "z"], limit=10, batch=16).collect()}
    import numpy as np

    for i, r in got.items():
        words = 0 if i == 300 else 10 if i == 301 else min(10, 2 * (i % 40))
        logits = np.array([words, 0 if i >= 300 else words / 2, 2.0])
        p = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        assert r.predicted_role == "xyz"[int(np.argmax(p))] and r.confidence == round(p.max(), 4) and np.allclose([r.probabilities[k] for k in "xyz"], p, atol=1e-6)
    assert len(got) == 302
    for f in log.iterdir():
        sizes = list(map(int, f.read_text().split(",")))
        assert len(sizes) <= 16 and sizes == sorted(sizes)


def test_manifest_lines_and_statistics(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "year int, name string")
    assert {r.year: r["keys"] for r in sinks.manifest(rows, "year", "name").collect()} == {1: ["a", "b"], 2: []}
    path = str(tmp_path / "lines")
    sinks.append_lines(rows, path)
    sinks.append_lines(rows.where("year = 2"), path)
    assert sorted(((r.year, r.name) for r in spark.read.schema(rows.schema).json(path).collect()), key=str) == sorted([(1, "b"), (1, "a"), (1, "b"), (2, None), (2, None)], key=str)
    said = sinks.index_statistics(spark.createDataFrame([("x" * 2000,), ("y" * 2000,)], "t string")).first()
    assert (said.docs, said.kb_per_doc) == (2, round(said.bytes / 2 / 1024, 2)) and said.bytes == 2 * len('{"t":"' + "x" * 2000 + '"}')
    assert tuple(sinks.index_statistics(rows.where("false")).first())[0] == 0


def test_jobs_of_inventories_and_dictionaries(spark, tmp_path, capsys):
    src, out, index = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "index")
    for year, folder in ((2020, "year=2020"), (2021, "2021")):
        (src / folder).mkdir(parents=True)
        for i in range(4):
            (src / folder / f"d{year}{i}_all_chunks.json").write_text("[]")
    (src / "2021" / "other.json").write_text("[]")
    sinks.upsert_table(spark.createDataFrame([(f"d2020{i}",) for i in range(4)] + [("d20210",)], "doc_id string"), index, "doc_id")
    args = ["--job", "inventory", "--source", str(src), "--out", out]
    assert jobs.main(args, spark) == [{"year": y, "files": 4, "changed": True} for y in (2020, 2021)]
    (src / "2021" / "d20214_all_chunks.json").write_text("[]")
    got = jobs.main([*args, "--index", index], spark)
    assert got == [{"year": 2020, "files": 4, "changed": False, "indexed": 4, "ratio": 1.0, "uploaded": True}, {"year": 2021, "files": 5, "changed": True, "indexed": 1, "ratio": 0.2, "uploaded": False}]
    assert spark.read.parquet(f"{out}/coverage").count() == 2
    words = str(tmp_path / "words")

    def dictionary_service(at, size):
        return [(f"t{i}", f"term {i}", None, "" if i == 3 else f"what {i} means") for i in range(at, min(at + size, 25))]

    made = jobs.index_dictionary(spark, "id string, term string, pos string, definition string", dictionary_service, words, embed="hashed", size=10)
    rows = sinks.read_table(spark, words)
    assert made["uploaded"] == 24 == rows.count() and all(len(r.embedding) == 64 for r in rows.collect())
    assert jobs.index_dictionary(spark, "id string, term string, pos string, definition string", dictionary_service, words, embed="hashed", size=10)["uploaded"] == 0
    assert jobs.plug_in("lexloom.jobs:parser") is jobs.parser
    for wrong in (["--job", "dictionary"], ["--job", "index", "--source", "x"]):
        with pytest.raises(SystemExit):
            jobs.main(wrong, spark)
