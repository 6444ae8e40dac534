"""Operators against plain Python, at their borders."""

import json
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexloom import jobs
from lexloom.config import Settings
from lexloom.functions import text as T, values, vectors as V
from lexloom.operators import acts, chunking, incremental as I, language, pages as P, records as R, roles, select as S
from lexloom.sources import files, sinks
from lexloom.streaming import events as E


def value(spark, column, **columns):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return df.select(column.alias("x")).first().x


def model_groups(sims, th, mn, mx, roles=None):
    out, cur, role = [], 1, roles[0] if roles else None
    for i, s in enumerate(sims, 1):
        changed = bool(roles) and roles[i] != role
        if (s < th or cur >= mx or changed) and cur >= mn:
            out.append(cur)
            cur, role = 1, roles[i] if roles else None
        else:
            cur += 1
    if cur < mn and out:
        out[-1] += cur
    else:
        out.append(cur)
    return out


def test_groups(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        n = rnd.randint(1, 30)
        rows.append((i, [rnd.random() for _ in range(n - 1)], [rnd.choice("abc") for _ in range(n)]))
    df = spark.createDataFrame(rows, "i int, sims array<double>, roles array<string>")
    got = df.select("i", chunking.group_lengths("sims", 0.4, 3, 10).alias("a"), chunking.group_lengths("sims", 0.4, 3, 10, "roles").alias("b")).collect()
    for r in got:
        _, sims, roles = rows[r.i]
        assert r.a == model_groups(sims, 0.4, 3, 10)
        assert r.b == model_groups(sims, 0.4, 3, 10, roles)


def model_weighted(rows, k, weights):
    """rows: (pos, role, sim) in order."""
    if k <= 0 or not rows:
        return set()
    if len(rows) <= k:
        return {r[0] for r in rows}
    w = lambda r: round(10 * weights.get(r, 1.0))
    by = {}
    for p, r, s in rows:
        by.setdefault(r or "Others", []).append((p, s or 0.0))
    for r in by:
        by[r].sort(key=lambda x: (-x[1], x[0]))
    active = [r for r in by if w(r) > 0]
    total = sum(len(by[r]) * w(r) for r in active)
    if not total:
        return {p for p, _, s in sorted(rows, key=lambda x: (-(x[2] or 0), x[0]))[:k]}
    kept, rest = set(), []
    for o, r in enumerate(active):
        q = min(len(by[r]), k * len(by[r]) * w(r) // total)
        kept |= {p for p, _ in by[r][:q]}
        rest += [(-s, o, n, p) for n, (p, s) in enumerate(by[r]) if n >= q]
    return kept | {x[3] for x in sorted(rest)[: k - len(kept)]}


def test_weighted_top_k(spark):
    rnd = random.Random(6)
    weights = {"a": 3.0, "b": 0.4, "c": 0.0}
    rows = [(d, p, rnd.choice(["a", "b", "c", "x", None]) if d % 5 else "c", rnd.choice([0.0, 0.5, 1.0, None])) for d in range(200) for p in range(rnd.randint(1, 14))]
    df = spark.createDataFrame(rows, "doc int, pos int, role string, sim double")
    got = {}
    for r in S.weighted_top_k(df, 4, weights).collect():
        got.setdefault(r.doc, set()).add(r.pos)
    for d in range(200):
        assert got.get(d, set()) == model_weighted([r[1:] for r in rows if r[0] == d], 4, weights), d
    plan = S.weighted_top_k(df, 4, weights)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_clean_text_borders(spark):
    raw = "THE supreme court reports 12) (A.B. SINGH, J.) keep (2019 AIR 12) inter-  national\x85 x"
    assert value(spark, T.clean(F.col("t")), t=raw) == "keep international x"
    assert value(spark, T.sentences(F.col("t")), t="One two. three! Four? 'Five' Six.  Seven") == ["One two. three!", "Four? 'Five' Six.", "Seven"]
    assert value(spark, T.act_slug(F.col("t")), t="0012/7") == "CA_12_7"
    assert value(spark, T.file_name(F.col("t")), t='a<b>:"/\\|?*  c') == "a_b________ c"
    assert [value(spark, T.year(F.col("t")), t=f"in {y} x") for y in (1799, 1800, 2029, 2030)] == [None, 1800, 2029, None]
    assert value(spark, T.document_id(F.col("t")), t="app/raw/X y-z/a.json") == "x_y_z_a"
    assert len(value(spark, T.document_id(F.col("t")), t="q/" + "a" * 300 + "/b.json")) == 10
    assert value(spark, T.first_filled(F.col("a"), F.col("b")), a="", b="z") == "z"
    assert value(spark, T.finite(F.col("a")), a=float("-inf")) == 0.0


def test_runs_of_three_characters_take_linear_time(spark):
    texts = ["", None, "a", "ab", "ab1c", "Ünï \U00010428x", "x" * 5000]
    runs = language._runs(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text", 2000)
    for r in runs.collect():
        plain = " " + re.sub(r"[\d ]+", " ", (r.text or "")[:2000]).lower() + " "
        assert r._grams == [plain[i : i + 3] for i in range(max(1, len(plain) - 2))], r.text
    # A substring by place inside the loop over places would count from the text's beginning each time.
    assert "substring(_plain" not in runs._jdf.queryExecution().analyzed().toString()


def test_blocks_of_chunking_are_bounded():
    rnd = random.Random(5)
    rows = [(i, "x" * rnd.choice([0, 5, 90_000, 3_000_000]), ["s"] * rnd.choice([1, 3, 1500, 9000])) for i in range(300)]
    frame = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["doc_id", "cleaned", "s"])
    parts = [p.to_pylist() for p in chunking.blocks(frame)]
    assert [r["doc_id"] for p in parts for r in p] == list(range(300))
    assert all(len(p) == 1 or sum(len(r["s"]) for r in p) <= chunking.BATCH and sum(len(r["cleaned"]) for r in p) <= chunking.BATCH_BYTES for p in parts)
    assert len(parts) < 300


def test_sentences_keep_digits(spark):
    own = ["0 is first. ", "1 one 1. ", "Q. "] + [f"A{i} is {i}. " for i in range(3, 12)] + ["Ends in 12"]
    own = [s if s[0].isupper() else "N" + s for s in own]
    assert value(spark, T.sentences(F.col("t")), t="".join(own)) == [s.strip() for s in own]
    assert value(spark, T.sentences(F.col("t")), t="whou. 4072374829496490") == ["whou. 4072374829496490"]


def test_halves_are_rounded_as_in_sql(spark):
    assert V.rounded([0.28125, 0.21875, -0.28125, 0.28124, 1.0, 0.0]).tolist() == [0.2813, 0.2188, -0.2813, 0.2812, 1.0, 0.0]
    # 9 of 4 * 8 common: the half of 0.28125 goes up, whatever length the vectors are brought to before.
    texts = ["".join(f"{a} " * n for a, n in one) for one in ((("a", 3), ("b", 2), ("c", 1), ("d", 1), ("e", 1)), (("a", 3), ("f", 5), ("g", 4), ("h", 3), ("i", 2), ("j", 1)))]
    counts = V.hashed_counts(texts)
    assert len(set(np.flatnonzero(counts.any(axis=0)))) == 10
    assert V.rounded(V.row_cosines(counts[:1], counts[1:])).tolist() == [0.2813]
    docs = spark.createDataFrame([(1, "A" + texts[0][1:-1] + ". A" + texts[1][1:])], "doc_id int, text string")
    (row,) = chunking.semantic_chunks(docs, threshold=0.1, least=2, min_chars=1).collect()
    assert (row.num_sentences, row.avg_similarity) == (2, 0.2813)


def test_places():
    at, found = 0, []
    for chunk, first in (("b c", "b"), ("zz", "c"), ("q", "q")):
        found.append(chunking.place("a b c b c d", chunk, first, at))
        at = found[-1] + len(chunk)
    assert found == [2, 8, 10]


def test_chunks_by_definition(spark):
    rnd = random.Random(8)
    described = {"x": ["alpha beta"], "y": ["gamma"], "z": ["delta alpha"]}
    texts = ["", None, "One.", *("".join(" ".join(rnd.choice("alpha beta gamma delta Omega".split()) for _ in range(rnd.randint(1, 6))).capitalize() + rnd.choice([". ", "! ", ".  "]) for _ in range(rnd.randint(1, 40))) for _ in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for roles_ in (None, described):
        got = {}
        for r in chunking.semantic_chunks(docs, threshold=0.6, least=2, most=5, min_chars=20, roles=roles_).collect():
            got.setdefault(r.doc_id, []).append(r)
        for i, t in enumerate(texts):
            clean = re.sub(r"\s+", " ", t or "").strip()
            own = [x for x in re.split(r"(?<=[.!?])\s+(?=[A-Z])", clean) if x]
            v = V.hashed_embedding(own) if own else np.zeros((0, 64))
            sims = [float(a @ b) for a, b in zip(v, v[1:])]
            named = None
            if roles_:
                centers = V.hashed_embedding([" ".join(d) for d in roles_.values()])
                named = [list(roles_)[int((centers @ x).argmax())] for x in v]
            want, at, cursor = [], 0, 0
            for n in model_groups(sims, 0.6, 2, 5, named) if own else []:
                text = " ".join(own[at : at + n])
                if len(text) >= 20:
                    start = clean.find(text, cursor)
                    cursor = start + len(text)
                    mean = round(sum(sims[at : at + n - 1]) / (n - 1), 4) if n > 1 else 1.0
                    want.append((len(want) + 1, text, n, mean, start, cursor, round(float(V.hashed_embedding([text])[0] @ V.hashed_embedding([clean])[0]), 4), *(chunking.dominant(named[at : at + n]) if named else (None, None, None))))
                at += n
            assert [(r.chunk_id, r.text, r.num_sentences, r.avg_similarity, r.start_char, r.end_char, r.doc_similarity, r.dominant_role, r.role_distribution) for r in got.get(i, [])] == [w[:-1] for w in want], i


def test_grouping_in_python():
    rnd = random.Random(3)
    for _ in range(500):
        n = rnd.randint(1, 30)
        sims, named = [rnd.random() for _ in range(n - 1)], [rnd.choice("ab") for _ in range(n)]
        assert chunking.grouped(sims, 0.4, 3, 9) == model_groups(sims, 0.4, 3, 9) and chunking.grouped(sims, 0.4, 3, 9, named) == model_groups(sims, 0.4, 3, 9, named)


def test_translation_segments(spark):
    text = "short one\n\n" + " ".join(f"w{i}." if i % 50 == 49 else f"w{i}" for i in range(200))
    got = value(spark, chunking.translation_segments("t"), t=text)
    assert got[0] == "short one" and all(len(s.split()) <= 120 for s in got) and len(got) == 3
    assert re.sub(r"\s+", " ", " ".join(got)) == re.sub(r"\s+", " ", text)


def test_pages(spark):
    html = '<table><tr><td>Short Title:</td><td> The Act </td></tr><tr><td>Act Year</td><td>1956</td></tr></table><h1>No</h1><a href="/handle/1?view_type=browse">x</a><a href="/l?offset=40">n</a><a href="/handle/1?view_type=browse">x</a>'
    h = F.col("h")
    assert value(spark, P.title(h), h=html) == "The Act"
    assert value(spark, P.title(h), h="<h1> A <b>b</b></h1>") == "A b"
    assert value(spark, P.title(h), h="") is None
    assert value(spark, P.detail_links(h), h=html) == ["/handle/1?view_type=browse"]
    assert value(spark, P.has_next(h, F.lit(20)), h=html) and not value(spark, P.has_next(h, F.lit(40)), h=html)
    assert value(spark, P.table_value(h, "act year"), h=html) == "1956"
    for n, pages, good in ((1, ["x" * 500], True), (2, ["x" * 499], False), (3, ["x" * 500, ""], True), (4, ["x" * 500, "", "y" * 49], False), (5, [], False)):
        df = spark.createDataFrame([(n, pages)], "n int, p array<string>")
        assert df.select(P.good_pages(F.col("p")).alias("g")).first().g is good, n


def test_records(spark):
    df = spark.createDataFrame([({"a": "1", "text": "x", "date": ""}, {"a": "2", "raw_html": "y"})], "extra map<string,string>, metadata map<string,string>")
    assert df.select(R.flat_metadata().alias("m")).first().m == {"date": "", "a": "2"}
    chunk = spark.createDataFrame([("d", "2020", "j", 1, {"date": ""})], "doc_id string, date string, jurisdiction string, n int, metadata map<string,string>")
    assert R.chunk_rows(chunk).first().date == ""


def test_vectors(spark):
    assert value(spark, V.cosine(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(2.0)))) == 0.0
    assert value(spark, V.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))) == 1


def test_files(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"a": 1,\n "b": "x"}')
    (tmp_path / "j" / "b.json").write_text('[{"a": 2}, {"a": 3}]')
    (tmp_path / "j" / "c.json").write_text("{broken")
    got = files.json_records(spark, str(tmp_path / "j"), "a int, b string")
    assert sorted(r.a for r in got.collect()) == [1, 2, 3]
    assert files.listing(spark, str(tmp_path / "j"), "a.json").count() == 1
    (tmp_path / "lines.jsonl").write_text('{"a": 1}\n\nbad{\n{"a": 2}\n')
    assert files.json_lines(spark, str(tmp_path / "lines.jsonl"), "a int").where("a is not null").count() == 2
    (tmp_path / "p.txt").write_text('"x"\n"x"\n["y", "z"]\n"bare\n')
    assert sorted(r.id for r in files.progress(spark, str(tmp_path / "p.txt")).collect()) == ["bare", "x", "y", "z"]
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf" / "a.pdf").write_bytes(b"%PDF-" + b"x" * 2000)
    (tmp_path / "pdf" / "b.pdf").write_bytes(b"<html" + b"x" * 2000)
    assert files.valid_pdfs(spark, str(tmp_path / "pdf")).count() == 1


def test_upsert_and_stream(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, "k")
    sinks.upsert_table(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), path, "k")
    assert sorted(map(tuple, sinks.read_table(spark, path).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"k": 1, "v": "p"}\n{"k": 1, "v": "p"}\n{"k": 9, "v": "q"}\n')
    stream = E.once(E.arriving(spark, str(src), "k int, v string"), "k")
    E.into_table(stream, path, str(tmp_path / "cp"), "k").awaitTermination()
    E.into_table(stream, path, str(tmp_path / "cp"), "k").awaitTermination()
    assert {r.k: r.v for r in sinks.read_table(spark, path).collect()} == {1: "p", 2: "c", 3: "d", 9: "q"}


def test_a_run_that_dies_leaves_the_last_version(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_table(spark.createDataFrame([(1, "a")], "k int, v string"), path, "k")
    dying = spark.createDataFrame([(1, "b")], "k int, v string").selectExpr("k", "if(k = 1, raise_error('gone'), v) as v")
    with pytest.raises(Exception, match="gone"):
        sinks.upsert_table(dying, path, "k")
    assert list(map(tuple, sinks.read_table(spark, path).collect())) == [(1, "a")]
    sinks.upsert_table(spark.createDataFrame([(2, "b")], "k int, v string"), path, "k")
    assert sorted(map(tuple, sinks.read_table(spark, path).collect())) == [(1, "a"), (2, "b")]
    for i in range(4):
        sinks.replace_table(spark.createDataFrame([(i,)], "k int"), path)
    assert sinks.read_table(spark, path).first().k == 3 and len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]) == 1 + sinks.OLD_VERSIONS


def test_stream_harvest_and_idle_stop(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text("\n".join(json.dumps({"k": k}) for k in (1, 1, 2, 3, 4)))
    seen = []
    q = E.processed(E.arriving(spark, str(src), "k int"), str(tmp_path / "cp"), "k", lambda: spark.createDataFrame([(3,)], "k int"), lambda b: b.selectExpr("k", "k <> 4 as ok"), lambda n, r: seen.append(tuple(r)))
    q.awaitTermination()
    assert seen == [(2, 1, 1)]
    running = E.counts(E.arriving(spark, str(src), "k int"), "k").writeStream.outputMode("complete").format("memory").queryName("idle_test").start()
    E.stop_when_idle(running, seconds=3)
    assert not running.isActive and spark.table("idle_test").count() == 4


def test_progress_round_trip_and_seeding(spark, tmp_path):
    log = str(tmp_path / "log")
    ids = ["a", 'q"x', "é ü", "[b"]
    sinks.append_progress(spark.createDataFrame([(i,) for i in ids], "id string"), log)
    sinks.append_progress(spark.createDataFrame([("a",), ("z",)], "id string"), log)
    assert sorted(r.id for r in files.progress(spark, log, str(tmp_path / "missing")).collect()) == sorted([*ids, "z"])
    inventory = str(tmp_path / "inv")
    spark.createDataFrame([(2020, ["p_all_chunks.json", "q_all_chunks.json"]), (2021, ["r_all_chunks.json"])], "year int, files array<string>").write.parquet(inventory)
    fresh = str(tmp_path / "fresh")
    assert sinks.seed_progress(spark, inventory, fresh, str(tmp_path / "index_inv")) and not sinks.seed_progress(spark, inventory, fresh, str(tmp_path / "index_inv"))
    assert sorted(r.id for r in files.progress(spark, fresh).collect()) == ["p", "q", "r"]
    assert sinks.read_table(spark, str(tmp_path / "index_inv")).where("es_uploaded").count() == 2
    assert files.inventory_names(spark, inventory, F.col("year") == 2021).first().name == "r_all_chunks.json" and files.inventory_names(spark, str(tmp_path / "no")).count() == 0


def test_indexes(spark, tmp_path):
    mapping = {"settings": {"number_of_shards": 4}, "mappings": {"properties": {"doc_id": {"type": "keyword"}, "pdf_exists": {"type": "boolean"}, "n": {"type": "integer"}, "chunks": {"type": "nested", "properties": {"text": {"type": "text"}, "embedding": {"type": "dense_vector", "dims": 3}}}}}}
    path = str(tmp_path / "index")
    assert sinks.ensure_index(spark, path, mapping) and not sinks.ensure_index(spark, path, json.dumps(mapping))
    assert sinks.read_table(spark, path).schema.simpleString() == "struct<doc_id:string,pdf_exists:boolean,n:int,chunks:array<struct<text:string,embedding:array<float>>>>"
    assert json.loads(sinks.read_text(spark, path + ".settings.json")) == {"number_of_shards": 4, "number_of_replicas": 1}
    sinks.upsert_table(spark.createDataFrame([("a", True, 1, [])], sinks.index_schema(mapping)), path, "doc_id")
    assert sinks.read_table(spark, path).count() == 1 and sinks.ensure_index(spark, path, mapping, recreate=True) and sinks.read_table(spark, path).count() == 0
    flat = str(tmp_path / "flat")
    assert sinks.ensure_search_index(spark, flat, "sc") and not sinks.ensure_search_index(spark, flat, "sc")
    chunk = spark.createDataFrame([("a/b c", 3, "o")], "chunk_id string, num_sentences int, original_source_path string")
    sinks.upsert_table(R.search_documents(chunk, collection="sc"), flat, "id")
    row = sinks.read_table(spark, flat).first()
    assert (row.id, row.num_sentences, row.source_file, row.embedding, row.confidence) == ("a_b_c", 3, "o", [], 0.0)
    assert sinks.purge(spark, [path, flat], [str(tmp_path / "no")]) == {path: True, flat: True, str(tmp_path / "no"): False}


def test_bundles_and_files(spark, tmp_path):
    rows = spark.createDataFrame([("a", float("nan")), ("b", 1.5), (None, 2.0)], "chunk_id string, x double")
    assert sinks.write_bundle(str(tmp_path / "out"), "2024", {"n": 3}, all_chunks=rows, top=None) == {"all_chunks": True, "stats": True}
    assert json.loads(sinks.read_text(spark, str(tmp_path / "out/2024/processing_stats.json"))) == {"n": 3}
    assert spark.read.json(str(tmp_path / "out/2024/all_chunks")).selectExpr("sum(x) s").first().s == 3.5
    assert tuple(sinks.write_chunks(rows, str(tmp_path / "each"))) == (3, 3, 0, 100.0) and (tmp_path / "each" / "_name=unknown").exists()
    sinks.write_marker(spark, str(tmp_path / "m" / "x_done_0.json"), {"ok": True})
    assert sinks.make_folder(spark, str(tmp_path / "new")) and files.exists(spark, str(tmp_path / "m/x_done_0.json"))
    for name in ("year=2020/a.json", "2021/b.json", "2022/c.json", "state=goa/d.json", "state=assam/e.json", "state=goa/_inventory.json"):
        (tmp_path / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name).write_text(json.dumps({"doc_id": name}))
    raw = str(tmp_path / "raw")
    assert sorted((r.name, r.year) for r in files.year_files(spark, raw, [2020, 2021, 2030]).collect()) == [("a.json", 2020), ("b.json", 2021)]
    assert files.states(spark, raw) == ["assam", "goa"] and files.folders(spark, str(tmp_path / "nope")) == []
    assert [r.doc_id for r in files.of_state(spark, raw, "assam", "doc_id string").collect()] == ["state=assam/e.json"]
    assert files.fetch(spark, raw, "doc_id string", max_files=2).count() == 2 and len(list(files.one_by_one(files.fetch(spark, raw, "doc_id string")))) == 5
    assert files.export_files(files.listing(spark, raw, ".json"), str(tmp_path / "flat")) == 5 and sorted(p.name for p in (tmp_path / "flat").glob("?.json")) == list(map("{}.json".format, "abcde"))


def test_pdf_texts(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-good" + b"x" * 2000)
    (tmp_path / "b.pdf").write_bytes(b"%PDF-scan" + b"x" * 2000)
    (tmp_path / "c.pdf").write_bytes(b"%PDF-none" + b"x" * 2000)
    pages = lambda content: ["word " * 200] if b"good" in content else [""]
    seen = lambda content: ["seen " * 200] if b"scan" in content else 1 / 0
    got = {r.path[-5:]: (bool(r.text), r.page_count, r.ocr_applied) for r in files.pdf_texts(spark, str(tmp_path), pages, seen).collect()}
    assert got == {"a.pdf": (True, 1, False), "b.pdf": (True, 1, True), "c.pdf": (False, 1, False)}
    assert files.pdf_texts(spark, str(tmp_path), pages).where("text is not null").count() == 1


def test_recognised_text(spark):
    page = [(2, "<p>two &amp; more</p>", False), (1, "<b>one</b>-<i>x</i>", False), (3, "skip", True), (4, None, None), (5, "end-", False), (6, "ing", False)]
    df = spark.createDataFrame([([page, [(1, "z" * 500, False)]],)], "p array<array<struct<reading_order:int,html:string,skipped:boolean>>>")
    assert df.select(P.recognised_text(F.col("p")).alias("t")).first().t == "one - x\ntwo & more\nending\n\n" + "z" * 500
    assert df.select(P.recognised_text(F.slice("p", 1, 1)).alias("t")).first().t is None


def test_detail_records(spark):
    row = lambda a, b: f"<tr><td>{a}</td><td>{b}</td></tr>"
    page = "<table>" + row("Short Title:", "The (Odd) Act") + row("Act Number:", "7 of 1901") + row("Enacted Year", "1956 AD") + "</table><a href='x'></a><a href=\"/b/hindi1.pdf\">h</a><a href=\"/b/2/H12.pdf\">h</a><a href=\"b/eng.PDF\">e</a>"
    got = P.detail_records(spark.createDataFrame([(page, "https://h.org/handle/1/2?x=1"), ("<p>no title</p>", "https://h.org/q"), ("<h1>Act of 1850</h1>", "https://h.org/handle/9")], "html string, url string"), "https://h.org/x/y").collect()
    assert list(map(tuple, got)) == [("The (Odd) Act", "1/2", "7 of 1901", 1956, "https://h.org/x/b/eng.PDF", True, "https://h.org/handle/1/2?x=1"), ("Act of 1850", "9", "", 1850, "", False, "https://h.org/handle/9")]
    assert value(spark, P.table_value(F.col("h"), "year (a.b)"), h="<table>" + row("YEAR (A.B):", "1") + "</table>") == "1"


def test_files_to_fetch(spark):
    acts_ = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("c.pdf",)], "pdf_name string")
    assert sorted(r.pdf_name for r in P.to_fetch(acts_, spark.createDataFrame([("a.pdf", 5000), ("b.pdf", 10)], "name string, length long")).collect()) == ["b.pdf", "c.pdf"]
    got = spark.createDataFrame([("x/eng.pdf", b"%PDF-" + b"x" * 2000), ("x/H2.pdf", b"%PDF-" + b"x" * 2000), ("x/y.pdf", b"<html" + b"x" * 2000), ("x/z.pdf", b"%PDF-")], "url string, content binary")
    assert [r.url for r in P.english_pdfs(got).collect()] == ["x/eng.pdf"]
    assert value(spark, P.alternates(F.col("h"), "https://h.org", 2), h="1/2") == ["https://h.org/bitstream/1/2/1/", "https://h.org/bitstream/1/2/2/"]


def test_translation(spark):
    docs = spark.createDataFrame([(1, "a one\n\nb two\n\nc bad\n\nd four", "hi"), (2, None, "hi"), (3, "x", None), (4, "  \n ", "hi")], "i int, t string, lang string")

    def translate(parts, lang):
        if any("bad" in p for p in parts):
            raise ValueError(lang)
        return [p.upper() for p in parts]

    got = {r.i: r.t for r in chunking.translated(docs, "i", "t", "lang", translate, batch=2).collect()}
    assert got == {1: "A ONE\n\nB TWO\n\nc bad\n\nd four", 2: None, 3: "x", 4: "  \n "}


def test_language_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").where("length(text) > 200")
    train, held = docs.where("pmod(xxhash64(doc_id), 2) = 0"), docs.where("pmod(xxhash64(doc_id), 2) = 1")
    got = language.detect(language.train(train), held.unionByName(spark.createDataFrame([(-1, "12 34", "none"), (-2, None, "none")], "doc_id long, text string, lang string"))).collect()
    known = [r for r in got if r.doc_id >= 0]
    assert np.mean([r.language == r.lang for r in known]) >= 0.97
    assert {(r.language, r.language_confidence) for r in got if r.doc_id < 0} == {("unknown", 0.0)}


def test_role_models(spark, tmp_path):
    rows = spark.createDataFrame([("alpha beta", "a"), ("gamma delta", "b")] * 20 + [(None, "a"), ("x", None)], "text string, role string")
    model = roles.train(rows, 1 << 8)
    roles.save(model, str(tmp_path / "m"))
    again = roles.from_config(spark, {"finetuned_model_path": str(tmp_path / "m")})
    known = rows.where("text is not null and role is not null")
    assert tuple(roles.accuracy(roles.predict(again, known)).first()) == (40, 1.0)
    assert roles.classify_chunks(again, known).first().role_prediction.role in "ab"
    assert roles.from_config(spark, {"enabled": False}) is None and roles.accuracy(rows.where("false"), "role", "text").first().accuracy is None
    with pytest.raises(FileNotFoundError):
        roles.from_config(spark, {"finetuned_model_path": str(tmp_path / "none")})
    assert {(r.role, r.label) for r in roles.training_rows(rows, names=["b", "a"]).collect()} == {("b", 0), ("a", 1)}


def test_safe_values(spark):
    row = spark.sql("select named_struct('a', array(double('NaN'), 1.0D, null), 'm', map('k', double('-Infinity')), 'b', X'41FF42', 't', timestamp'2020-01-02 03:04:05', 'n', cast(null as struct<x:double>)) as s, float('inf') as f")
    got = values.safe_rows(row).first()
    assert (got.s.a, got.s.m, got.s.b, got.s.t, got.s.n, got.f) == ([0.0, 1.0, None], {"k": 0.0}, "A\ufffdB", "2020-01-02T03:04:05Z", None, 0.0)


def test_acts(spark):
    meta = spark.createDataFrame([("d1", "An: Act", None, None), ("d2", None, "3", 1990), ("d3", "Other", "4", 1991)], "doc_id string, act_name string, act_number string, year int")
    files_ = spark.createDataFrame([("An_ Act.pdf", 10), ("d2.pdf", 20), ("d1.pdf", 30)], "name string, length long")
    got = {r.doc_id: (r.pdf_name, r.pdf_exists, r.pdf_file_size_bytes) for r in acts.with_pdf(meta, files_).collect()}
    assert got == {"d1": ("An_ Act.pdf", True, 10), "d2": ("d2.pdf", True, 20), "d3": (None, False, 0)}
    chunks = spark.createDataFrame([("d1", 1, "a"), ("d1", 10, "c"), ("d1", 2, "b"), ("d2", 1, "x")], "doc_id string, chunk_id int, text string")
    out = {r.doc_id: r for r in acts.processed(acts.record(meta, "s", "India"), chunks).collect()}
    assert [c.chunk_id for c in out["d1"].chunks] == ["d1_1", "d1_2", "d1_10"] and out["d2"].chunks == [] == out["d3"].chunks and out["d1"].year == 0 and "text" not in out["d1"]
    assert value(spark, acts.state_name(F.col("k")), k="tamil_nadu") == "Tamil Nadu" and value(spark, acts.state_name(F.col("k")), k="jammu_kashmir") == "Jammu and Kashmir"
    lifted = acts.with_service_type(spark.createDataFrame([('{"service_type": "q"}',), ("[1]",)], "subservice string"))
    assert [r.service_type for r in lifted.collect()] == ["q", None]
    paths = acts.with_chunks_path(spark.createDataFrame([("p", None), ("p", "own")], "path string, all_chunks_path string"), "path")
    assert [r.all_chunks_path for r in paths.collect()] == ["p", "own"]
    assert value(spark, T.act_year(F.col("a"), F.col("b"), number=F.col("c"), title=F.col("d")), a="", b="none", c="5 of 1950", d="x") == 1950
    assert value(spark, T.state_slug(F.col("h"), F.lit("goa")), h="12/7") == "SA_goa_7" and value(spark, T.int_or_same(F.col("a")), a=" 12 ") == "12"


def test_settings(monkeypatch):
    monkeypatch.setenv("LEXLOOM_SOURCE", "s")
    monkeypatch.setenv("LEXLOOM_YEARS", "2001, 2002")
    monkeypatch.setenv("LEXLOOM_TOP_K", "5")
    own = Settings.from_environment()
    assert (own.source, own.years, own.top_k) == ("s", [2001, 2002], 5)
    with pytest.raises(ValueError, match="(?s)index is not set.*progress is not set"):
        own.validate()
    own.index = own.progress = "x"
    assert own.validate() is own


def test_index_job(spark, tmp_path, capsys):
    rows = [(f"d{i + 10 * (y - 2020)}", y, c, "user" if c % 2 else "system", f"text {c}", c / 10) for y in (2020, 2021) for i in range(3) for c in range(1, 8)]
    source, index, log = (str(tmp_path / x) for x in ("source", "index", "log"))
    spark.createDataFrame(rows, "doc_id string, year int, chunk_id int, role string, text string, doc_similarity double").write.partitionBy("year").parquet(source)
    args = ["--source", source, "--index", index, "--log", log, "--top-k", "3"]
    with pytest.raises(SystemExit):
        jobs.main([*args, "--years", "2020", "--year-range", "2020", "2021"], spark)
    first = jobs.main([*args, "--year-range", "2031", "2020", "--reverse"], spark)
    assert [(x["year"], x["uploaded"], x["skipped"]) for x in first] == [(2021, 3, 0), (2020, 3, 0)]
    assert [x["uploaded"] for x in jobs.main([*args, "--years", "2020"], spark)] == [0]
    withv = jobs.index_documents(spark.read.parquet(source), 2, {"user": 1.0}, embed="hashed").first()
    assert len(withv.chunks[0].embedding) == 64
    table = sinks.read_table(spark, index)
    assert table.count() == 6 and all(len(r.chunks) == 3 and r.chunks[0].same_role_chunk_ids is not None for r in table.collect())
    sinks.replace_table(table.where("doc_id <> 'd1'"), index)
    assert jobs.main([*args, "--verify-resume"], spark) == [{"year": 2020, "missing": 1}]
    assert [x["uploaded"] for x in jobs.main([*args, "--years", "2020", "--recreate-index"], spark)] == [3]


def test_meter(spark):
    meter = I.Meter()
    meter.watch(spark.range(50)).write.format("noop").mode("overwrite").save()
    assert meter.result()["docs"] == 50 and meter.result()["docs_per_sec"] <= 50


def test_incremental(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "name string")
    paths = lambda *p: spark.createDataFrame(p, "name string, path string")
    got = I.lookup_path(a.distinct(), paths(("x", "p2"), ("x", "p1")), paths(("x", "q"), ("y", "r"))).collect()
    assert {r.name: r.path for r in got} == {"x": "p1", "y": "r"}
    assert I.inventory(a, [], "name").first().files == ["x", "y"]
    assert I.first_seen(paths(("x", "2"), ("x", "1")), "name", "path").first().path == "1"
