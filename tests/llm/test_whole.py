"""Cases in which an operator once did less than the whole job."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from lexloom.llm import decontaminate, htmltext, licenses, minhash, neighbours, packing, pii, quality, substrings, warc
from lexloom.llm import textcore as tc


def test_terms_of_a_text_with_many_copies(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    rows = [(i, " ".join(word() for _ in range(40))) for i in range(600)]
    rows += [(1000 + i, f"{word()} {word()} Zorbanax {word()} mail q.x@site.org {word()} the {word()}") for i in range(6)]
    rows += [(2000 + i, rows[-1][1]) for i in range(7)]
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    marked = {r.doc_id for r in found if any(s.kind == len(pii.KINDS) - 1 for s in r.found)}
    assert marked == {r[0] for r in rows if r[0] >= 1000}


def test_toxic_features_with_copied_labels(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("bcdfghjk") for _ in range(7))
    text = lambda *more: " ".join([word() for _ in range(30)] + list(more))
    toxic = [text("vilezzz") if i < 12 else text() for i in range(45)]
    rows = [(i, toxic[i] if i < 45 else toxic[44]) for i in range(600)] + [(1000 + i, text()) for i in range(600)]
    labels = spark.createDataFrame([(i, i < 1000) for i, _ in rows] + [(5000 + i, False) for i in range(900)], "doc_id long, toxic boolean")
    bad = quality.toxic_features(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert tc.split([b"vilezzz"]).hashes()[0] in bad


def test_toxic_features_from_all_labels(spark):
    rnd = random.Random(6)
    text = lambda *more: " ".join(["".join(rnd.choice("bcdfghjk") for _ in range(7)) for _ in range(30)] + list(more))
    order = [r.id for r in spark.range(25_000).orderBy(F.xxhash64("id"), "id").collect()]
    toxic = set(order[-12:])
    rows = [(i, text("vilezzz")) for i in toxic] + [(i, text()) for i in order[:600]]
    labels = spark.createDataFrame([(i, i in toxic) for i in order], "doc_id long, toxic boolean")
    # A row that repeats a text, under its own id or another's, counts once.
    rows += rows[:1] * 3 + [(order[700], rows[-1][1])]
    bad = quality.toxic_features(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert tc.split([b"vilezzz"]).hashes()[0] in bad


def test_licences_need_no_unrelated_word():
    rules = licenses.rules()
    named = {"distributed under apache 2.0 terms": "apache-2", "terms: https://mozilla.org/mpl/2.0/": "mpl-2.0", "see eclipse.org/legal/epl-v20": "epl-2.0", "eupl-1.2": "eupl-1.2", "scripts.sil.org/ofl": "ofl-1.1", "mariadb.com/bsl11": "busl-1.1", "mit no attribution": "mit-0", "the psf license": "python-2.0", "do what the fxxx you want to public license": "wtfpl", "open\nfont\nlicense": "ofl-1.1", "a creative\n commons attribution 4.0": "cc-by-4.0"}
    named |= {"the zope\npublic license": "zpl-2.1", "under cecill-b license": "cecill-b", "blue oak model license 1.0.0": "blueoak-1.0.0", "zlib/libpng license": "zlib", "latex-project.org/lppl": "latex", "spdx-license-identifier: mulanpsl-2.0": "mulan-2.0"}
    assert len(rules) > 500 and "libpng" not in {x[2] for x in licenses.detect("zlib/libpng license", rules)}
    for text, label in named.items():
        assert label in {x[2] for x in licenses.detect(text, rules)}, text
        assert all(licenses.detect(m[0], [r]) for r in rules for m in r.pattern.finditer(text))


@pytest.mark.parametrize("n, norms", [(15, "one"), (30, "one"), (3000, "outlier")])
def test_neighbours_of_every_query(spark, n, norms):
    x = np.random.default_rng(3).standard_normal((n, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "outlier":
        x[7] *= 30
    got = defaultdict(set)
    for r in neighbours.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect():
        got[r.query_id].add((r.rank, r.vec_id))
    size = min(20, n - 1)
    assert {q: len(v) for q, v in got.items()} == {q: size for q in range(0, n, 20)}
    assert all({r for r, _ in v} == set(range(1, size + 1)) and len({i for _, i in v}) == size for v in got.values())
    if n <= 20:
        assert [i for _, i in sorted(got[0])] == [i for i in np.lexsort((np.arange(n), -(x @ x[0]))).tolist() if i != 0]


def test_decontamination_by_row_in_any_number_of_blocks(spark, monkeypatch):
    bench = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(6)], "item_id long, text string")
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(15))
    rows = [(1, text(0)), (1, text(0)), (1, "clean words only"), (1, text(3) + " more"), (None, text(1)), (None, "clean"), (None, None), (2, ""), (2, None), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for limit in (1 << 24, 200):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", limit)
        found.append(sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"], r.spans, r.contaminated)) for r in decontaminate.benchmark_hits(docs, bench).collect()))
    assert len(found[0]) == len(rows) and found[0] == found[1]


def test_packing_rounds_keep_to_their_fan_in(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 50)
    real = packing._merge

    def bounded(frames):
        own = list(frames)
        assert sum(f.num_rows for f in own) <= 100
        yield from real(iter(own))

    monkeypatch.setattr(packing, "_merge", bounded)
    pieces = spark.createDataFrame([(i, 0, 0, 1100 + i % 7, 0) for i in range(400)], "doc_id long, piece long, start long, length long, ids_crc32 long")
    assert len({r.sequence_id for r in packing.pack(pieces).collect()}) == 400


def test_the_cut_decides_between_neighbours():
    link = "<article><p>Some text stands here.</p><p><a href=x>link</a></p><p>And more text, as it is.</p></article>"
    own = htmltext.blocks(link)
    assert [s > 0 for s in htmltext.scores(own)] == [True, False, True] and htmltext.labels(own) == [True, True, True]
    assert htmltext.extract("<nav>" + link[9:-10] + "</nav><article><p>A</p></article>") == "A"


def test_class_words_settle_nothing_alone():
    assert htmltext.extract('<div class="post social-history"><h1>A</h1><p>Some text here that is long.</p></div>') == "A Some text here that is long."
    assert htmltext.extract('<article><p>Some text here.</p><p class="legal">Legal text is kept.</p></article>') == "Some text here. Legal text is kept."
    assert htmltext.extract("<p class=it's>Hello there, this is a text.</p><p>More of it is here.</p>") == "Hello there, this is a text. More of it is here."
    comments = '<section class="comments"><p>I like this article a lot, thank you so much for writing it, all the best.</p></section>'
    assert htmltext.extract(f'<div class="social"><article><p>Text.</p><div class="ad">Buy this thing now.</div><aside><p>See also this.</p></aside>{comments}</article></div>') == "Text."


@pytest.mark.parametrize("part", ["<a ", '<a x="', "<!--", "<div>", "<b>", "<button>", "<p class='", "<td></p>", "<script>", "<p a=b", "<li>a<ul>", "<p>word here. ", "<a href=x>y</a> "])
def test_any_page_takes_linear_time(part):
    began = time.process_time()
    htmltext.extract(part * (60_000 // len(part)) + "</i>" * 10_000)
    assert time.process_time() - began < 1.5


def test_whole_pages_in_one_graph():
    page = "<article>" + "".join(f"<p>Word {i} here.</p>" for i in range(3000)) + "</article><footer>No.</footer>"
    assert htmltext.extract(page) == " ".join(f"Word {i} here." for i in range(3000))


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SECRET = re.compile(r"[A-Za-z0-9_]{24,}")


def information(m):
    return -sum(n / len(m) * np.log2(n / len(m)) for n in Counter(m).values())


def brute_entities(text):
    """(kind, start, end, value, words before, words after) by the definition, of mails, addresses and secrets."""
    kinds = ((0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda m: True), (1, r"[0-9]+(?:\.[0-9]+){3}", lambda m: all(int(x) < 256 for x in m.split("."))), (4, SECRET.pattern, lambda m: sum(c.isdigit() for c in m) >= 4 and sum(not c.isdigit() for c in m) >= 4 and information(m) >= 3))
    out = []
    for kind, pattern, ok in kinds:
        found = [m.span() for m in re.finditer(pattern, text)]
        edges = [(None, 0), *found, (len(text), None)]
        for (_, a), (b, c), (d, _) in zip(edges, edges[1:], edges[2:]):
            before, after = low(text[a:b]), low(text[c:d])
            if len(before) > pii.REACH:
                before = re.sub(rf"^{WORDS.pattern}", "", before[-pii.REACH :])
            if len(after) > pii.REACH:
                after = re.sub(rf"{WORDS.pattern}$", "", after[: pii.REACH])
            if ok(text[b:c]):
                out.append((kind, b, c, f"{kind}:{text[b:c].lower()}", tuple(WORDS.findall(before)[-pii.NEAR :]), tuple(WORDS.findall(after)[: pii.NEAR])))
    return out


def brute_terms(texts):
    """Spans of terms of each text, from plain counts."""
    contexts, n, ef, df = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for i, t in enumerate(texts):
        for w in set(WORDS.findall(low(t))):
            df[w].add(i)
        for kind, _, _, value, before, after in brute_entities(t):
            for e in (value, str(kind)):
                ef[e].add(i)
                for w in {*before, *after}:
                    if len(w) >= 3 and not w.isdigit():
                        contexts[e, w].add((before, after))
                        n[e, w].add(i)
    strong = {(e, w) for (e, w), c in contexts.items() if len(c) >= pii.CONTEXTS and len(n[e, w]) >= pii.DISCLOSURE * len(df[w]) and np.log2(len(n[e, w]) * len(texts) / (len(df[w]) * len(ef[e]))) >= pii.BITS}
    out = []
    for t in texts:
        own = {w for kind, _, _, value, before, after in brute_entities(t) for e in (value, str(kind)) for w in {*before, *after} if (e, w) in strong}
        out.append(sorted((m.start(), m.end()) for m in WORDS.finditer(low(t)) if m[0] in own))
    return out


def test_terms_by_definition(spark):
    rnd = random.Random(12)
    common = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(300)]
    owners = ["Zorbanax", "quillfeather", "Überdorf"]
    texts = []
    for i in range(400):
        words = [rnd.choice(common) for _ in range(rnd.randint(3, 90))]
        if i % 3 == 0:
            who = rnd.randrange(3)
            at = rnd.randrange(len(words))
            words[at:at] = rnd.choice([[owners[who], f"q{who}.x@site.org"], [f"q{who}.x@site.org", "or", owners[who]], ["x" * 150, "write", f"q{who}.x@site.org", "y" * 150, owners[who]], [f"10.1.2.{who}", "host"], [f"10.1.2.{i % 250}", "host"]])
        if i % 20 == 0:
            words += ["token", "=", '"' + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + '"', "token"]
        if i % 50 == 0:
            words += ["token", "a" * 30, "1234" * 9]
        texts.append(" ".join(words))
    texts += texts[:40] + ["", "token"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: sorted((s.start, s.end) for s in r.found if s.kind == len(pii.KINDS) - 1) for r in pii.personal_data(docs).collect()}
    want = brute_terms(texts)
    assert sum(map(len, want)) > 100 and any(t[a:b] == "token" for t, own in zip(texts, want) for a, b in own) and any(t[a:b] == "Zorbanax" for t, own in zip(texts, want) for a, b in own)
    assert [got[i] for i in range(len(texts))] == want


def test_spans_and_replacements_of_many_matches(spark):
    text = " ".join(f"u{i}@mail{i % 7}.org é {i}" for i in range(3000))
    docs = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, k int").unionByName(spark.createDataFrame([(None, None, 1)], "doc_id long, text string, k int"))
    rows = pii.personal_data(docs).collect()
    found = next(r for r in rows if r.doc_id == 1).found
    assert [(s.start, s.end) for s in found if s.kind == 0] == [m.span() for m in re.finditer(r"\S+@\S+", text)]
    plain = spark.createDataFrame([(text, [(s.start, s.kind, s.end) for s in found if s.kind == 0]), ("abcdef", [(1, 0, 3), (2, 1, 5)])], "text string, found array<struct<start:int,kind:int,end:int>>")
    assert [r.t for r in plain.select(pii.sanitised().alias("t")).collect()] == [re.sub(r"\S+@\S+", "[EMAIL]", text), "a[EMAIL]f"]


def test_near_neighbours_are_found_among_few_vectors():
    rnd = np.random.default_rng(5)
    centers = rnd.standard_normal((300, 32))
    x = centers[rnd.integers(0, 300, 12_000)] + 0.4 * rnd.standard_normal((12_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    h = neighbours.fit(x[:4000], float(np.linalg.norm(x, axis=1).max()), len(x))
    asked = x[::200]
    score = asked @ x.T
    score[np.arange(len(asked)), np.arange(0, len(x), 200)] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    cells, real = np.floor(h.cells(x, query=False)).astype(np.int64), h.cells(asked, query=True)
    hit = np.zeros((len(asked), len(x)), dtype=bool)
    for t in range(neighbours.TABLES):
        keys = neighbours._key(t, cells[t])
        for i in range(len(asked)):
            own = np.floor(real[t, i])
            hit[i] |= np.isin(keys, neighbours._key(t, own + np.array(neighbours.probes(real[t, i] - own, h.probes))))
    assert np.take_along_axis(hit, best, axis=1).mean() >= 0.9 and hit.mean() <= 0.1


#: Names that operators use inside, as further columns.
CLASHING = ("k", "key", "h", "s", "n", "c", "v", "word", "words", "block", "shard", "kind", "digest", "bands", "minima", "held", "use", "row", "copies", "piece", "start", "length", "bin", "offset", "found", "base", "entities", "spans", "record_id", "chunk", "data", "payload", "rep", "rank", "score", "query_id", "part", "anchors", "seg", "_k")


@pytest.fixture(scope="module")
def odd(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(200)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    long_ = text(60_000)
    rows = [(i, text(rnd.randint(1, 150))) for i in range(30)]
    rows += [rows[3], rows[3], (None, rows[3][1]), (None, None), (None, ""), (40, None), (40, None), (41, ""), (42, long_), (43, "y" * 300_000), (3, "another text of one id here"), (44, "mail a.b@cc.org the mit license ip 1.2.3.4")]
    docs = spark.createDataFrame([(i, t, "en", "src") for i, t in rows], "doc_id long, text string, lang string, source string")
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("clash"))
    return rows, docs


def test_odd_rows_of_documents(spark, odd):
    import corpus_pipeline

    rows, docs = odd
    ids = Counter(i for i, _ in rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(rows[5][1].split()[:30]))], "item_id long, text string")
    operators = {
        "op1": lambda d: decontaminate.benchmark_hits(d, bench), "op2": substrings.remove_repeats, "op3": licenses.scan_licenses, "op5": lambda d: pii.digest(pii.personal_data(d)),
        "op8": lambda d: quality.quality(d, labels), "op10": minhash.near_duplicates,
    }
    for name, f in operators.items():
        got = f(docs).collect()
        assert Counter(r.doc_id for r in got) == ids, name
        assert len({str(r) for r in got if r.doc_id == 40}) == 1, name
        assert f(docs.where("false")).count() == 0, name
    pieces = packing.pack_documents(docs).collect()
    assert Counter(p.doc_id for p in pieces if p.piece == 0) == ids and packing.pack_documents(docs.where("false")).count() == 0
    for stage in corpus_pipeline.STAGES[1:-1]:
        out = stage[1](spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and 0 < out.count() <= len(rows) and stage[1](spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0
    assert corpus_pipeline.packing_stage(spark, docs, "").count() == len(pieces)


def test_ties_in_best_fit():
    which, offset, n = packing.best_fit(np.array([1024] * 5 + [2048, 1, 1]))
    assert n == 4 and which[:2].tolist() == [1, 1] and offset[:2].tolist() == [0, 1024] and which[5] == 0 and which[4] == which[6] == which[7]


def test_odd_rows_of_pages_and_vectors(spark):
    rows = [(1, "u", "<p>a text here.</p>"), (1, "u", "<p>a text here.</p>"), (None, None, None), (2, "u", ""), (3, "u", "<p>" + "long text. " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0, -float(i)]) for i in range(50)] + [(7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0, 1.0])], "vec_id long, embedding array<double>")
    for c in CLASHING:
        pages, vectors = pages.withColumn(c, F.lit("clash")), vectors.withColumn(c, F.lit("clash"))
    text = htmltext.main_text(pages).collect()
    assert sorted((r.page_id or -1, r.n_chars) for r in text) == [(-1, 0), (1, 12), (1, 12), (2, 0), (3, 1_099_999)]
    archive = warc.read_archive(warc.write_archive(pages)).collect()
    assert Counter(r.page_id for r in archive) == Counter(r[0] for r in rows)
    got = neighbours.nearest(vectors).collect()
    assert Counter(r.query_id for r in got) == {0: 20, 20: 20, 40: 20}
    assert htmltext.main_text(pages.where("false")).count() == 0 == warc.read_archive(warc.write_archive(pages.where("false"))).count() and neighbours.nearest(vectors.where("false")).count() == 0


def test_repeated_id_with_another_text(spark):
    common = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, common + " one"), (1, "short"), (2, common + " two"), (None, common), (None, "x")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in substrings.remove_repeats(docs).collect()), key=str)
    size = len(common.encode())
    assert sorted(g[2] for g in got) == [0, 0, size, size, size] or sorted(g[2] for g in got)[:2] == [0, 0] and all(g[2] >= size for g in got if g[1] > 100)


def test_long_texts_in_slices(monkeypatch):
    import public_tokenizers

    rnd = random.Random(6)
    texts = ["".join(rnd.choice(["ab ", "ab\n", "Ab", "CD!! ", "é\t", "x", " ", "it's ", "12 "]) for _ in range(rnd.randint(1, 400))) for _ in range(200)]
    whole = [quality.tokens([t.encode()]) for t in texts]
    tokenizer = packing.Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids, found, hashes = tokenizer.encode(texts), [substrings.sliced([(t * 9).encode()]) for t in texts[:40]], tc.split([t.encode() for t in texts]).hashes()
    monkeypatch.setattr(tc, "BLOCK", 7)
    monkeypatch.setattr(packing, "CHARS", 20)
    monkeypatch.setattr(substrings, "SLICE", 50)
    assert (tc.split([t.encode() for t in texts]).hashes() == hashes).all()
    for t, (h, first, repeats) in zip(texts, whole, strict=True):
        again = quality.tokens([t.encode()])
        assert again[0].tolist() == h.tolist() and again[1].tolist() == first.tolist() and again[2].tolist() == repeats.tolist(), t
    assert tokenizer.encode(texts) == ids
    for t, (_, h, _, geo) in zip(texts[:40], found, strict=True):
        starts = lambda h, geo: sorted((int(a), (g >> 20) - b) for a, g in zip(h, geo.tolist(), strict=True) for b in range(g & 1023, (g >> 10 & 1023) + 1))
        again = substrings.sliced([(t * 9).encode()])
        assert starts(again[1], again[3]) == starts(h, geo)


def test_bit_filter(spark):
    from lexloom.llm.filters import bit_filter

    holds = bit_filter(spark.range(0, 300, 3).withColumnRenamed("id", "x"), "x", 64 * 64, "bits")
    got = {r.y: r.h for r in spark.range(300).selectExpr("id as y").withColumn("h", holds("y")).collect()}
    assert all(got[i] for i in range(0, 300, 3)) and sum(got.values()) < 130


def test_tables_of_a_stage_are_deleted(spark):
    from pathlib import Path

    from lexloom.llm import store

    root = Path(store.shared_dir(spark).removeprefix("file://")) / "lexloom"
    before = set(root.glob("*/*"))
    with store.scratch(spark):
        first = store.keep(spark.range(5), "a")
        last = store.keep(first.selectExpr("id + 1 as id"), "b", lasting=True)
    left = {p.name.split("-")[0] for p in set(root.glob("*/*")) - before}
    assert left == {"b"} and last.count() == 5


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    """An id that repeats with another text: each row stays or goes by itself, in every stage."""
    import corpus_pipeline

    data = "/root/testdata/sf0.001"
    item = next(r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect() if len(r.text.split()) > 15)
    clean = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").where("length(text) between 400 and 900").orderBy("doc_id").limit(6).collect()]
    rows = [(0, clean[0]), (1, clean[1]), (2, clean[2]), (3, clean[3]), (3, item), (4, clean[4]), (None, item), (3, clean[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit(1))
    got = corpus_pipeline.decontamination_stage(spark, docs, data)
    assert got.columns == docs.columns
    kept = Counter((r.doc_id, r.text == item) for r in got.collect())
    assert kept[3, True] == 0 and kept[3, False] == 2 and kept[None, True] == 1
    copies = spark.createDataFrame([(1, clean[0]), (2, clean[0]), (2, clean[1]), (3, clean[1]), (3, clean[2])], "doc_id long, text string")
    assert {r.text for r in corpus_pipeline.near_duplicates_stage(spark, copies, data).collect()} == set(clean[:3]) and corpus_pipeline.near_duplicates_stage(spark, copies, data).count() == 3
    mixed = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    good = corpus_pipeline.quality_stage(spark, mixed, data)
    some = good.orderBy("doc_id").first()
    empty = spark.createDataFrame([(some.doc_id, "  ", some.lang)], mixed.schema)
    again = corpus_pipeline.quality_stage(spark, mixed.unionByName(empty), data).where(F.col("doc_id") == some.doc_id).collect()
    assert [r.text for r in again] == [some.text]
