"""Each operator against a brute-force version, with nulls, empty and long texts, repeated rows and further columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import components, decontaminate, fmindex, htmltext, licenses, minhash, neighbours, packing, pii, quality, substrings, warc
from lexloom.llm import textcore as tc

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def texts():
    """(id, text): invented documents with exact and near copies, passages, nulls, empty and long ones."""
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdefgéß") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    make = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage = make(120)
    out = [(i, make(rnd.randint(1, 200))) for i in range(60)]
    for i in range(60, 90):
        words = out[rnd.randrange(40)][1].split()
        for _ in range(max(1, len(words) // 40)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        out.append((i, " ".join(words)))
    out += [(100 + i, out[i % 3][1]) for i in range(12)]
    out += [(120 + i, make(30) + " " + passage + " " + make(i)) for i in range(8)]
    out += [(200, None), (201, ""), (202, " \n\t "), (203, "one two"), (204, "one two"), (205, "x" * 5000), (206, "ab " * 2000), (207, "Und " * 300), (208, make(5000))]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None, 1, "k") for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long, key int, h string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_fm_index():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        text = rnd.integers(0, 4, n)
        index = fmindex.FMIndex(text, 4)
        for k in (1, 2, 3):
            patterns = np.array([[a, b, c][:k] for a in range(1, 4) for b in range(1, 4) for c in range(1, 4)])
            lo, hi = index.search(patterns)
            for p, a, b in zip(patterns, lo, hi, strict=True):
                want = [i for i in range(n - k + 1) if (text[i : i + k] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def brute_hits(rows, bench):
    windows = defaultdict(set)
    for i, t in bench:
        w = WORD.findall(low(t))
        for a in range(max(1, len(w) - 12) if w and i is not None else 0):
            windows[tuple(w[a : a + 13])].add(str(i))
    out = {}
    for d, t in rows:
        w, hit, items = WORD.findall(low(t)), set(), set()
        for n in set(map(len, windows)):
            for a in range(len(w) - n + 1):
                if (k := tuple(w[a : a + n])) in windows:
                    hit.update(range(a, a + n))
                    items |= windows[k]
        out[d] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("limit", [1 << 24, 200])
def test_decontamination(spark, docs, empty, texts, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", limit)
    bench = [(1, " ".join(texts[3][1].split()[:20])), (20, "ONE, two!"), (3, None), (None, "x"), (4, ""), (5, " ".join(texts[120 - 18][1].split()[5:40])), (20, "one two")]
    table = spark.createDataFrame(bench, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.benchmark_hits(docs, table).collect()}
    assert got == brute_hits(texts, bench)
    assert decontaminate.benchmark_hits(empty, table).count() == 0
    assert decontaminate.benchmark_hits(docs, table.where("false")).where("n_hit > 0 or contaminated").count() == 0


def brute_repeats(rows, n=400):
    seen = Counter(t[i : i + n] for _, t in rows for i in range(len(t) - n + 1))
    out = {}
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[d] = (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("cap", [16_000, 1])
def test_repeats(docs, empty, texts, monkeypatch, cap):
    monkeypatch.setattr(substrings, "CAP", cap)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.remove_repeats(docs).collect()}
    assert got == brute_repeats([(d, (t or "").encode()) for d, t in texts])
    assert substrings.remove_repeats(empty).count() == 0


def brute_passages(rows, n=50):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", low(t))) for d, t in rows]
    seen = Counter(tuple(w[i : i + n]) for _, w in words for i in range(len(w) - n + 1))
    return {d: len({j for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}) for d, w in words}


@pytest.mark.parametrize("cap", [16_000, 1])
def test_repeated_passages_of_words(docs, texts, spark, monkeypatch, cap):
    monkeypatch.setattr(substrings, "CAP", cap)
    rnd = random.Random(23)
    make = lambda n: " ".join(rnd.choice(["ab", "the", "Fin", "ouéa", "x"]) for _ in range(n))
    short = [make(n) for n in (49, 50, 51, 55, 59)]
    rows = [(300 + 2 * i + j, f"{make(10 + j)} {p if j else p.upper().replace('É', 'é')}\n{make(20 - i)}") for i, p in enumerate(short) for j in range(2)] + [(320, make(60)), (321, short[4] + "x")]
    assert max(len(p.encode()) for p in short) < 400
    more = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeats(docs.select("doc_id", "text").unionByName(more), with_words=True).collect()
    assert {r.doc_id: r.n_repeated_words for r in got} == brute_passages([*texts, *rows])
    planted = {r.doc_id: (r.n_repeated_words, r.n_removed) for r in got if r.doc_id >= 300}
    assert [planted[300 + i][0] >= n for i, n in ((0, 1), (2, 50), (4, 51), (7, 55), (8, 59), (20, 1))] == [False, True, True, True, True, False]
    assert {n for _, n in planted.values()} == {0}
    plain = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}
    assert plain == brute_repeats([(d, (t or "").encode()) for d, t in [*texts, *rows]])


def test_codes_of_words(texts, monkeypatch):
    raw = [(t or "").encode() for _, t in texts] + [b"One\0two  THREE\n", b" x", b""]
    whole = substrings.coded(raw)
    assert [len(c) // substrings.WORD for c in whole] == [len(re.findall(rb"[^\x20\x09-\x0D]+", t)) for t in raw]
    assert substrings.coded([b"\t a", b"A b"]) == [substrings.coded([b"a"])[0], b"".join(substrings.coded([b"a", b"B"]))]
    starts = lambda c: sorted((int(h), (g >> 20) - b) for h, g in zip(*(x.tolist() for x in substrings.sliced([c], substrings.WORD)[1::2]), strict=True) for b in range(g & 1023, (g >> 10 & 1023) + 1, substrings.WORD))
    want = [starts(c) for c in whole]
    assert [len(w) for w in want] == [max(0, len(c) // substrings.WORD - 49) for c in whole]
    monkeypatch.setattr(substrings, "SLICE", 80)
    assert substrings.coded(raw) == whole and substrings.coded(raw[-4:-3]) == whole[-4:-3] and len(raw[-4]) > 80 and substrings.coded([]) == []
    assert [starts(c) for c in whole] == want


def test_repeats_keep_bytes_and_repeated_rows(docs, texts):
    twice = docs.where("doc_id = 208").unionByName(docs.where("doc_id = 208"))
    got = substrings.remove_repeats(twice, with_kept=True).collect()
    assert [(r.n_removed, r.kept) for r in got] == [(len(dict(texts)[208].encode()), b"")] * 2


def test_column_order():
    rnd = random.Random(3)
    core = bytes(rnd.randrange(97, 100) for _ in range(900))
    segments = [core[100 - a : 100 - a + 400 + a - b] for a, b in ((50, 10), (30, 30), (90, 0))]
    found = substrings.column_order(segments, np.array([50, 30, 90]), np.array([10, 30, 0]), np.zeros(3, dtype=np.int64))
    assert [f.sum() for f in found] == [41, 1, 41]


def test_licences(docs, empty, texts, spark):
    assert len(licenses.rules()) > 200
    rows = [*texts, (300, "Under the MIT/License; THE mit-license. Apache License, Version 2.0! x cc by-nc 4.0"), (301, "mit der the mitlicense"), (302, "Licensed under the GNU General Public License, version 3. See https://www.gnu.org/licenses/gpl-3.0.html"), (303, "SPDX-License-Identifier: BSD-3-Clause")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    for d, t in rows:
        w = WORD.findall(low(t))
        places = sorted((i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None)
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1
    assert got[302].labels == "gpl-3.0" and got[303].labels == "bsd-3-clause" and got[301].labels == "" and "cc-by-nc-4.0" in got[300].labels
    assert licenses.scan_licenses(empty).count() == 0


def test_main_text(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class="sidebar"><p>Read this other very long thing too, please do.</p></div>
    <article><h1>Head &amp; more</h1><p>First   para with <b>bold</b>\n words&#33;<p>Second one here.<script>var a = "</p>"</script></p><form>Your name</form></article>
    <div id="comments"><p>I like this article a lot, thank you for writing it.</p></div><footer>&copy; x</footer></body></html>"""
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "plain &lt; text 1 < 2"), (1, "u", page), (5, "u", "<p>" + "<p>word here. " * 3000)]
    got = htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 6 and by[1].text == "Head & more First para with bold words! Second one here."
    assert by[2].text == "" == by[3].text and by[None].text == "plain < text 1 < 2" and by[5].text == " ".join(["word here."] * 3000)
    assert all(r.n_chars == len(r.text) for r in got)


def test_minimum_cut():
    rnd = random.Random(2)
    for _ in range(200):
        n = rnd.randint(1, 7)
        terminal = [(rnd.randint(0, 9), rnd.randint(0, 9)) for _ in range(n)]
        edges = [(a, b, rnd.randint(1, 5)) for a in range(n) for b in range(a) if rnd.random() < 0.5]
        cost = lambda s: sum(t if x else c for x, (c, t) in zip(s, terminal, strict=True)) + sum(c for a, b, c in edges if s[a] != s[b])
        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert cost(htmltext.minimum_cut(n, terminal, edges)) == best


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


FIXED = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(x := re.sub(r"[^0-9]", "", m)) <= 19 and luhn(x)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"[^0-9]", "", m)) <= 15),
)


def test_personal_data(spark, texts, empty):
    rnd = random.Random(7)
    parts = ["1", "22", "4111111111111111", "5500 0000 0000 0004", "a@b.c", "x", "+1", "555", "(", ")", "a", ".", " ", "-", "@", "256", "10.0.0.1", "é", "😀", ".com", "_", "%", "+", "\n"]
    rows = [*texts, *((1000 + i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))) for i in range(800)), (3000, "9" * 20000 + "@" + "a." * 5000), (None, "q a@b.cc")]
    got = pii.digest(pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    want = {}
    for d, t in rows:
        found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, ok) in enumerate(FIXED) for m in re.finditer(p, t or "") if ok(m[0])]
        n = Counter(k for _, k, _ in found)
        want[d] = (*(n[k] for k in range(4)), hashlib.sha256(",".join(x[2] for x in sorted(found)).encode()).hexdigest())
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got} == want
    assert pii.personal_data(empty).count() == 0


def test_revealing_terms(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    rows = [(i, " ".join(word() for _ in range(40))) for i in range(600)]
    rows += [(1000 + i, f"{word()} {word()} Zorbanax {word()} mail q.x@site.org {word()} the {word()} then zorbanax again") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.personal_data(df)
    marked = df.join(found.drop("k"), "doc_id").select("doc_id", pii.sanitised().alias("t")).collect()
    for r in marked:
        if r.doc_id < 1000:
            assert r.t == dict(rows)[r.doc_id]
        else:
            assert "orbanax" not in r.t and "site.org" not in r.t and "[EMAIL]" in r.t and r.t.count("[TERM]") >= 2


def test_archive(spark, tmp_path):
    page = "<p>" + "y" * 200
    rows = [(5, "http://a", page), (3, "http://b", page), (9, None, page), (4, "c", "short"), (6, "d\n", "short"), (7, "e", None), (8, "f", "zé\r\n\r\n" * 200_000), (None, "g", page), (3, "http://b", page)]
    chunks = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archive(chunks).collect()), key=repr)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = h == page and i != 3
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(want, key=repr)
    assert chunks.selectExpr("max(length(data))").first()[0] <= warc.CHUNK + 1000 and chunks.where("chunk > 5").count() > 1
    assert warc.export_warc(chunks, str(tmp_path / "x.warc")) == chunks.selectExpr("sum(length(data))").first()[0]
    assert (tmp_path / "x.warc").read_bytes().count(b"WARC/1.1\r\n") == len(rows)
    assert warc.read_archive(warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_packing(spark, docs, empty, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack_documents(docs).collect()
    by, seq = defaultdict(dict), defaultdict(list)
    for p in pieces:
        by[p.doc_id][p.piece] = p
        seq[p.sequence_id].append((p.offset, p.length))
    for d, t in texts:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        cut = [ids[i : i + 2048] for i in range(0, len(ids), 2048)]
        assert [(by[d][k].start, by[d][k].length, by[d][k].ids_crc32) for k in range(len(cut))] == [(2048 * k, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cut)]
    for own in seq.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 2048
    assert len(seq) <= 1.05 * sum(p.length for p in pieces) / 2048 + 1
    assert packing.pack_documents(empty).count() == 0


def test_tokenizer_odd_texts():
    import public_tokenizers

    t = packing.Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["İstanbul's ''s don't 12¼ ß  naïve_x\x0b　漢字 <|endoftext|> A'LL", " ", "", "x" * 5000, "áb é", "a\x0bb\x1cc\x0cd\x85e\x1f f\xa0g\te\rq", "a\x00b \x7f", "l'eau d'une c'est 'stuff ''ll !'s a's's'm x're-'ve '", "¿qué? ¡sí! «a» 12ab3 ×÷ ª²¼µ a1é2ß3", "a|b || | x|'s", "ÀÉÎ ñandú ŁÓDŹ ǅ ȿ"]
    rnd = random.Random(5)
    odd += ["".join(rnd.choice("ab'sreltmdv019 .,!-|éñ¿ß\n\tA") for _ in range(rnd.randint(0, 80))) for _ in range(3000)]
    assert [np.array(e.ids, "<u4").tobytes() for e in t.whole.encode_batch(odd, add_special_tokens=False)] == t.encode(odd)


TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_tokens(text):
    """(tokens, repetitions) by the definition: a token is its lower case and whether it is in capitals."""
    out, repeats, last = [], 0, None
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        if low(w) == last:
            repeats += 1
            continue
        last = low(w)
        out += [(low(t), not re.search("[a-z]", t) and len(re.findall("[A-Z]", t)) > 1) for t in TOKEN.findall(w)]
    return out, repeats


def brute_model(train, hash_of):
    """Probability of a word after two others, from plain counts of n-grams by context."""
    count = Counter(t for own, _ in train for t in own)
    rank = {t: i for i, (t, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], hash_of(x[0])))) if i < quality.CONTEXTS}
    hot = lambda t: rank.get(t, quality.HOT) < quality.HOT

    def classes(a, b):
        last = b if b in rank else None
        return last, (a if hot(a) else None, b) if last is not None and hot(b) else None

    three, two, one = Counter(), Counter(), Counter()
    plain = Counter()
    for own, _ in train:
        for a, b, w in zip([None, None, *own], [None, *own], own):
            last, pair = classes(a, b)
            plain[last, w] += 1
            if pair:
                three[pair, w] += 1
    for (pair, w) in three:
        two[pair[1], w] += 1
    for last, w in plain:
        one[w] += 1

    def discounts(values):
        n = Counter(values)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        raw = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0 for i in (1, 2, 3)]
        return [0, *(r if 0 < r < i else 0.5 * i for i, r in enumerate(raw, 1))]

    single = {k: n for k, n in plain.items() if k[0] is None or not hot(k[0])}
    d3, d2, d1, d4 = (discounts(x.values()) for x in (three, two, one, single))

    def level(counts, d):
        total, left = Counter(), Counter()
        for (c, w), n in counts.items():
            total[c] += n
            left[c] += d[min(n, 3)]
        return lambda c, w, lower: (counts.get((c, w), 0) - d[min(counts.get((c, w), 0), 3)]) / total[c] + left[c] / total[c] * lower if total[c] else lower

    by3, by2, by4, by1 = level(three, d3), level(two, d2), level(single, d4), level({((), w): n for w, n in one.items()}, d1)

    def p(a, b, w):
        last, pair = classes(a, b)
        q = by1((), w, 1 / (len(count) + 1))
        q = by2(last, w, q) if pair else by4(last, w, q)
        return by3(pair, w, q) if pair else q

    return p, count


def test_kneser_ney_by_definition(spark):
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("abcdefgéß") for _ in range(rnd.randint(2, 7))) for _ in range(14_000)]
    weights = [1 / (i + 60) for i in range(len(vocabulary))]
    rows = []
    for i in range(260):
        words = rnd.choices(vocabulary, weights, k=rnd.randint(1, 260))
        words = [rnd.choice([w, w, w, w.title(), w + ".", w.upper() + "!!", f"{w} {w}"]) for w in words]
        rows.append((i, "".join(w + rnd.choice(" \n") for w in words), rnd.choice(["en", "de"])))
    rows += [(1000, "neverseen WORDS here, %%% at all", "en"), (1001, "x", "fr"), (1002, "a\x00b \x07", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(260)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    held = {r.doc_id for r in docs.selectExpr("doc_id", f"pmod(xxhash64(text), {quality.HELD}) = 0 h").where("h").collect()} & set(range(260))
    own = {i: brute_tokens(t) for i, t, _ in rows}
    train = [own[i] for i in range(260) if i not in held]

    def hash_of(t):
        return quality.tokens([(t[0].upper() if t[1] else t[0]).encode()])[0].view(np.int64)[0]

    p, count = brute_model(train, hash_of)
    assert len(count) > quality.CONTEXTS
    for context in ((None, None), *list(zip(train[0][0], train[0][0][1:]))[:6]):
        assert abs(sum(p(*context, w) for w in [*count, "never"]) - 1) < 1e-9
    repeats, total = sum(r for _, r in train), sum(count.values())
    r, stay = np.log2((total + repeats + 2) / (repeats + 1)), np.log2((total + repeats + 2) / (total + 1))
    bits = {i: len(o) * stay + n * r - sum(np.log2(p(a, b, w)) for a, b, w in zip([None, None, *o], [None, *o], o)) for i, (o, n) in own.items()}
    low_ = lambda v, q: sorted(v)[max(0, int(np.ceil(q * len(v))) - 1)]
    lang = {i: x for i, _, x in rows}
    limits = []
    for use in ("en", "de", "all", "fr"):
        calibrated = [i for i in held if lang[i] == use] or list(held)
        middle = low_([bits[i] / len(own[i][0]) for i in calibrated], 0.5)
        s = lambda i: (bits[i] + quality.PRIOR * middle) / (len(own[i][0]) + quality.PRIOR)  # noqa: E731, B023
        limits.append(low_([s(i) for i in calibrated], quality.UPPER) + quality.MARGIN)
        limit = max(limits) if use == "fr" else limits[-1]
        for i in (i for i in own if lang[i] == use):
            assert abs(np.log2(got[i].perplexity) - s(i)) < 1e-3 and abs(np.log2(got[i].threshold) - limit) < 1e-3, (i, use)
            assert got[i].n_words == len(own[i][0]) and got[i].kept == (s(i) <= limit)


def test_quality_of_odd_tables(spark, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = [(1, "Good words are here, all of them. " * 5 + str(i), "en", "x") for i in range(9)] + [(None, "Good words here.", None, "x"), (3, None, "en", "x"), (3, None, "en", "x"), (4, "   ", "de", "x"), (5, "w " * 200_000 + "z" * 300_000, "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, word string").withColumn("held", F.lit("y")).withColumn("kind", F.lit(3))
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(rows) and sorted(r.kept for r in got if r.doc_id in (3, 4)) == [False] * 3
    assert all(r.kept for r in got if r.doc_id in (1, None)) and [r.n_words for r in got if r.doc_id == 5] == [2]
    assert quality.quality(empty, labels).count() == 0
    assert quality.quality(docs.where("false"), labels.where("false")).count() == 0


def test_quality(spark):
    d, labels = spark.read.parquet(f"{DATA}/../sf0.01/documents.parquet"), spark.read.parquet(f"{DATA}/../sf0.01/labels.parquet")
    more = spark.createDataFrame([(-1, None, "en"), (-2, "", None), (-3, "hello there", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.quality(d.select("doc_id", "text", "lang").unionByName(more), labels).collect()}
    known = {(r.doc_id): (r.quality, r.toxic) for r in labels.collect()}
    rate = lambda q: np.mean([got[i].kept for i, x in known.items() if x == q])
    assert rate((1, 0)) >= 0.98 and rate((0, 0)) <= 0.1 and rate((1, 1)) <= 0.35
    assert not got[-1].kept and not got[-2].kept and got[-1].perplexity is None
    untrained = quality.quality(more, labels.where("false")).collect()
    assert [r.kept for r in sorted(untrained, key=lambda r: r.doc_id)] == [True, False, False]


@pytest.mark.parametrize("copies", [1, 3])
def test_neighbours(spark, copies):
    rnd = np.random.default_rng(9)
    x = np.vstack([rnd.standard_normal((300, 16))] * copies)
    rows = [(i, [float(y) for y in v]) for i, v in enumerate(x)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0]), (None, [1.0] * 16), (0, [float(y) for y in x[0]])]
    got = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = x.astype(np.float32).astype(float)
    shares = []
    for q in range(0, len(x), 20):
        score = np.array([sum(a * b for a, b in zip(x[q], v, strict=True)) for v in x])
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -score))[:20]
        shares.append(len({v for v, _ in got[q]} & set(best.tolist())) / 20)
        assert all(abs(score[v] - s) < 1e-9 for v, s in got[q]) and len(got[q]) == 20
    assert np.mean(shares) >= 0.9


def brute_near(rows):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    head = {d: d for d in sets}

    def find(d):
        while head[d] != d:
            d = head[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


@pytest.mark.parametrize(("cap", "slab", "hot"), [(48, 256, 200), (1, 2, 2)])
def test_near_duplicates(docs, empty, texts, monkeypatch, cap, slab, hot):
    monkeypatch.setattr(minhash, "CAP", cap)
    monkeypatch.setattr(minhash, "SLAB", slab)
    monkeypatch.setattr(minhash, "HOT", hot)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == brute_near(texts)
    assert minhash.near_duplicates(empty).count() == 0


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000, 1000), (None, 5)] + [(2000 + i, 2001 + i) for i in range(40)]
    head = {}
    find = lambda x: x if head.setdefault(x, x) == x else find(head[x])
    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            head[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in head}


def test_components_in_few_tasks(spark):
    links = [(0, i) for i in range(1, 200)] + [(1000 + i, 1001 + i) for i in range(5)]
    table = spark.createDataFrame(links, "a long, b long")
    own = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in own}
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    sc.setJobGroup("components", "components")
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        got = {r.node: r.component for r in components.connected_components(table).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {x: 0 for x in range(200)} | {1000 + i: 1000 for i in range(6)}
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    assert sum(x.numCompletedTasks for s in stages if (x := tracker.getStageInfo(s))) < 500


def test_words():
    w = tc.split([b"ab C1", b"", b"x-AB"], tc.ALNUM)
    assert [w.word(i) for i in range(4)] == [b"ab", b"c1", b"x", b"ab"] and w.first.tolist() == [0, 2, 2, 4]
    h = w.hashes()
    assert h[0] == h[3] and len(set(h.tolist())) == 3


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    pieces = corpus_pipeline.run(spark, DATA).collect()
    kept = {p.doc_id for p in pieces}
    assert kept and len({(p.doc_id, p.piece) for p in pieces}) == len(pieces)
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    good = {r.doc_id for r in quality.quality(d, spark.read.parquet(f"{DATA}/labels.parquet")).where("kept").collect()}
    assert kept <= good
    near = brute_near([(r.doc_id, r.text) for r in d.collect() if r.doc_id in good])
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    firsts = {i for i, x in near.items() if x[2]}
    hits = brute_hits([(r.doc_id, r.text) for r in d.collect() if r.doc_id in firsts], bench)
    assert kept == {i for i in firsts if not hits[i][4]}
