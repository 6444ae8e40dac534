"""Prefix trie, scores by partial matching and whitening against brute-force versions, with odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from lexloom.llm import ppm, prefixtrie, queries, whitening

SF = "/root/testdata/sf0.001"


# --- conversations


def brute_trie(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {}
    for c in by:
        h = zlib.crc32(str(c).encode()) % 6
        own = [x[2:] for x in sorted(by[c])]
        base = int(math.fmod(c, 100))
        paths[c] = tuple([x[2:] for x in sorted(by.get(c - base, []))][:h] + own[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, own in members.items():
        value = (len(own) - 1) * len(k[-1][1]) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += value
    out = []
    for k, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(paths[c]) == len(k))))
        out.append((min(own), len(k), min(members[k[:-1]]) if k else None, len(own), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def invented_conversations(seed=3, convs=60):
    rnd = random.Random(seed)
    say = ["hi", "what?", "é so", "", None, "a long answer " * 5]
    ids = [*range(0, convs), *range(150, 170), *range(300, 305), -3, -100, -120, -7]
    rows = []
    for c in ids:
        n = rnd.choice([1, 2, 3, 5, 8, 15]) if c != 17 else 40
        rows += [(c, rnd.choice([t, t, None]), rnd.choice(["user", "assistant", None]), rnd.choice(say)) for t in range(n)]
    rows += [r for r in rows if r[0] == 5] * 2 + [(c, t, "user", f"same {t}") for c in (1001, 1002, 1203, 1304) for t in range(9)]
    rows.append((None, 0, "user", "nobody's"))
    rnd.shuffle(rows)
    return rows




@pytest.mark.parametrize("run", [6, 4096])
def test_prefix_trie(spark, monkeypatch, run):
    monkeypatch.setattr(prefixtrie, "RUN", run)
    rows = invented_conversations()
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn long, role string, text string, k1 int, base int, pos int").repartition(7)
    got = sorted((tuple(r) for r in prefixtrie.prefix_trie(df).collect()), key=repr)
    assert got == brute_trie(rows)


def test_prefix_trie_hot_and_long(spark, monkeypatch):
    """One conversation with most of the rows, in many equal turns, and many copies of another."""
    monkeypatch.setattr(prefixtrie, "RUN", 50)
    rows = [(7, t // 3, "user", "again") for t in range(900)] + [(c, t, "user", f"x{t}") for c in range(2000, 2060) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(9)
    assert sorted((tuple(r) for r in prefixtrie.prefix_trie(df).collect()), key=repr) == brute_trie(rows)


def test_prefix_trie_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefixtrie.prefix_trie(df).count() == 0


def test_prefix_trie_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = duck.execute(queries.oracle_sql()["op11_prefix_trie"])
    names = [d[0] for d in want.description]
    got = queries.queries()["op11_prefix_trie"](spark, SF).select(*names)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


# --- prediction by partial matching


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode()


class BrutePPM:
    def __init__(self, texts, order):
        self.order, self.after = order, defaultdict(Counter)
        for t in texts:
            s = b"\xff" * order + t + b"\xff"
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.after[s[i - k : i]][s[i]] += 1

    def chance(self, context, symbol):
        p, out = 1.0, set()
        for k in range(self.order, -1, -1):
            have = self.after.get(context[len(context) - k :])
            if not have:
                continue
            mass = sum(n for x, n in have.items() if x not in out)
            fresh = sum(x not in out for x in have)
            if not fresh:
                continue
            whole = mass + (fresh if len(have) < 256 else 0)
            if symbol in have and symbol not in out:
                return p * have[symbol] / whole
            p *= fresh / whole
            out |= set(have)
        return p / (256 - len(out))

    def log10(self, t):
        s = b"\xff" * self.order + t + b"\xff"
        return sum(math.log10(self.chance(s[i - self.order : i], s[i])) for i in range(self.order, len(s)))


def brute_scores(rows):
    import re

    words = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", lower(t)) + [None]
    train = [t for i, t in rows if not held(i)]
    c = Counter(w for t in train for w in words(t))
    n, v = sum(c.values()), len(c)
    model = BrutePPM([lower(t) for t in train], ppm.ORDER)
    return [(i, held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)), model.log10(lower(t))) for i, t in rows]


def invented_texts(seed=5):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    make = lambda n: " ".join(rnd.choice(vocabulary).title() for _ in range(n))
    rows = [(i, make(rnd.randint(0, 40))) for i in range(60)] + [(100 + i, None) for i in range(6)] + [(200, ""), (201, "x" * 700), (202, " \t\n"), (None, "nobody's"), (203, "\x00 odd 　"), (203, "other")]
    return rows + [rows[3]] * 5 + [(i, make(300)) for i in range(300, 304)]


@pytest.mark.parametrize("small", [True, False])
def test_scores(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK", 900), ("CHUNK", 64), ("PENDING", 50)):
            monkeypatch.setattr(ppm, name, value)
        monkeypatch.setattr(ppm, "SHARDS", (3, 5))
    rows = invented_texts()
    df = spark.createDataFrame([(i, t, 1, "b", 2) for i, t in rows], "doc_id long, text string, kind int, block string, units int").repartition(3)
    key = lambda r: (str(r[0]), r[2], round(r[6], 6))
    got, want = sorted((tuple(r) for r in ppm.score(df).collect()), key=key), sorted(brute_scores(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-6, atol=1e-5)


def test_scores_are_probabilities():
    """All symbols after any context sum up to 1."""
    rnd = np.random.default_rng(2)
    keys, n = ppm.summed(rnd.integers(0, 6, (400, ppm.ORDER + 1)) @ (np.uint64(256) ** np.arange(ppm.ORDER, -1, -1, dtype=np.uint64)), np.ones(400, np.int64))
    trie = ppm.levels(keys.astype(np.uint64), n, ppm.ORDER)
    for context in (int(keys[0]) >> 8, int(keys[7]) >> 8, 0x0102030405, 0x0909090901):
        every = np.array([context << 8 | s for s in range(256)], dtype=np.uint64)
        assert abs((2.0 ** -(ppm.code_lengths(every, trie) / ppm.UNIT)).sum() - 1) < 1e-5


def test_scores_without_training_texts(spark):
    only = next(i for i in range(100) if held(i))
    row = ppm.score(spark.createDataFrame([(only, "ab")], "doc_id long, text string")).collect()
    assert len(row) == 1 and row[0].train_tokens == 0 and row[0].n_known == 0
    assert row[0].base_score == pytest.approx(0) and row[0].score == pytest.approx(-3 * math.log10(256), abs=1e-5)
    assert ppm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_held_out_texts_of_the_language_score_better(spark):
    """Held-out accuracy: a text scores better than its own letters shuffled."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 200").select("doc_id", "text")
    rows = [r for r in docs.collect() if held(r.doc_id)]
    rnd = random.Random(1)
    ids = [i for i in range(10**6, 10**6 + 2000) if held(i)][: len(rows)]
    shuffled = spark.createDataFrame([(i, "".join(rnd.sample(r.text, len(r.text)))) for i, r in zip(ids, rows, strict=True)], "doc_id long, text string")
    by = {r.doc_id: r.score for r in ppm.score(docs.unionByName(shuffled)).collect()}
    assert np.mean([by[r.doc_id] > by[i] for r, i in zip(rows, ids, strict=True)]) > 0.95


# --- whitening


def check_whitened(rows, vectors, components=8):
    ids, x = zip(*vectors, strict=True)
    x = np.floor(1024 * np.array(x, dtype=float)).astype(int) + 100000
    n = len(x)
    deviation = ((n * x - x.sum(0)) ** 2).sum(1)
    c = x - x.sum(0) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    m = int((e > 1e-12 * np.trace(v)).sum())
    assert len(rows) == n * m
    by = defaultdict(list)
    for r in rows:
        by[r.component].append(r)
    ours = np.zeros((n, m))
    for k in range(m):
        mine = sorted(by[k + 1], key=lambda r: (str(r.vec_id), r.deviation))
        order = sorted(range(n), key=lambda i: (str(ids[i]), deviation[i]))
        assert [(r.vec_id, r.deviation, r.n) for r in mine] == [(ids[i], deviation[i], n) for i in order]
        got = np.array([r.whitened for r in mine])
        want = (c @ u[:, k] / np.sqrt(e[k]))[order]
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
        assert abs(mine[0].explained - e[k] / np.trace(v)) < 1e-10
        ours[:, k] = got
    if m:
        assert rows[0].identity_error < 1e-8 and np.abs(ours.T @ ours / n - np.eye(m)).max() < 1e-8


def test_whitened(spark):
    rnd = np.random.default_rng(1)
    vectors = [(i, (rnd.standard_normal(24) * np.linspace(2, 0.1, 24)).astype(np.float32).tolist()) for i in range(300)]
    vectors += [(5, vectors[5][1]), (None, vectors[6][1])]
    odd = [(900, None), (901, [1.0] * 23 + [None]), (902, [float("nan")] + [0.0] * 23), (903, [float("inf")] * 24), (904, []), (905, [1.0])]
    df = spark.createDataFrame([(i, v, 7) for i, v in vectors + odd], "vec_id long, embedding array<float>, x int").repartition(5)
    check_whitened(whitening.whitened(df).collect(), vectors)


def test_whitened_of_low_rank(spark):
    """Fewer directions than components, and none at all."""
    vectors = [(i, [float(i % 7), 2.0 * (i % 7), 1.0, float(i % 3)]) for i in range(40)]
    check_whitened(whitening.whitened(spark.createDataFrame(vectors, "vec_id long, embedding array<float>")).collect(), vectors)
    for rows in ([], [(1, [1.0, 2.0])], [(1, None)]):
        assert whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def test_whitened_of_huge_entries(spark):
    """Deviations beyond 64 bits are null; nothing overflows."""
    rows = [(i, [1e12 * (i + 1), 1e300, -1e300 * (i % 2)]) for i in range(5)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert got and all(r.deviation is None and math.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("d,block,blocks", [(40, 3, 5), (120, 8, 4), (30, 16, 12)])
def test_block_lanczos(d, block, blocks):
    """Restarts, equal eigenvalues and breakdowns."""
    rnd = np.random.default_rng(d)
    q, _ = np.linalg.qr(rnd.standard_normal((d, d)))
    for e in (np.linspace(5, 1, d), np.r_[[9.0] * 4, [3.0] * (d - 4)], np.r_[[4.0, 2.0], np.zeros(d - 2)], 0.8 ** np.arange(d)):
        a = (q * e) @ q.T
        values, vectors = whitening.block_lanczos(lambda x, a=a: a @ x, d, e.sum(), 8, block, blocks)
        want = np.sort(e)[::-1][:8]
        assert np.allclose(values, want[want > 1e-12 * e.sum()], atol=1e-12 * e.sum())
        assert np.abs(a @ vectors - vectors * values).max() < 1e-11 * e.sum() and np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
