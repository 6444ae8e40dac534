"""The Kneser-Ney model with every word and pair of words as a context, against its definition."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lexloom.llm import contexts, quality

MARKS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def brute_tokens(text):
    """(tokens, repetitions) of lower-case text."""
    out, repeats, last = [], 0, None
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        if w == last:
            repeats += 1
            continue
        last = w
        out += re.findall(rf"[^{MARKS}]+|[{MARKS}]+", w)
    return out, repeats


def brute_model(train):
    """Probability of a word after two others, from plain counts; None stands before a text."""
    three = Counter(t for own in train for t in zip([None, None, *own], [None, *own], own))
    two = Counter((b, w) for _, b, w in three)
    one = Counter(w for _, w in two)

    def level(counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        raw = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0 for i in (1, 2, 3)]
        d = [0, *(r if 0 < r < i else 0.5 * i for i, r in enumerate(raw, 1))]
        total, left = Counter(), Counter()
        for key, c in counts.items():
            total[key[:-1]] += c
            left[key[:-1]] += d[min(c, 3)]

        def p(key, lower):
            c, context = counts.get(key, 0), key[:-1]
            return (c - d[min(c, 3)]) / total[context] + left[context] / total[context] * lower if total[context] else lower

        return p

    by3, by2, by1 = level(three), level(two), level({(w,): n for w, n in one.items()})
    return lambda a, b, w: by3((a, b, w), by2((b, w), by1((w,), 1 / (len(one) + 1)))), one


@pytest.mark.parametrize("hot", [contexts.HOT, 3])
def test_every_context_by_definition(spark, monkeypatch, hot):
    monkeypatch.setattr(contexts, "HOT", hot)
    monkeypatch.setattr(contexts, "SHARD", 4000)
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdefgéß") for _ in range(rnd.randint(2, 7))) for _ in range(14_000)]
    weights = [1 / (i + 900) for i in range(len(vocabulary))]
    rows = []
    for i in range(260):
        words = rnd.choices(vocabulary, weights, k=rnd.randint(1, 260))
        words = [rnd.choice([w, w, w, w + ".", f"{w} {w}"]) for w in words]
        if i % 5 == 0:  # phrases of rare words, whose order the model is to know
            words += vocabulary[-40:]
        rows.append((i, " ".join(words), rnd.choice(["en", "de"])))
    rows += [(1000, "neverseen words here, %%% at all", "en"), (1001, "x", "fr"), (1002, " ".join(vocabulary[-40:]), "en"), (1003, " ".join(sorted(vocabulary[-40:])), "en"), (1004, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(260)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality(docs, labels, every_context=True).collect()}
    held = {r.doc_id for r in docs.selectExpr("doc_id", f"pmod(xxhash64(text), {quality.HELD}) = 0 h").where("h").collect()} & set(range(260))
    own = {i: brute_tokens(t) for i, t, _ in rows}
    train = [own[i] for i in range(260) if i not in held]
    p, one = brute_model([t for t, _ in train])
    assert len(one) > 6000
    for a, b in ((None, None), *list(zip(train[0][0], train[0][0][1:]))[:4]):
        assert abs(sum(p(a, b, w) for w in [*one, "never"]) - 1) < 1e-9
    repeats, total = sum(r for _, r in train), sum(len(t) for t, _ in train)
    r, stay = np.log2((total + repeats + 2) / (repeats + 1)), np.log2((total + repeats + 2) / (total + 1))
    bits = {i: len(o) * stay + n * r - sum(np.log2(p(a, b, w)) for a, b, w in zip([None, None, *o], [None, *o], o)) for i, (o, n) in own.items()}
    middle_of = lambda v: sorted(v)[max(0, int(np.ceil(0.5 * len(v))) - 1)]
    lang = {i: x for i, _, x in rows}
    for i, (o, _) in own.items():
        if not o:
            assert got[i].perplexity is None and not got[i].kept
            continue
        of = [j for j in held if lang[j] == lang[i]] or list(held)
        middle = middle_of([bits[j] / len(own[j][0]) for j in of])
        assert got[i].n_words == len(o) and abs(np.log2(got[i].perplexity) - (bits[i] + quality.PRIOR * middle) / (len(o) + quality.PRIOR)) < 1e-3, i
    # Rare words in the order in which they were read are no surprise, in another they are.
    assert 2 * got[1002].perplexity < got[1003].perplexity


def test_every_context_without_texts(spark):
    docs = spark.createDataFrame([(1, "Good words here.", "en"), (2, None, None), (3, "  ", "en")], "doc_id long, text string, lang string")
    none = quality.quality(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), every_context=True).collect()
    assert sorted((r.doc_id, r.perplexity, r.kept) for r in none) == [(1, None, True), (2, None, False), (3, None, False)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.quality(docs, labels, every_context=True).count() == 3 and quality.quality(docs.where("false"), labels, every_context=True).count() == 0


def test_pipeline_takes_every_context(spark):
    import corpus_pipeline

    data = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    ids = lambda rows: {r.doc_id for r in rows.select("doc_id").collect()}
    kept = ids(corpus_pipeline.quality_stage(spark, docs, data))
    assert kept == ids(quality.quality(docs, labels, every_context=True).where("kept"))
