"""A modified Kneser-Ney model of order 3 in which every word and every pair of words is a context.

Nothing is pooled or pruned: all tables grow with the trusted text, and none is sent anywhere as a whole. The bits of a text are a sum
over its words, pairs and triples, each of which has two whole numbers by a 64-bit hash: what it adds where it is predicted, beside what its
shorter forms add, and what it adds as a context (the mass that it leaves to shorter ones). So triples, pairs and words of documents meet one
table, sharded by ranges of that hash; the HOT most frequent of each, of a fixed greatest size, are sent to all tasks and not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm import textcore as tc
from lexloom.llm.store import drop, keep

#: Words, pairs and triples, each, that are sent to all tasks.
HOT = 8192
#: Tokens of trusted text behind a shard, at most; entries of documents in a block, and rows of values that are packed at once.
SHARD, BLOCK, ROWS = 2_000_000, 1_500_000, 1_000_000
#: What stands before a text.
START = np.uint64(0x5851F42D4C957F2D)
UNIT = 65536.0  # sums are of whole parts of a bit, so that their order doesn't matter
_LEFT, _RIGHT = np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hashes of pairs of a hash (of a word, or of a pair) and a word."""
    return tc.mix(tc.mix(x * _LEFT) + y * _RIGHT)


def before(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token of a block of texts, and the one before that."""
    inside = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
    a, b = np.full(len(h), START), np.full(len(h), START)
    b[1:], a[2:] = h[:-1], h[:-2]
    b[inside < 1], a[inside < 2] = START, START
    return a, b


def _runs(*sorted_: np.ndarray) -> np.ndarray:
    new = np.zeros(len(sorted_[0]), dtype=bool)
    new[:1] = True
    for x in sorted_:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def counter(tokens, most: int):
    """(ab, b, w, n) of trusted texts: triples by the hash of their first two words, counted in blocks of so many tokens."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            ab, b, w = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((w, ab))
            ab, b, w = ab[order], b[order], w[order]
            at = _runs(ab, w)
            n = np.diff(np.r_[at, len(ab)])
            return pa.record_batch([pa.array(x[at].view(np.int64)) for x in (ab, b, w)] + [pa.array(n)], ["ab", "b", "w", "n"])

        for _, texts in tc.batches(frames):
            h, first, _ = tokens(texts)
            a, b = before(h, first)
            held.append((joined(a, b), b, h))
            if sum(len(x[0]) for x in held) >= most:
                yield flush()
        if held:
            yield flush()

    return count


def _discounts(table: DataFrame, n: str) -> list[float]:
    """By count 1, 2 and more, from how many rows have which count."""
    c = {r[n]: r["count"] for r in table.where(F.col(n) <= 4).groupBy(n).count().collect()}
    c = [0, *(c.get(i, 0) for i in (1, 2, 3, 4))]
    y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.0
    raw = [i - (i + 1) * y * c[i + 1] / c[i] if c[i] else 0.0 for i in (1, 2, 3)]
    return [r if 0 < r < i else 0.5 * i for i, r in enumerate(raw, 1)]


def _rest(n: str, d: list[float]) -> Column:
    """A count less its discount."""
    return F.col(n) - F.when(F.col(n) == 1, d[0]).when(F.col(n) == 2, d[1]).otherwise(d[2])


def _sums(n: str, total: str) -> list[Column]:
    return [F.sum(n).alias(total), F.count_if(F.col(n) == 1).alias("c1"), F.count_if(F.col(n) == 2).alias("c2"), F.count_if(F.col(n) > 2).alias("c3")]


def _mass(d: list[float]) -> Column:
    return F.col("c1") * d[0] + F.col("c2") * d[1] + F.col("c3") * d[2]


def _bits(p: Column) -> Column:
    return F.round(-F.log2(p) * UNIT).cast("int")


def _packer(pack, split, shards: int):
    """(shard, data) of rows of values: their hashes, sorted, and what they add. Without x, the word itself is the hash; without w, x is."""

    def work(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            key, pred, ctx = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(key)
            key, pred, ctx = key[order], pred[order], ctx[order]
            shard = split(key, shards)
            cut = np.r_[_runs(shard), len(shard)]
            rows = [(int(shard[a]), pack(key[a:b], pred[a:b], ctx[a:b])) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "data"])

        for frame in frames:
            x, w = (frame.column(c) for c in ("x", "w"))
            no_x, no_w = (c.is_null().to_numpy(zero_copy_only=False) for c in (x, w))
            x, w = (c.fill_null(0).to_numpy().view(np.uint64) for c in (x, w))
            key = np.where(no_x, w, np.where(no_w, x, joined(x, w)))
            held.append((key, *(frame.column(c).to_numpy().astype(np.int32) for c in ("pred", "ctx"))))
            if sum(len(k[0]) for k in held) >= ROWS:
                yield flush()
        if held and sum(len(k[0]) for k in held):
            yield flush()

    return work


@dataclass
class Model:
    """What every task needs, of a greatest size that does not depend on the corpus: the HOT values, the bits of a word that was never seen, those
    of a repetition, and those of none."""

    keys: np.ndarray
    pred: np.ndarray
    ctx: np.ndarray
    unseen: float
    repeat: float
    stay: float

    def entries(self, h: np.ndarray, first: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """Of a block of texts: parts of bits of each that are known here, and (hash, text, weight) of all else. A weight is twice how often
        it stands there, and 1 more if it ends the text, where it is no context."""
        size = np.diff(first)
        full = np.flatnonzero(size)
        owner = np.repeat(np.arange(len(size)), size)
        a, b = before(h, first)
        weight = np.full(len(h), 2)
        weight[first[1:][full] - 1] = 3
        ab = joined(a, b)
        begin = np.full(len(full), START)
        key = np.concatenate([h, joined(b, h), joined(ab, h), begin, joined(begin, begin)])
        doc = np.concatenate([owner, owner, owner, full, full])
        weight = np.concatenate([weight, weight, np.full(len(h), 2), np.full(2 * len(full), 2)])
        found, at = find(self.keys, key)
        sums = np.round((repeats * self.repeat + size * (self.stay + self.unseen)) * UNIT)
        sums += np.bincount(doc[found], added(self.pred[at[found]], self.ctx[at[found]], weight[found]), minlength=len(size))
        return sums, (key[~found], doc[~found], weight[~found])


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether wanted keys are among the sorted ones, and where."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def added(pred: np.ndarray, ctx: np.ndarray, weight: np.ndarray) -> np.ndarray:
    n = weight >> 1
    return n * pred.astype(np.int64) + (n - (weight & 1)) * ctx.astype(np.int64)


def summed(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes and their values: one may come from several rows, as a word or pair and as a context."""
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    key, pred, ctx = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key)
    key, pred, ctx = key[order], pred[order].astype(np.int64), ctx[order].astype(np.int64)
    at = _runs(key)
    return key[at], np.add.reduceat(pred, at), np.add.reduceat(ctx, at)


def _picker(unpack, sent):
    """Rows of packed values whose hashes were sent."""

    def pick(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for data in frame.column("data"):
                key, pred, ctx = unpack(data.as_py(), "u8", "i4", "i4")
                found, _ = find(sent.value, key)
                yield pa.record_batch([pa.array(key[found].view(np.int64)), pa.array(pred[found]), pa.array(ctx[found])], ["key", "pred", "ctx"])

    return pick


def fit(train: DataFrame, words: DataFrame, facts, shards: int, tokens, block: int, pack, unpack, split) -> tuple[Model, DataFrame]:
    """The model of trusted texts, and its table of (shard, data)."""
    spark = train.sparkSession
    grams = keep(train.mapInArrow(counter(tokens, block), "ab long, b long, w long, n long").groupBy("ab", "b", "w").agg(F.sum("n").alias("n")), "grams")
    pairs = keep(grams.groupBy("b", "w").agg(F.count("*").alias("n2"), F.sum("n").alias("n")), "pairs")
    counted = keep(pairs.groupBy("w").agg(F.count("*").alias("n1")), "words")
    d3, d2, d1 = _discounts(grams, "n"), _discounts(pairs, "n2"), _discounts(counted, "n1")
    one = counted.agg(F.count("*").alias("words"), *_sums("n1", "total")).withColumn("mass", _mass(d1)).first()
    unseen = one.mass / one.total / (one.words + 1)
    by_w = counted.withColumn("p1", _rest("n1", d1) / one.total + F.lit(unseen))
    by_b = keep(pairs.groupBy("b").agg(*_sums("n2", "total")).select("b", "total", _mass(d2).alias("mass")), "contexts")
    by_ab = keep(grams.groupBy("ab").agg(*_sums("n", "total")).select("ab", "total", _mass(d3).alias("mass")), "contexts")
    two = pairs.join(by_w.select("w", "p1").hint("merge"), "w").join(by_b.hint("merge"), "b")
    rest = _rest("n2", d2)
    two = two.select("b", "w", ((rest + F.col("mass") * F.col("p1")) / F.col("total")).alias("p2"), _bits(1 + rest / (F.col("mass") * F.col("p1"))).alias("pred"))
    two = keep(two, "pairs")
    three = grams.join(two.select("b", "w", "p2").hint("merge"), ["b", "w"]).join(by_ab.select("ab", "mass").hint("merge"), "ab")
    none, null = F.lit(0), F.lit(None).cast("long")
    left = _bits(F.col("mass") / F.col("total"))
    rows = three.select(F.col("ab").alias("x"), "w", _bits(1 + _rest("n", d3) / (F.col("mass") * F.col("p2"))).alias("pred"), none.alias("ctx"))
    rows = rows.unionByName(two.select(F.col("b").alias("x"), "w", "pred", none.alias("ctx")))
    rows = rows.unionByName(by_ab.select(F.col("ab").alias("x"), null.alias("w"), none.alias("pred"), left.alias("ctx")))
    rows = rows.unionByName(by_w.select(null.alias("x"), "w", _bits(F.col("p1") / F.lit(unseen)).alias("pred"), none.alias("ctx")))
    rows = rows.unionByName(by_b.select(null.alias("x"), F.col("b").alias("w"), none.alias("pred"), left.alias("ctx")))
    values = keep(rows.mapInArrow(_packer(pack, split, shards), "shard int, data binary"), "values")
    most = lambda rows, *c: [rows.orderBy(F.desc("n"), *c).limit(HOT).select(*c).toArrow()[x].to_numpy().view(np.uint64) for x in c]
    begin = np.array([START])
    hot = np.unique(np.concatenate([*most(words.where("word is not null"), "word"), joined(*most(pairs, "b", "w")), joined(*most(grams, "ab", "w")), begin, joined(begin, begin)]))
    for done in (grams, pairs, counted, by_b, by_ab, two):
        drop(spark, done)
    sent = spark.sparkContext.broadcast(hot)
    got = values.mapInArrow(_picker(unpack, sent), "key long, pred int, ctx int").toArrow()
    sent.destroy()
    keys, pred, ctx = summed([[got["key"].to_numpy().view(np.uint64), got["pred"].to_numpy(), got["ctx"].to_numpy()]] if got.num_rows else [])
    repeats = facts.repeats or 0
    all_ = facts.total + repeats + 2
    return Model(keys, pred, ctx, float(-np.log2(unseen)), np.log2(all_ / (repeats + 1)), np.log2(all_ / (facts.total + 1))), values
