"""Scores of texts by prediction by partial matching: a trie of byte contexts, counted on the training texts.

A symbol is a byte of the text with A-Z lower-cased, or its end; it is predicted from the ORDER symbols before it (ends before the
beginning). Where a context has not seen it, an escape leads to the context without its oldest symbol, in which all symbols of the
longer one are excluded, down to all symbols alike. A context escapes with the weight of the number of symbols that it adds (method C).

Texts are put in blocks. A block's different grams (context and symbol) and words are counted once, packed by shard, and summed up
there to the trie; the same packs then get the code length of each gram from their shard, and meet their block's texts again. Grams of
the same last three context symbols share a shard, so that it has all contexts of three symbols and more, and no shard key has more than
256 ** 3 grams; contexts of two symbols and fewer, 256 ** 3 counts at most, are sent to all. What is gathered grows with the
different grams and words of the corpus.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import textcore as tc
from lexloom.llm.quality import pack, unpack
from lexloom.llm.store import keep

#: Symbols of a context.
ORDER = 5
#: Contexts of so many symbols and fewer are sent to all shards.
TOP = 2
#: Bytes of text of a block, bytes that are worked on at once, and entries after which counts are summed up.
BLOCK, CHUNK, PENDING = 32 << 20, 1 << 20, 1 << 22
#: Of five documents, by crc32 of the id, those of this remainder are held out.
FOLDS, HELD = 5, 1
#: Shards, at least and at most; between, as many as blocks.
SHARDS = (64, 4096)
#: Code lengths are whole parts of a bit, so that their sums don't depend on an order.
UNIT = 1 << 30

#: The end of a text, and what stands before it: a byte that UTF-8 doesn't have.
_END = b"\xff"
_ALPHABET = 256
_LOWER = tc.LOWER.tobytes()
_GRAMS, _WORDS, _TRIPLES = 0, 1, 2
_PACKS = "kind int, shard int, block long, data binary, n long, distinct long"


def grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(texts' numbers, how many grams of each, grams) of bounded parts; a long text comes in several. A gram's lowest byte is the symbol."""

    def pieces() -> Iterator[tuple[int, bytes]]:
        for i, t in enumerate(texts):
            t = t.translate(_LOWER) + _END
            for at in range(0, len(t), CHUNK):
                yield i, _END * ORDER + t[:CHUNK] if at == 0 else t[at - ORDER : at + CHUNK]

    size, part = 0, []
    for piece in pieces():
        part.append(piece)
        size += len(piece[1])
        if size >= CHUNK:
            yield _part(part)
            size, part = 0, []
    if part:
        yield _part(part)


def _part(pieces: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = b"".join([*(p for _, p in pieces), bytes(8)])
    n = np.array([len(p) for _, p in pieces])
    window = np.ndarray((len(raw) - 8,), dtype=">u8", buffer=raw, strides=(1,)).astype(np.uint64) >> np.uint64(64 - 8 * (ORDER + 1))
    real = np.ones(len(window), dtype=bool)
    real[(np.cumsum(n)[:, None] - np.arange(1, ORDER + 1)).ravel()] = False
    return np.array([i for i, _ in pieces]), n - ORDER, window[real]


def words(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(texts' numbers, hashes) of the words of bounded parts."""
    size, part = 0, []
    for i, t in enumerate(texts):
        for own in tc.slices(t, CHUNK) if len(t) > 2 * CHUNK else [t]:
            part.append((i, own))
            size += len(own)
            if size >= CHUNK:
                yield _split(part)
                size, part = 0, []
    if part:
        yield _split(part)


def _split(part: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    w = tc.split([t for _, t in part], tc.SOLID)
    return np.array([i for i, _ in part])[w.owner()], w.hashes()


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys, and the sums of n."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[start], np.add.reduceat(n, start) if len(start) else n


class Counts:
    """Sums by key of what is added, of bounded size beside the different keys."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.base = 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((keys, n))
        self.size += len(keys)
        if self.size > self.base + max(PENDING, self.base):
            self.result()

    def each(self, keys: np.ndarray, weight: int) -> None:
        """weight for each occurrence of a key."""
        keys = np.sort(keys)
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
        self.add(keys[start], weight * np.diff(np.r_[start, len(keys)]).astype(np.int64))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            self.parts = [summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]
        self.size = self.base = len(self.parts[0][0]) if self.parts else 0
        return self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _pack(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys as steps, and what they have."""
    return pack(np.diff(keys, prepend=np.uint64(0)), values)


def _unpack(data: bytes, kind: str) -> tuple[np.ndarray, np.ndarray]:
    steps, values = unpack(data, "u8", kind)
    return np.cumsum(steps, dtype=np.uint64), values


def _shard(kind: int, keys: np.ndarray, shards: int) -> np.ndarray:
    own = tc.mix((keys >> np.uint64(8)) & np.uint64(0xFFFFFF)) if kind == _GRAMS else keys
    return ((own >> np.uint64(24)) % np.uint64(shards)).astype(np.uint16)


def in_blocks(rows: DataFrame) -> DataFrame:
    """rows (doc_id, held, text as binary) with a block: what a task reads, some BLOCK bytes at a time."""

    def number(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        for frame in frames:
            own = []
            for n in pc.binary_length(frame.column("text")).to_pylist():
                if size and size + n > BLOCK:
                    block, size = block + 1, 0
                size += n + 1
                own.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), *frame.columns], names=["block", *frame.schema.names])

    return rows.mapInArrow(number, "block long, doc_id long, held boolean, text binary")


def _count(shards: int):
    """Packs of each block's different grams and words, with their counts in training texts (0 if only held-out ones have them)."""

    def flush(block: int, counts: dict[int, Counts]) -> Iterator[pa.RecordBatch]:
        for kind, c in counts.items():
            keys, n = c.result()
            shard = _shard(kind, keys, shards)
            order = np.argsort(shard, kind="stable")
            edge = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = [(kind, s, block, _pack(keys[order[a:b]], n[order[a:b]].astype(np.uint32))) for s, (a, b) in enumerate(itertools.pairwise(edge.tolist())) if b > a]
            if rows:
                kinds, own, blocks, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(own, pa.int32()), pa.array(blocks, pa.int64()), pa.array(data, pa.binary())], names=["kind", "shard", "block", "data"])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, counts = None, {}
        for frame in frames:
            if not frame.num_rows:
                continue
            block, held = frame.column("block").to_numpy(), frame.column("held").to_numpy(zero_copy_only=False)
            for a, b in itertools.pairwise([*np.flatnonzero(np.r_[True, block[1:] != block[:-1]]).tolist(), len(block)]):
                if block[a] != last:
                    if last is not None:
                        yield from flush(last, counts)
                    last, counts = int(block[a]), {_GRAMS: Counts(), _WORDS: Counts()}
                texts = frame.column("text").slice(a, b - a)
                for weight, own in ((1, ~held[a:b]), (0, held[a:b])):
                    some = texts.filter(pa.array(own)).to_pylist()
                    for _, _, g in grams(some):
                        counts[_GRAMS].each(g, weight)
                    for _, h in words(some):
                        counts[_WORDS].each(h, weight)
        if last is not None:
            yield from flush(last, counts)

    return run


def _merge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs, sorted by kind and shard, to one of each shard; of grams also the counts of their triples."""

    def flush(kind: int, shard: int, c: Counts) -> Iterator[pa.RecordBatch]:
        keys, n = c.result()
        out = [(kind, keys, n)]
        if kind == _GRAMS:
            some = n > 0
            out.append((_TRIPLES, *summed(keys[some] & np.uint64((1 << 8 * (TOP + 1)) - 1), n[some])))
        for k, a, b in out:
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([shard], pa.int32()), pa.array([0], pa.int64()), pa.array([_pack(a, b)], pa.binary()), pa.array([int(b.sum())]), pa.array([int((b > 0).sum())])], names=["kind", "shard", "block", "data", "n", "distinct"])

    last, counts = None, Counts()
    for frame in frames:
        for kind, shard, data in zip(*(frame.column(x).to_pylist() for x in ("kind", "shard", "data")), strict=True):
            if (kind, shard) != last:
                if last is not None:
                    yield from flush(*last, counts)
                last, counts = (kind, shard), Counts()
            keys, n = _unpack(data, "u4")
            counts.add(keys, n.astype(np.int64))
    if last is not None:
        yield from flush(*last, counts)


@dataclass
class Level:
    """Contexts of one length. pairs: context and symbol, sorted, n: their counts; contexts: sorted, total and distinct: of their symbols;
    lower: what the shorter context counts for these symbols together."""

    pairs: np.ndarray
    n: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    lower: np.ndarray


def _find(sorted_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys, -1 where there is none."""
    if not len(sorted_):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)
    return np.where(sorted_[at] == keys, at, -1)


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << 8 * (order + 1)) - 1)


def levels(pairs: np.ndarray, n: np.ndarray, high: int, below: dict[int, Level] | None = None) -> dict[int, Level]:
    """The levels of contexts from `high` symbols on, down to those that are known already."""
    out = dict(below or {})
    counted = {high: (pairs, n)}
    for k in range(high - 1, -1, -1):
        if k not in out:
            counted[k] = summed(counted[k + 1][0] & _mask(k), counted[k + 1][1])
    for k in sorted(counted):
        p, c = counted[k]
        context = p >> np.uint64(8)
        start = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(p) else np.zeros(0, dtype=np.int64)
        add = lambda v, s=start: np.add.reduceat(v, s) if len(s) else np.zeros(0, np.int64)
        lower = out[k - 1].n[_find(out[k - 1].pairs, p & _mask(k - 1))] if k and len(p) else np.zeros(len(p), np.int64)
        out[k] = Level(p, c, context[start], add(c), add(np.ones(len(p), np.int64)), add(lower))
    return out


def code_lengths(keys: np.ndarray, trie: dict[int, Level], high: int = ORDER) -> np.ndarray:
    """Bits of each gram's symbol after its context, in parts of UNIT."""
    bits = np.zeros(len(keys))
    open_ = np.ones(len(keys), dtype=bool)
    # What a longer context has: how many symbols, and their counts in the context at hand.
    seen, excluded = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for k in range(high, -1, -1):
        level = trie[k]
        at = _find(level.contexts, (keys & _mask(k)) >> np.uint64(8))
        own = np.flatnonzero(open_ & (at >= 0))
        place = at[own]
        fresh = level.distinct[place] - seen[own]
        mass = level.total[place] - excluded[own]
        whole = mass + np.where(level.distinct[place] < _ALPHABET, fresh, 0)
        pair = _find(level.pairs, keys[own] & _mask(k))
        hit = pair >= 0
        bits[own[hit]] += np.log2(whole[hit]) - np.log2(level.n[pair[hit]])
        open_[own[hit]] = False
        miss = ~hit & (fresh > 0)
        bits[own[miss]] += np.log2(whole[miss]) - np.log2(fresh[miss])
        seen[own], excluded[own] = level.distinct[place], level.lower[place]
    bits[open_] += np.log2(_ALPHABET - seen[open_])
    return np.rint(bits * UNIT).astype(np.int64)


def _answer(top: Broadcast):
    """To each block's packs the values of their keys, from their shard's counts, which come first: code lengths of grams, counts of words."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = values = None
        for frame in frames:
            blocks, kinds, packs = [], [], []
            for kind, block, model, data in zip(*(frame.column(x).to_pylist() for x in ("kind", "block", "model", "data")), strict=True):
                if model:
                    keys, n = _unpack(data, "i8")
                    values = n if kind == _WORDS else code_lengths(keys, levels(keys[n > 0], n[n > 0], ORDER, top.value))
                    continue
                own = _unpack(data, "u4")[0]
                blocks.append(block)
                kinds.append(kind)
                packs.append(_pack(own, values[np.searchsorted(keys, own)]))
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(kinds, pa.int32()), pa.array(packs, pa.binary())], names=["block", "kind", "data"])

    return run


class Lookup:
    """Values by key: a table of places by hash, and a search for the few keys that lost theirs to another."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        keys, values = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(8, (4 * len(keys)).bit_length()))
        self.places = np.zeros(1 << int(64 - self.shift), dtype=np.int32)
        self.places[self._hash(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self.places[self._hash(keys)]
        lost = np.flatnonzero(self.keys[at] != keys)
        at[lost] = np.searchsorted(self.keys, keys[lost])
        return self.values[at]


def _scores(end_count: int):
    """Rows of documents, after the values of their block's grams and words (kind -1 is a document)."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, tables = None, {}, None
        for frame in frames:
            if not frame.num_rows:
                continue
            kinds, blocks = frame.column("kind").to_numpy(), frame.column("block").to_numpy()
            edges = np.flatnonzero(np.r_[True, (kinds[1:] != kinds[:-1]) | (blocks[1:] != blocks[:-1])]).tolist()
            for a, b in itertools.pairwise([*edges, len(kinds)]):
                own = frame.slice(a, b - a)
                if blocks[a] != block:
                    block, parts, tables = blocks[a], {_GRAMS: [], _WORDS: []}, None
                if kinds[a] >= 0:
                    parts[int(kinds[a])] += [_unpack(d, "i8") for d in own.column("data").to_pylist()]
                    continue
                if tables is None:
                    tables = Lookup(parts[_GRAMS]), Lookup(parts[_WORDS])
                    parts = None
                texts = own.column("data").to_pylist()
                n = len(texts)
                units, tokens, known, base = np.zeros(n, np.int64), np.ones(n, np.int64), np.full(n, int(end_count > 0)), np.full(n, math.log10(end_count + 0.5))
                for of, size, g in grams(texts):
                    total = np.r_[0, np.cumsum(tables[0][g], dtype=np.int64)]
                    end = np.cumsum(size)
                    np.add.at(units, of, total[end] - total[end - size])
                for of, h in words(texts):
                    c = tables[1][h]
                    tokens += np.bincount(of, minlength=n)
                    known += np.bincount(of[c > 0], minlength=n)
                    base += np.bincount(of, np.log10(c + 0.5), minlength=n)
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("held"), pa.array(tokens), pa.array(known), pa.array(base), pa.array(units)], names=["doc_id", "held_out", "n_tokens", "n_known", "base", "units"])

    return run


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each document.

    The model and the base rate learn from documents whose crc32 of the id as text isn't HELD modulo FOLDS; rows without an id are among
    them. score is the log10 probability of the text with A-Z lower-cased, and its end. A null text is empty, and has its end alone.
    Repeated rows are counted and returned as often as they stand there; further columns are left out; an empty table gives no rows.
    Without training texts all symbols are alike. Words are told apart by 64 bits of hash.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == HELD, F.lit(False))
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held.alias("held"), F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b"")).alias("text"))
    texts = keep(in_blocks(source), "blocks")
    facts = texts.agg(F.count_distinct("block").alias("blocks"), F.count(F.when(~F.col("held"), 1)).alias("train")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # given, as bytes say little about the work: Spark would merge parts
    shards = min(max(facts.blocks, SHARDS[0]), SHARDS[1])
    packs = keep(texts.mapInArrow(_count(shards), "kind int, shard int, block long, data binary"), "packs")
    by_shard = packs.repartition(tasks, "kind", "shard").sortWithinPartitions("kind", "shard")
    model = keep(by_shard.mapInArrow(_merge, _PACKS), "model")
    known = model.where(F.col("kind") == _WORDS).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct")).first()

    def triples(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for data in frame.column("data").to_pylist():
                keys, n = _unpack(data, "i8")
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["key", "n"])

    short = model.where(F.col("kind") == _TRIPLES).select("data").mapInArrow(triples, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").toArrow()  # 256 ** 3 rows at most
    top = spark.sparkContext.broadcast(levels(short["key"].to_numpy().astype(np.uint64), short["n"].to_numpy(), TOP))
    asked = model.where(F.col("kind") != _TRIPLES).select("kind", "shard", "block", F.lit(True).alias("model"), "data").unionByName(packs.withColumn("model", F.lit(False)))
    asked = asked.repartition(tasks, "kind", "shard").sortWithinPartitions("kind", "shard", F.desc("model"))
    values = asked.mapInArrow(_answer(top), "block long, kind int, data binary")
    rows = values.select("block", "kind", "data", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held")).unionByName(texts.select("block", F.lit(-1).alias("kind"), F.col("text").alias("data"), "doc_id", "held"))
    rows = rows.repartition(tasks, "block").sortWithinPartitions("block", F.desc("kind"))
    scored = rows.mapInArrow(_scores(facts.train), "doc_id long, held_out boolean, n_tokens long, n_known long, base double, units long")
    total, distinct = known.n + facts.train, known.distinct + (facts.train > 0)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(math.log10(total + 0.5 * (distinct + 1)))).alias("base_score"),
        (F.col("units") * F.lit(-math.log10(2) / UNIT)).alias("score"),
    )
