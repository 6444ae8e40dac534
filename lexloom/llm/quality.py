"""Quality by perplexity: an interpolated modified Kneser-Ney model of words of trusted text, and features of toxic text.

Words, and runs of marks, are predicted from the words before them: from both if these are among the HOT most frequent, from
the last if that is among CONTEXTS, else from the class of all other words. What is predicted is never pruned, so that the tables
of counts grow with the corpus. They are sharded by the predicted word, which has every count that its probability
needs; what contexts sum up to, and all that is needed for the HOT words as predicted ones, has a fixed greatest size and is sent to all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom.llm import contexts, textcore as tc
from lexloom.llm.store import keep

#: The most frequent words, whose pairs are contexts, and which are predicted without a shuffle; and those that are contexts alone.
HOT, CONTEXTS = 128, 8192
#: Trusted texts whose hash is divisible by this are not trained on: the thresholds are quantiles of theirs.
HELD = 8
#: A document is rejected whose cross-entropy lies more than MARGIN bits a word above the UPPER quantile of its language.
UPPER, MARGIN = 0.99, 1.0
#: Words at the language's median cross-entropy that are added to each document, so that short ones are judged with care.
PRIOR = 20
#: Words that one shard of the model was counted from, at most, and words and documents of a block that is sent to the shards.
SHARD, BLOCK_WORDS, BLOCK_DOCS = 8_000_000, 700_000, 60_000
#: Languages whose thresholds are sent to all tasks.
LANGUAGES = 10_000
#: Bits of the filter that spares most untrusted texts the join with the trusted ids.
FILTER_BITS = 1 << 25
#: A feature is toxic if so many toxic documents have it, at least this share of them, and its rate there is so many times that elsewhere.
SUPPORT, SHARE, TIMES = 5, 0.03, 60
#: Bytes of a word's beginning that are features beside the whole word.
STEMS = (4, 5, 6)

#: Contexts: 0 is every other word, then pairs with a hot last word, then single words.
_SINGLE = 1 + HOT * (HOT + 1)
_ALL = _SINGLE + CONTEXTS - HOT
_UNIT = 65536.0  # sums are of whole parts of a bit, so that their order doesn't matter

# Bytes of a token: 0 parts tokens, 1 belongs to a word, 2 to a run of marks.
_CLASS = np.where(tc.ALNUM, 1, np.where(tc.SOLID, 2, 0)).astype(np.int8)
_SMALL, _LARGE = (np.array([a <= c <= b for c in range(256)]) for a, b in ((97, 122), (65, 90)))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(h, first, repeats): hashes of the tokens of a block, where each text's begin (then the count), and how many words of
    each repeat the one before them.

    Tokens are words in lower case (those in capitals are others) and runs of marks. What repeats the word before it between
    white space is no token of its own, but one more repetition of that. Longer texts than tc.BLOCK are worked on in slices.
    """
    if len(texts) != 1 or len(texts[0]) <= 2 * tc.BLOCK:
        return _tokens(texts)
    parts, repeats, last = [], 0, b""
    for own in tc.slices(texts[0], tc.BLOCK):
        # The last word before the slice tells whether its first one is a repetition.
        h, _, n = _tokens([last + own])
        parts.append(h[len(_tokens([last])[0]) :])
        repeats += int(n[0])
        last = (own.rsplit(None, 1) or [last])[-1]
    h = np.concatenate(parts)
    return h, np.array([0, len(h)]), np.array([repeats])


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    solid = tc.split(texts, tc.SOLID)
    h, owner = solid.hashes(), solid.owner()
    again = np.flatnonzero((h[1:] == h[:-1]) & (owner[1:] == owner[:-1])) + 1
    raw = np.frombuffer(solid.raw, dtype=np.uint8)
    kind = _CLASS[raw]
    kind[solid.at[1:] - 1] = 0
    for a, b in zip(solid.start[again].tolist(), solid.end[again].tolist(), strict=True):
        kind[a:b] = 0
    edge = np.r_[0, np.flatnonzero(kind[1:] != kind[:-1]) + 1, len(kind)]
    real = kind[edge[:-1]] != 0
    start, end = edge[:-1][real], edge[1:][real]
    own = tc.Words(solid.data, start, end, np.searchsorted(start, solid.at), solid.at, b"")
    h = own.hashes()
    if len(h):
        borders = np.column_stack([start, end]).ravel()
        small, large = (np.add.reduceat(t[raw].view(np.uint8), borders, dtype=np.int32)[::2] for t in (_SMALL, _LARGE))
        loud = (small == 0) & (large > 1)
        h[loud] = tc.mix(h[loud])
    return h, own.first, np.bincount(owner[again], minlength=len(texts))


@dataclass
class Top:
    """The most frequent words: sorted hashes, and the rank of each."""

    words: np.ndarray
    ranks: np.ndarray

    def rank(self, h: np.ndarray) -> np.ndarray:
        """Ranks from 0; CONTEXTS for other words."""
        if not len(self.words):
            return np.full(len(h), CONTEXTS)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.ranks[at], CONTEXTS)

    def contexts(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The context of each token, and its own rank. A text's beginning counts as any other word."""
        rank = self.rank(h)
        inside = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
        last, before = np.full(len(h), CONTEXTS), np.full(len(h), CONTEXTS)
        last[1:], before[2:] = rank[:-1], rank[:-2]
        last[inside < 1], before[inside < 2] = CONTEXTS, CONTEXTS
        pair = 1 + last * (HOT + 1) + np.where(before < HOT, before + 1, 0)
        return np.where(last < HOT, pair, np.where(last < CONTEXTS, _SINGLE + last - HOT, 0)), rank


def last_word(x: np.ndarray) -> np.ndarray:
    """Of contexts, the class of the last word: 0 for others, else 1 + rank."""
    return np.where(x >= _SINGLE, x - _SINGLE + HOT + 1, np.where(x > 0, (x - 1) // (HOT + 1) + 1, 0))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, those of equal significance together."""
    raw = b"".join(np.int64(len(a)).tobytes() + a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, *types: str) -> list[np.ndarray]:
    raw = pa.decompress(memoryview(data)[8:], decompressed_size=int(np.frombuffer(data, np.int64, 1)[0]), codec="zstd", asbytes=True)
    out, at = [], 0
    for t in types:
        n, size = int(np.frombuffer(raw, np.int64, 1, at)[0]), np.dtype(t).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at + 8).reshape(size, n).T).view(t).reshape(n))
        at += 8 + n * size
    return out


def runs(*sorted_: np.ndarray) -> np.ndarray:
    """Where new combinations of sorted arrays begin, and then the length."""
    new = np.zeros(len(sorted_[0]), dtype=bool)
    new[:1] = True
    for a in sorted_:
        new[1:] |= a[1:] != a[:-1]
    return np.r_[np.flatnonzero(new), len(new)]


def _split(word: np.ndarray, shards: int) -> np.ndarray:
    """The shard of words: ranges of their hashes, so that sorted words are sorted by shard."""
    return ((word >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _words(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of trusted texts, a block at a time; the word null: repetitions."""
    for _, texts in tc.batches(frames):
        h, _, repeats = tokens(texts)
        word, n = np.unique(h, return_counts=True)
        yield pa.record_batch([pa.array([*word.view(np.int64).tolist(), None], pa.int64()), pa.array([*n.tolist(), int(repeats.sum())], pa.int64())], ["word", "n"])


def _counter(top, shards: int):
    """(shard, data) of trusted texts: words, contexts and counts, summed up over blocks of many texts."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            word, x = (np.concatenate(a) for a in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((x, word))
            word, x = word[order], x[order]
            at = runs(word, x)
            n, word, x = np.diff(at), word[at[:-1]], x[at[:-1]]
            shard = _split(word, shards)
            cut = runs(shard)
            rows = [(int(shard[a]), pack(word[a:b], x[a:b].astype(np.uint32), n[a:b].astype(np.uint32))) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if b > a]
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "data"])

        for _, texts in tc.batches(frames):
            h, first, _ = tokens(texts)
            held.append((h, top.value.contexts(h, first)[0]))
            if sum(len(w) for w, _ in held) >= BLOCK_WORDS:
                yield flush()
        if held:
            yield flush()

    return count


#: kind 0: a shard's model in data. Kinds of sums, by key: 1 counts after a context; 2 distinct contexts of pairs after a hot word; 3 distinct
#: classes before words; 4 how many n-grams have a count (order * 8 + count); 5 a count of a hot word (rank * _ALL + context).
_SUMS = "kind int, shard int, key long, n long, n1 long, n2 long, n3 long, data binary"


def _sums(kind: int, key: np.ndarray, n: np.ndarray, value: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of sums: n by key, and how many values are 1, 2 and more."""
    keys, at = np.unique(key, return_inverse=True)
    total = np.bincount(at, n, minlength=len(keys)).astype(np.int64)
    of = [np.bincount(at, v, minlength=len(keys)).astype(np.int64) for v in ((value == 1, value == 2, value > 2) if value is not None else (np.zeros(len(key)),) * 3)]
    none = pa.nulls(len(keys), pa.int32())
    return pa.record_batch([pa.array(np.full(len(keys), kind), pa.int32()), none, pa.array(keys.astype(np.int64)), pa.array(total), *(pa.array(x) for x in of), pa.nulls(len(keys), pa.binary())], ["kind", "shard", "key", "n", "n1", "n2", "n3", "data"])


def levels(word: np.ndarray, x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(at, last, two): from distinct n-grams sorted by word and context, where each word and class of the last word begins
    (then the length), that class, and its count: after hot words that of distinct contexts, else the plain one."""
    last = last_word(x)
    at = runs(word, last)
    hot = (last[at[:-1]] > 0) & (last[at[:-1]] <= HOT)
    return at, last[at[:-1]], np.where(hot, np.diff(at), n[at[:-1]])


def _sum_up(top):
    """Sorted (shard, data) of blocks to each shard's model and its sums."""

    def sum_up(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        now = None

        def flush() -> Iterator[pa.RecordBatch]:
            word, x, n = (np.concatenate(a) for a in zip(*parts, strict=True))
            parts.clear()
            order = np.lexsort((x, word))
            word, x, n = word[order], x[order].astype(np.int64), n[order].astype(np.int64)
            at = runs(word, x)
            word, x, n = word[at[:-1]], x[at[:-1]], np.add.reduceat(n, at[:-1])
            two_at, last, two = levels(word, x, n)
            hot_last = (last > 0) & (last <= HOT)
            one_at = runs(word[two_at[:-1]])
            one = np.diff(one_at)
            top_level = (x > 0) & (x < _SINGLE)  # order 3
            yield _sums(1, x, n, n)
            yield _sums(2, last[hot_last], two[hot_last], two[hot_last])
            yield _sums(3, np.zeros(len(one)), one, one)
            for order_, counts in ((3, n[top_level]), (2, two[hot_last]), (1, one), (4, n[~top_level])):
                some = counts[counts <= 4]
                yield _sums(4, order_ * 8 + some, np.ones(len(some)))
            rank = top.value.rank(word)
            hot = rank < HOT
            yield _sums(5, rank[hot] * _ALL + x[hot], n[hot])
            rest = ~hot
            words = runs(word[rest])
            data = pack(word[rest][words[:-1]], np.diff(words).astype(np.uint32), x[rest].astype(np.uint32), n[rest].astype(np.uint64))
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([now], pa.int32()), *(pa.array([0], pa.int64()) for _ in range(5)), pa.array([data], pa.binary())], ["kind", "shard", "key", "n", "n1", "n2", "n3", "data"])

        for frame in frames:
            for shard, data in zip(frame.column("shard").to_pylist(), frame.column("data"), strict=True):
                if parts and shard != now:
                    yield from flush()
                now = shard
                parts.append(unpack(data.as_py(), "u8", "u4", "u4"))
        if parts:
            yield from flush()

    return sum_up


@dataclass
class Model:
    """What every task needs: of a greatest size that does not depend on the corpus.

    d: discounts by order (1, 2, 3, and 4 for single-word contexts) and count (0 to 3). all2, left2: by class of the last word, its
    total and the mass left to order 1; all3, left3: by context likewise. hot: bits of a hot word by context and rank, one for every
    kind of context. unseen: probability of a word that was never seen; all1, left1: as above for order 1.
    """

    top: Top
    d: np.ndarray
    all1: float
    left1: float
    unseen: float
    all2: np.ndarray
    left2: np.ndarray
    all3: np.ndarray
    left3: np.ndarray
    hot: np.ndarray
    repeat: float
    stay: float

    def discount(self, order: int, n: np.ndarray) -> np.ndarray:
        return n - self.d[order][np.minimum(n, 3)]

    def one(self, n: np.ndarray) -> np.ndarray:
        """Order 1 from the number of classes before a word."""
        return self.discount(1, n) / self.all1 + self.left1 * self.unseen

    def two(self, last: np.ndarray, n: np.ndarray, lower: np.ndarray) -> np.ndarray:
        hot = (last > 0) & (last <= HOT)
        return np.where(hot, self.discount(2, n), self.discount(4, n)) / self.all2[last] + self.left2[last] * lower

    def three(self, x: np.ndarray, n: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """The probability: contexts of one word end at order 2."""
        return np.where((x > 0) & (x < _SINGLE), self.discount(3, n) / self.all3[x] + self.left3[x] * lower, lower)


def fit(top: Top, sums: pa.Table, cells: pa.Table, words: int, repeats: int, total: int) -> Model:
    """The model from the sums of all shards, the counts of hot words, the number of distinct words, and how often words are repeated."""
    kind, key = sums["kind"].to_numpy(), sums["key"].to_numpy()
    n, n1, n2, n3 = (sums[c].to_numpy() for c in ("n", "n1", "n2", "n3"))
    d = np.zeros((5, 4))
    for order in (1, 2, 3, 4):
        c = np.zeros(6)
        here = (kind == 4) & (key // 8 == order)
        c[key[here] % 8] = n[here]
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.0
        for i in (1, 2, 3):
            raw = i - (i + 1) * y * c[i + 1] / c[i] if c[i] else 0.0
            d[order, i] = raw if 0 < raw < i else 0.5 * i
    left = lambda order, here: d[order, 1] * n1[here] + d[order, 2] * n2[here] + d[order, 3] * n3[here]
    ones, pairs, contexts = (np.flatnonzero(kind == k) for k in (3, 2, 1))
    all1 = float(n[ones].sum())
    left1 = float(left(1, ones).sum()) / all1
    # A context that was never seen leaves all to the lower order.
    all2, left2, all3, left3 = np.ones(CONTEXTS + 1), np.ones(CONTEXTS + 1), np.ones(_ALL), np.ones(_ALL)
    all2[key[pairs]], left2[key[pairs]] = n[pairs], left(2, pairs) / n[pairs]
    deep = (key[contexts] > 0) & (key[contexts] < _SINGLE)
    three, single = contexts[deep], contexts[~deep]
    all3[key[three]], left3[key[three]] = n[three], left(3, three) / n[three]
    last = last_word(key[single])
    all2[last], left2[last] = n[single], left(4, single) / n[single]
    model = Model(top, d, all1, left1, 1.0 / (words + 1), all2, left2, all3, left3, np.zeros((0, HOT)), np.log2((total + repeats + 2) / (repeats + 1)), np.log2((total + repeats + 2) / (total + 1)))
    key, count = cells["key"].to_numpy().astype(np.int64), cells["n"].to_numpy().astype(np.int64)
    rank, x = key // _ALL, key % _ALL
    order = np.lexsort((x, rank))
    rank, x, count = rank[order], x[order], count[order]
    at, two_last, two = levels(rank, x, count)
    n_one, n_two = np.zeros(HOT, dtype=np.int64), np.zeros((CONTEXTS + 1, HOT), dtype=np.int64)
    np.add.at(n_one, rank[at[:-1]], 1)
    n_two[two_last, rank[at[:-1]]] = two
    one = model.one(n_one)[None, :]
    model.hot = np.empty((_ALL, HOT), dtype=np.float32)
    for a in range(0, _ALL, 1024):  # some contexts at a time: the driver's memory
        some = np.arange(a, min(a + 1024, _ALL))
        last, here = last_word(some), (x >= a) & (x < a + 1024)
        n_three = np.zeros((len(some), HOT), dtype=np.int64)
        n_three[x[here] - a, rank[here]] = count[here]
        model.hot[some] = -np.log2(model.three(some[:, None], n_three, model.two(last[:, None], n_two[last], one)))
    return model


#: kind 0: a shard's model; 1: a block's words for a shard; 2: what a block knows of its documents; 3: sums of bits.
_PARTS = "shard int, kind int, block long, data binary"
_META = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("held", pa.bool_()), ("n_words", pa.int64()), ("repeats", pa.int64()), ("toxic_hits", pa.int64()), ("bits", pa.int64())])


def _to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _asker(model, bad, shards: int):
    """Documents to blocks: their words for every shard, and what is known of them, the bits of hot words among it."""

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        m, toxic = model.value, bad.value
        meta: list[list] = [[], [], [], [], [], [], []]
        words: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            nonlocal made
            block = (task << 32) + made
            made += 1
            if isinstance(m, contexts.Model):
                rows = parts()
            else:
                rows = pieces()
            rows.append((block % shards, 2, _to_bytes(pa.record_batch([pa.array(c, t) for c, t in zip(meta, _META.types, strict=True)], schema=_META))))
            for column in meta:
                column.clear()
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["shard", "kind", "block", "data"])

        def parts() -> list[tuple[int, int, bytes]]:
            """Hashes of words, pairs and triples for every shard."""
            key, doc, weight = (np.concatenate(a) for a in zip(*words, strict=True))
            words.clear()
            order = np.lexsort((doc, key))
            key, doc, weight = key[order], doc[order], weight[order]
            at = runs(key, doc)
            key, doc, weight = key[at[:-1]], doc[at[:-1]], np.add.reduceat(weight, at[:-1]) if len(key) else weight
            shard = _split(key, shards)
            cut = runs(shard).tolist()
            return [(int(shard[a]), 1, pack(key[a:b], doc[a:b].astype(np.uint32), weight[a:b].astype(np.uint32))) for a, b in zip(cut[:-1], cut[1:], strict=True) if b > a]

        def pieces() -> list[tuple[int, int, bytes]]:
            """Words and their contexts for every shard."""
            word, x, doc = (np.concatenate(a) for a in zip(*words, strict=True)) if words else (np.empty(0, t) for t in ("u8", "i8", "i8"))
            words.clear()
            order = np.lexsort((x.astype(np.int64) << 32 | doc, word))
            word, x, doc = word[order], x[order], doc[order]
            at = runs(word, x, doc)
            n, word, x, doc = np.diff(at), word[at[:-1]], x[at[:-1]], doc[at[:-1]]
            shard = _split(word, shards)
            rows = []
            cut = runs(shard)
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                if b > a:
                    w = runs(word[a:b])
                    rows.append((int(shard[a]), 1, pack(word[a:b][w[:-1]], np.diff(w).astype(np.uint32), x[a:b].astype(np.uint32), doc[a:b].astype(np.uint32), n[a:b].astype(np.uint32))))
            return rows

        for (ids, langs, held), texts in tc.batches(frames, "doc_id", "lang", "held"):
            hits = np.zeros(len(ids), dtype=np.int64)
            if len(toxic):
                for h, owner in features(tc.split(texts)):
                    at = np.minimum(np.searchsorted(toxic, h), len(toxic) - 1)
                    hits += np.bincount(owner[toxic[at] == h], minlength=len(ids))
            h, first, repeats = tokens(texts)
            base = len(meta[0])
            size = np.diff(first)
            sums = np.zeros(len(ids))
            if isinstance(m, contexts.Model):
                sums, (key, doc, weight) = m.entries(h, first, repeats)
                words.append((key, doc + base, weight))
            elif m is not None:
                x, rank = m.top.contexts(h, first)
                owner = np.repeat(np.arange(len(ids)), size)
                hot = rank < HOT
                sums = np.bincount(owner[hot], np.round(m.hot[x[hot], rank[hot]].astype(np.float64) * _UNIT), minlength=len(ids))
                sums = sums + np.round((repeats * m.repeat + size * m.stay) * _UNIT)
                words.append((h[~hot], x[~hot], owner[~hot] + base))
            for column, own in zip(meta, (ids, langs, held, size.tolist(), repeats.tolist(), hits.tolist(), sums.astype(np.int64).tolist()), strict=True):
                column += own
            if len(meta[0]) >= BLOCK_DOCS or sum(len(w[0]) for w in words) >= (contexts.BLOCK if isinstance(m, contexts.Model) else BLOCK_WORDS):
                yield flush()
        if meta[0]:
            yield flush()

    return ask


class Shard:
    """Counts of a shard's words, and the probabilities that follow."""

    def __init__(self, model: Model, data: bytes | None) -> None:
        self.m = model
        words, size, x, n = unpack(data, "u8", "u4", "u4", "u8") if data else (np.empty(0, t) for t in ("u8", "u4", "u4", "u8"))
        self.words = words
        index = np.repeat(np.arange(len(words)), size)
        x, n = x.astype(np.int64), n.astype(np.int64)
        self.three, self.n_three = index * _ALL + x, n
        at, last, two = levels(index, x, n)
        self.two, self.n_two = index[at[:-1]] * (CONTEXTS + 1) + last, two
        self.n_one = np.bincount(index[at[:-1]], minlength=len(words))

    @staticmethod
    def _get(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted), dtype=np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0)

    def bits(self, words: np.ndarray, size: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Bits of n-grams: distinct words, how many n-grams each has, and their contexts."""
        index = self._get(self.words, np.arange(1, len(self.words) + 1), words)
        one = self.m.one(np.where(index > 0, np.r_[0, self.n_one][index], 0))
        index, one = np.repeat(index, size) - 1, np.repeat(one, size)
        last = last_word(x)
        n_two = self._get(self.two, self.n_two, np.where(index >= 0, index * (CONTEXTS + 1) + last, -1))
        n_three = self._get(self.three, self.n_three, np.where(index >= 0, index * _ALL + x, -1))
        return -np.log2(self.m.three(x, n_three, self.m.two(last, n_two, one)))


def _scorer(model):
    """Rows sorted by shard and kind: sums of bits of each block's documents; what is known of documents is passed on."""

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = Shard(model.value, None), None
        for frame in frames:
            out: list[tuple] = []
            for number, kind, block, data in zip(*(frame.column(c).to_pylist() for c in ("shard", "kind", "block")), frame.column("data"), strict=True):
                data = data.as_py()
                if number != now:
                    shard, now = Shard(model.value, None), number
                if kind == 0:
                    shard = Shard(model.value, data)
                elif kind == 2:
                    out.append((block, kind, data))
                else:
                    words, size, x, doc, n = unpack(data, "u8", "u4", "u4", "u4", "u4")
                    sums = np.bincount(doc, np.round(shard.bits(words, size, x.astype(np.int64)) * _UNIT) * n)
                    some = np.flatnonzero(sums)
                    out.append((block, 3, pack(some.astype(np.uint32), sums[some].astype(np.int64))))
            if out:
                c = list(zip(*out, strict=True))
                yield pa.record_batch([pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["block", "kind", "data"])

    return score


def _whole_scorer(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As _scorer, with a shard's values instead of its counts."""
    table, now = None, None
    parts: list[list[np.ndarray]] = []
    for frame in frames:
        out: list[tuple] = []
        for number, kind, block, data in zip(*(frame.column(c).to_pylist() for c in ("shard", "kind", "block")), frame.column("data"), strict=True):
            data = data.as_py()
            if number != now:
                table, now = None, number
                parts.clear()
            if kind == 0:
                parts.append(unpack(data, "u8", "i4", "i4"))
            elif kind == 2:
                out.append((block, kind, data))
            else:
                if table is None:
                    table = contexts.summed(parts)
                    parts.clear()
                key, doc, weight = unpack(data, "u8", "u4", "u4")
                found, at = contexts.find(table[0], key)
                at = at[found]
                sums = np.bincount(doc[found], contexts.added(table[1][at], table[2][at], weight[found].astype(np.int64)))
                some = np.flatnonzero(sums)
                out.append((block, 3, pack(some.astype(np.uint32), sums[some].astype(np.int64))))
        if out:
            c = list(zip(*out, strict=True))
            yield pa.record_batch([pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["block", "kind", "data"])


def _documents(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and kind to documents with all their bits."""
    meta, sums = None, np.empty(0, dtype=np.int64)

    def done() -> pa.RecordBatch:
        return meta.set_column(meta.schema.get_field_index("bits"), "bits", pa.array(sums / _UNIT))

    for frame in frames:
        for kind, data in zip(frame.column("kind").to_pylist(), frame.column("data"), strict=True):
            if kind == 2:
                if meta is not None:
                    yield done()
                meta = pa.ipc.open_stream(data.as_py()).read_next_batch()
                sums = meta.column("bits").to_numpy().copy()
            else:
                doc, bits = unpack(data.as_py(), "u4", "i8")
                sums[doc] += bits
    if meta is not None:
        yield done()


def features(words: tc.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of words' features, and the text of each: whole words, and beginnings of longer ones."""
    owner = words.owner()
    yield words.hashes(), owner
    size = words.end - words.start
    for k in STEMS:
        long_ = np.flatnonzero(size > k)
        part = tc.Words(words.data, words.start[long_], words.start[long_] + k, words.first, words.at, b"")
        yield tc.mix(part.hashes()), owner[long_]


def _feature_counts(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (toxic,), texts in tc.batches(frames, "toxic"):
        toxic = np.array(toxic, dtype=bool)
        for h, owner in features(tc.split(texts)):
            order = np.lexsort((owner, h))
            h, owner = h[order], owner[order]
            if not len(h):
                continue
            new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
            h, owner = h[new], owner[new]
            head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            bad = np.add.reduceat(toxic[owner].astype(np.int64), head)
            n = np.diff(np.r_[head, len(h)])
            yield pa.record_batch([pa.array(h[head].view(np.int64)), pa.array(bad), pa.array(n - bad)], ["feature", "bad", "good"])
        # The feature null: all texts of the block.
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([int(toxic.sum())]), pa.array([int((~toxic).sum())])], ["feature", "bad", "good"])


def toxic_features(source: DataFrame, labels: DataFrame) -> np.ndarray:
    """Sorted hashes of features of toxic text, from all labelled documents. As each has SHARE of the toxic
    documents, there are never more than a document's usual number of features divided by SHARE. Features and totals are
    counted over the same rows, the distinct texts of these documents; a text is toxic if any copy of it is.

    Which row stands for a text is found by digest, so that texts are dealt once, those of labelled documents alone."""
    said = F.md5("text")
    some, sent_bits = _maybe_of(source.where("text is not null"), labels)
    known = some.select("doc_id", said.alias("said")).join(labels.select("doc_id", "toxic").hint("merge"), "doc_id")
    marks = keep(known.groupBy("said").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")), "marks")
    rows = some.withColumn("said", said).join(marks.hint("merge"), ["doc_id", "said"]).dropDuplicates(["doc_id", "said"])
    counts = rows.select("toxic", "text").mapInArrow(_feature_counts, "feature long, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = keep(counts, "features")
    sent_bits.destroy()
    total = counts.where("feature is null").first()
    bad, good = (total.bad, total.good) if total else (0, 0)
    if not bad or not good:
        return np.empty(0, dtype=np.uint64)
    chosen = counts.where("feature is not null").where((F.col("bad") >= max(SUPPORT, SHARE * bad)) & (F.col("bad") / bad >= TIMES * (F.col("good") + 0.5) / good))
    return np.sort(chosen.select("feature").toArrow()["feature"].to_numpy().view(np.uint64))


def _maybe_of(source: DataFrame, ids: DataFrame) -> tuple[DataFrame, Broadcast]:
    """Rows whose doc_id is among the ids, and some others, as a filter of fixed size lets them pass; and what was sent for them."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ids.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("w")).toArrow()
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    table[words["i"].to_numpy()] = words["w"].to_numpy()
    bits = source.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def maybe(p: pd.Series) -> pd.Series:
        p = p.to_numpy()
        return pd.Series((bits.value[p >> 6] >> (p & 63)) & 1 == 1)

    return source.where("doc_id is not null").where(maybe(place)), bits


def trusted_texts(source: DataFrame, known: DataFrame) -> tuple[DataFrame, Broadcast]:
    """Rows of documents that are labelled good, and what was sent for them. The filter spares most others the join."""
    trusted = known.where((F.col("quality") == 1) & ~F.col("toxic")).select("doc_id")
    some, bits = _maybe_of(source, trusted)
    return some.join(trusted.hint("merge"), "doc_id", "left_semi"), bits


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", every_context: bool = False) -> DataFrame:
    """Per document: doc_id, lang, n_words, perplexity (of a word), threshold, toxic_hits, kept.

    Trusted are the texts of all documents labelled quality 1 and toxic 0. One modified Kneser-Ney model is counted on all of them but
    one in HELD, by a hash of the text. With every_context all words and pairs of words are contexts (see contexts.py); else those
    beyond HOT and CONTEXTS count as one, so that what every task gets has a greatest size. Its n-grams are summed up within blocks and then by shard of the predicted word; each shard
    keeps its table of counts in the shared folder. All documents' n-grams, but those that predict one of the HOT words, go to the
    shards block by block, packed and summed up, meet the counts there, and come back as sums of bits. Words that repeat the one
    before them are repetitions of it, with a rate of their own, and no words.

    A document's perplexity is 2 ** (cross-entropy with PRIOR words at its language's median added). The threshold of a language
    is the UPPER quantile of the trusted documents that were held back, and MARGIN bits; languages without any use the
    median of all and the greatest threshold. Documents beyond it are rejected, as are those with any feature (a word or its beginning) that the labels show to be one of toxic text.

    Null and empty texts have no perplexity and are rejected, as are texts without words. Without trusted documents there are no
    perplexities and only toxic and empty texts are rejected, and without any held back no threshold. A document that is labelled
    twice is trusted if all its labels are good. Rows of null id are never trusted. Other columns are left out; repeated rows come back
    repeated. Empty tables give an empty result.
    """
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.coalesce(F.col("quality"), F.lit(0))).alias("quality"), F.max(F.coalesce(F.col("toxic"), F.lit(0)) > 0).alias("toxic"))
    known = keep(known, "labels")
    trusted = known.where((F.col("quality") == 1) & ~F.col("toxic")).select("doc_id")
    held = F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0
    texts, sent_bits = trusted_texts(source.where("text is not null").where(~held), known)
    train = keep(texts.select("text"), "trusted")
    sent_bits.destroy()
    words = keep(train.mapInArrow(_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    facts = words.agg(F.count("word").alias("words"), F.sum(F.when(F.col("word").isNotNull(), F.col("n"))).alias("total"), F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("repeats")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (facts.total or 0) // SHARD + 1)
    model, counts = None, None
    if facts.words and every_context:
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), facts.total // contexts.SHARD + 1)
        model, counts = contexts.fit(train, words, facts, shards, tokens, BLOCK_WORDS, pack, unpack, _split)
    elif facts.words:
        best = words.where("word is not null").orderBy(F.desc("n"), "word").limit(CONTEXTS).select("word").toArrow()["word"].to_numpy().view(np.uint64)
        order = np.argsort(best)
        top = Top(best[order], order)
        sent = spark.sparkContext.broadcast(top)
        dealt = train.mapInArrow(_counter(sent, shards), "shard int, data binary").repartition(shards, "shard").sortWithinPartitions("shard")
        counts = keep(dealt.mapInArrow(_sum_up(sent), _SUMS), "counts")
        # At most 5 * _ALL rows of six numbers, and _ALL * HOT of two, whatever the corpus' size.
        sums = counts.where("kind between 1 and 4").groupBy("kind", "key").agg(*(F.sum(c).alias(c) for c in ("n", "n1", "n2", "n3"))).toArrow()
        cells = counts.where("kind = 5").select(F.col("key").cast("int").alias("key"), "n").toArrow()
        model = fit(top, sums, cells, facts.words, facts.repeats or 0, facts.total)
        del sums, cells  # megabytes of the driver's
        sent.destroy()
    model, bad = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(toxic_features(source, known))
    rows = source.withColumn("held", F.coalesce(held, F.lit(False))).mapInArrow(_asker(model, bad, shards), _PARTS)
    if counts is not None:
        tables = counts if every_context else counts.where("kind = 0")
        rows = rows.unionByName(tables.select("shard", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"), "data"))
        rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
        rows = rows.mapInArrow(_whole_scorer if every_context else _scorer(model), "block long, kind int, data binary").repartition("block").sortWithinPartitions("block", "kind")
    scored = keep(rows.select("kind", "data").mapInArrow(_documents, "doc_id long, lang string, held boolean, n_words long, repeats long, toxic_hits long, bits double"), "scored")
    model.destroy()
    bad.destroy()
    with_bits = counts is not None
    reliable = scored.where("held and n_words > 0").join(trusted, "doc_id", "left_semi") if with_bits else scored.where("false")
    use = F.coalesce(F.concat(F.lit("."), F.col("lang")), F.lit(""))  # "" stands for all languages, and for those without trusted text
    both = reliable.withColumn("use", F.explode(F.array_distinct(F.array(use, F.lit(""))))).withColumn("entropy", F.col("bits") / F.col("n_words"))
    # Quantiles are summaries that are merged: no task gets all documents of a language. A row for each language is left.
    middle = keep(both.groupBy("use").agg(F.percentile_approx("entropy", 0.5, 10000).alias("middle")), "middle")
    shrunk = (F.col("bits") + PRIOR * F.col("middle")) / (F.col("n_words") + PRIOR)
    upper = _by_language(both, middle, spark).withColumn("s", shrunk).groupBy("use", "middle").agg((F.percentile_approx("s", UPPER, 10000) + MARGIN).alias("limit"))
    limits = keep(upper, "limits")
    most = limits.agg(F.max("limit")).first()[0]
    limits = limits.withColumn("limit", F.when(F.col("use") == "", F.lit(most).cast("double")).otherwise(F.col("limit")))
    known_ = F.col("_known").isNotNull()
    named = _by_language(scored.withColumn("use", use), limits.select("use", F.lit(True).alias("_known")), spark).withColumn("use", F.when(known_, F.col("use")).otherwise("")).drop("_known")
    out = _by_language(named, limits, spark).withColumn("s", F.when(F.col("n_words") > 0, F.coalesce(shrunk, F.col("bits") / F.col("n_words"))) if with_bits else F.lit(None).cast("double"))
    return out.select(
        "doc_id", "lang", "n_words", F.pow(F.lit(2.0), "s").alias("perplexity"), F.pow(F.lit(2.0), "limit").alias("threshold"), "toxic_hits",
        ((F.col("n_words") > 0) & F.coalesce(F.col("s") <= F.col("limit"), F.lit(True)) & (F.col("toxic_hits") == 0)).alias("kept"),
    )


def _by_language(rows: DataFrame, facts: DataFrame, spark: SparkSession) -> DataFrame:
    """Joined to one row for each language: sent to all tasks up to LANGUAGES of them, else joined by a shuffle that Spark may split."""
    small = facts.limit(LANGUAGES + 1).count() <= LANGUAGES
    return rows.join(F.broadcast(facts) if small else facts.hint("merge"), "use", "left")
