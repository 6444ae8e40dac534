"""Benchmark passages in documents: an FM-index of each shard of the corpus, searched for every window of the benchmark."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import textcore as tc
from lexloom.llm.fmindex import FMIndex
from lexloom.llm.store import keep, row_key

#: Words of a window.
WINDOW = 13
#: Bytes of benchmark text that are sent to the executors at once, as windows of some ten times that; a larger one is searched in blocks.
BLOCK_BYTES = 4 << 20
#: A shard ends when so many bytes of text were read, or so many words are to be indexed.
SHARD_BYTES, SHARD_WORDS = 48 << 20, 2_000_000
#: A document is contaminated from this share of hit words: one in so many.
ONE_IN = 20

_SCHEMA = "doc_id {}, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


@dataclass
class Windows:
    """The windows of a block of a benchmark. vocabulary: sorted hashes of its words; symbols are their numbers from 1.
    patterns: by length, a matrix of symbols. items: by length, where each pattern's items begin (then the count), and those items."""

    vocabulary: np.ndarray
    bitmap: np.ndarray
    bigrams: np.ndarray
    patterns: dict[int, np.ndarray]
    items: dict[int, tuple[np.ndarray, np.ndarray]]
    names: list[str]
    shortest: int


def compile_windows(rows: list[tuple[int, str]]) -> Windows | None:
    """Windows of items (id, text); items of null id or without words take no part. None if there are no windows."""
    rows = [(i, (t or "").encode()) for i, t in rows if i is not None]
    words = tc.split([t for _, t in rows] or [b""])
    vocabulary, symbol = np.unique(words.hashes(), return_inverse=True)
    if not len(vocabulary):
        return None
    symbol = symbol.astype(np.int32) + 1
    names = sorted({str(i) for i, _ in rows})
    number = {x: k for k, x in enumerate(names)}
    item = np.array([number[str(i)] for i, _ in rows], dtype=np.int64)
    size = np.diff(words.first)
    patterns, items = {}, {}
    for n in np.unique(np.minimum(size[size > 0], WINDOW)).tolist():
        # Where windows of n words start, and the item of each.
        count = np.where(size >= WINDOW, size - WINDOW + 1, 0) if n == WINDOW else (size == n).astype(np.int64)
        owner = np.repeat(np.arange(len(size)), count)
        start = np.arange(count.sum()) + np.repeat(words.first[:-1] - np.cumsum(count) + count, count)
        found = np.lib.stride_tricks.sliding_window_view(symbol, n)[start]
        patterns[n], which = np.unique(found, axis=0, return_inverse=True)
        held = np.unique(which.ravel() * len(names) + item[owner])
        first = np.searchsorted(held, np.arange(len(patterns[n]) + 1) * len(names))
        items[n] = (first, (held % len(names)).astype(np.int32))
    bitmap = np.zeros(1 << 22, dtype=bool)
    bitmap[(vocabulary & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
    # Neighbours in an item are neighbours in a window of it.
    inside = np.ones(max(0, len(symbol) - 1), dtype=bool)
    inside[words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < len(symbol))] - 1] = False
    bigrams = np.unique((symbol[:-1].astype(np.int64) * (len(vocabulary) + 1) + symbol[1:])[inside])
    bigrams = bigrams if len(bigrams) else np.zeros(1, dtype=np.int64)
    return Windows(vocabulary, bitmap, bigrams, patterns, items, names, min(patterns))


def _member(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return at, sorted_[at] == x


class Shard:
    """Words that may belong to a window, from documents until the shard is full, with their places."""

    def __init__(self, windows: Windows) -> None:
        self.w = windows
        self.docs: list[tuple] = []
        self.symbols: list[np.ndarray] = []
        self.owner: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        self.size = self.words = 0

    def add(self, ids: list, texts: list[bytes]) -> None:
        words = tc.split(texts)
        h = words.hashes()
        counts = np.diff(words.first)
        some = np.flatnonzero(self.w.bitmap[(h & np.uint64((1 << 22) - 1)).astype(np.int64)])
        at, known = _member(self.w.vocabulary, h[some])
        some, symbol = some[known], at[known] + 1
        owner = np.searchsorted(words.first, some, side="right") - 1
        # Runs of words that follow each other in one document and in some window.
        tied = np.zeros(len(some), dtype=bool)
        if len(some) > 1:
            pair = symbol[:-1] * (len(self.w.vocabulary) + 1) + symbol[1:]
            tied[1:] = (some[1:] == some[:-1] + 1) & (owner[1:] == owner[:-1]) & _member(self.w.bigrams, pair)[1]
        run = np.cumsum(~tied) - 1
        if len(run):
            full = (np.bincount(run) >= self.w.shortest)[run]
            some, symbol, owner, tied = some[full], symbol[full], owner[full], tied[full]
        # A separator, 0, ahead of each run.
        heads = np.flatnonzero(~tied)
        self.symbols.append(np.insert(symbol, heads, 0))
        self.owner.append(np.insert(owner + len(self.docs), heads, -1))
        self.place.append(np.insert(some - words.first[owner], heads, -1))
        self.docs += zip(ids, counts.tolist(), strict=True)
        self.size += len(words.data)
        self.words += len(self.symbols[-1])

    def full(self) -> bool:
        return self.size >= SHARD_BYTES or self.words >= SHARD_WORDS

    def results(self) -> pa.RecordBatch:
        text, owner, place = (np.concatenate(x) for x in (self.symbols, self.owner, self.place))
        hit = np.zeros(len(text) + 1, dtype=np.int64)
        pairs = [np.empty(0, dtype=np.int64)]
        base = max(1, len(self.w.names))
        if len(text):
            index = FMIndex(text, len(self.w.vocabulary) + 1)
            for n, patterns in self.w.patterns.items():
                low, high = index.search(patterns)
                found = np.flatnonzero(high > low)
                which = np.repeat(found, (high - low)[found])
                rows = np.concatenate([np.arange(a, b) for a, b in zip(low[found], high[found], strict=True)]) if len(found) else which
                at = index.locate(rows)
                np.add.at(hit, at, 1)
                np.add.at(hit, at + n, -1)
                seen = np.unique(owner[at] * len(patterns) + which)  # each window once for a document
                of, w = seen // len(patterns), seen % len(patterns)
                first, holds = self.w.items[n]
                size = first[w + 1] - first[w]
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                pairs.append(np.repeat(of, size) * base + holds[np.repeat(first[w], size) + inside])
        hit = (np.cumsum(hit)[:-1] > 0) & (owner >= 0) if len(text) else np.zeros(0, dtype=bool)
        items: list[list[str]] = [[] for _ in self.docs]
        for p in np.unique(np.concatenate(pairs)).tolist():
            items[p // base].append(self.w.names[p % base])
        where = np.flatnonzero(hit)
        n_hit = np.bincount(owner[where], minlength=len(self.docs))
        spans: list[list[dict]] = [[] for _ in self.docs]
        if len(where):
            new = np.r_[True, (owner[where][1:] != owner[where][:-1]) | (place[where][1:] != place[where][:-1] + 1)]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(where)] - 1
            for d, a, b in zip(owner[where[first]].tolist(), place[where[first]].tolist(), place[where[last]].tolist(), strict=True):
                spans[d].append({"start": a, "end": b + 1})
        return pa.record_batch(
            [pa.array([d[0] for d in self.docs], pa.binary() if any(isinstance(d[0], bytes) for d in self.docs) else pa.int64()), pa.array([d[1] for d in self.docs], pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            ["doc_id", "n_words", "n_hit", "items", "spans"],
        )


def _searcher(windows):
    def search(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(windows.value)
        for (ids,), texts in tc.batches(frames, "doc_id"):
            shard.add(ids, texts)
            if shard.full():
                yield shard.results()
                shard = Shard(windows.value)
        if shard.docs:
            yield shard.results()

    return search


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (ids of items with an occurring window, sorted as strings), spans (merged
    runs of hit words, numbered from 0, end exclusive), items_sha256 (of the ids, comma-joined), n_items, contaminated.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with A-Z lower-cased. A window is 13 consecutive words of an item; an item
    of fewer, but not none, is one window. A document word inside any occurrence of a window is hit; a document is
    contaminated if n_hit > 0 and 20 * n_hit >= n_words.

    Each task builds FM-indexes of its shards. Words that no window holds, or that no window holds next to their neighbour,
    cannot belong to an occurrence, so that only the remaining runs are indexed. The benchmark is the query set: it is sent
    to the executors in blocks of up to BLOCK_BYTES (one item at least); only with more than one block do results meet in
    a shuffle by row, whose key is 128 bits of id and text.

    Null texts have no words; null items and items of null id take no part; repeated rows come back repeated, and rows that
    share an id, or have none, each have their own result. Without windows nothing is hit. Empty tables give an empty result.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    searched, rows_of = source, None
    if blocks > 1:
        key = row_key("doc_id", "text")
        searched = source.select(key.alias("doc_id"), "text")
        rows_of = keep(source.groupBy(key.alias("row"), "doc_id").agg(F.count("*").alias("copies")), "rows")
    found = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block).collect()
        windows = compile_windows([(r.i, r.t) for r in rows]) or Windows(np.zeros(1, np.uint64), np.zeros(1 << 22, bool), np.zeros(1, np.int64), {}, {}, [], WINDOW)
        found.append(searched.mapInArrow(_searcher(docs.sparkSession.sparkContext.broadcast(windows)), _SCHEMA.format("long" if blocks == 1 else "binary")))
    hits = found[0] if blocks == 1 else _merged(found, rows_of)
    return (
        hits.withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))
    )


def _merged(found: list[DataFrame], rows_of: DataFrame) -> DataFrame:
    """Results for several blocks of one benchmark, by the keys of rows, as one for each row: spans that overlap or touch
    are joined. rows_of: (row, doc_id, copies)."""
    all_ = found[0].withColumn("block", F.lit(0))
    for block, more in enumerate(found[1:], 1):
        all_ = all_.unionByName(more.withColumn("block", F.lit(block)))
    # Copies of a row have one result in a block.
    each = keep(all_.withColumnRenamed("doc_id", "row"), "blocks").groupBy("row", "block").agg(*(F.first(c).alias(c) for c in ("n_words", "spans", "items")))
    met = each.groupBy("row").agg(F.max("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_list("spans"))).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = F.expr("""aggregate(s, cast(array() as array<struct<start:bigint,end:bigint>>), (a, x) ->
        if(size(a) > 0 and element_at(a, -1).end >= x.start,
           concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end)))),
           concat(a, array(named_struct('start', x.start, 'end', x.end)))))""")
    out = met.withColumn("spans", joined).join(rows_of, "row").withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    return out.select("doc_id", "n_words", F.expr("aggregate(spans, 0L, (a, x) -> a + x.end - x.start)").alias("n_hit"), "items", "spans")
