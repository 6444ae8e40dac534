"""Documents as token sequences of bounded length: pieces, and hierarchical best-fit packing."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import textcore as tc
from lexloom.llm.store import keep

#: Tokens of a sequence.
ROOM = 2048
#: A bin that lacks at most so many tokens is emitted before the last round.
SLACK = 16
#: Bins that one task of a merging round takes.
FAN_IN = 60_000
#: Units of words whose ids a worker remembers, at some 60 bytes each.
REMEMBERED = 2_000_000
#: Characters that are tokenized at once, and pieces that are packed at once.
CHARS, ITEMS = 1 << 21, 100_000

#: Characters for which Python and the tokenizer might not agree, or that are neither letters, ASCII digits nor marks of two bytes: the
#: tokenizer gets such texts whole.
_ODD = re.compile("[^\x01-\x7f\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]")
#: Bytes by what they are in the tokenizer's own pattern: 0 white space, 1 letters, 2 digits, 3 others; those from 0x80 to 0xBF are what their first byte is.
_KIND = np.array([0 if c in (0, 32) or 9 <= c <= 13 else 1 if 97 <= c <= 122 or 65 <= c <= 90 or c >= 0xC3 else 2 if 48 <= c <= 57 else 3 for c in range(256)], dtype=np.int8)
_WORD = _KIND > 0


def units(texts: list[bytes]) -> tc.Words:
    """The parts of texts in lower case that the tokenizer takes one by one: runs of letters, digits, runs of others, and whole words that hold an apostrophe,
    as some endings after one are parts of their own."""
    words = tc.split(texts, _WORD)
    kind = _KIND[words.data]
    more = np.flatnonzero((words.data & 0xC0) == 0x80)
    kind[more] = kind[more - 1]
    if len(quote := np.flatnonzero(words.data == 39)):
        of = np.unique(np.searchsorted(words.start, quote, side="right") - 1)
        whole = np.zeros(len(kind) + 1, dtype=np.int8)
        whole[words.start[of]] += 1
        whole[words.end[of]] -= 1
        kind[np.cumsum(whole[:-1], dtype=np.int8) > 0] = 4
    edge = np.r_[0, np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == 2)) + 1, len(kind)]
    real = kind[edge[:-1]] > 0
    start = edge[:-1][real]
    return tc.Words(words.data, start, edge[1:][real], np.searchsorted(start, words.at), words.at, b"")


class _Pool:
    """Arrays one after the other in one that grows: where each begins, and then the end."""

    def __init__(self, kind: str) -> None:
        self.data, self.at = np.empty(1 << 16, dtype=kind), np.zeros(1, dtype=np.int64)

    def add(self, data: np.ndarray, sizes: np.ndarray) -> None:
        end = int(self.at[-1]) + len(data)
        if end > len(self.data):
            self.data = np.concatenate([self.data, np.empty(max(end, len(self.data)) - len(self.data) // 2, dtype=self.data.dtype)])
        self.data[self.at[-1] : end] = data
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Arrays by number, one after the other, and where each ends."""
        begin = self.at[which]
        size = self.at[which + 1] - begin
        end = np.cumsum(size)
        return self.data[np.arange(end[-1] if len(end) else 0) + np.repeat(begin - end + size, size)], end


class Tokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit integers. Units are tokenized once and remembered, by their hash and, so
    that equal hashes do no harm, by their bytes; a text with odd characters, or with the string of a special token, is tokenized as it is."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer as Whole

        self.whole = Whole.from_file(path)
        self.ends = np.zeros(self.whole.get_vocab_size(), dtype=bool)
        self.ends[[i for t, i in self.whole.get_vocab().items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known, self.number = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self.ids, self.bytes = _Pool("<u4"), _Pool("u1")

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, new: list[bytes]) -> None:
        """Ids of new units: of many as one text, in which just the last token of a unit ends a word; those with an apostrophe alone."""
        for at in range(0, len(new), 5000):
            some = new[at : at + 5000]
            odd = [i for i, w in enumerate(some) if b"'" in w]
            ids = self._encode(b" ".join([w for w in some if b"'" not in w] if odd else some).decode())
            size = np.diff(np.r_[-1, np.flatnonzero(self.ends[ids])])
            if odd:
                own = [self._encode(some[i].decode()) for i in odd]
                place = np.array(odd) - np.arange(len(odd))
                before = np.r_[0, np.cumsum(size)][place]
                ids = np.insert(ids, np.repeat(before, [len(x) for x in own]), np.concatenate(own))
                size = np.insert(size, place, [len(x) for x in own])
            self.ids.add(ids, size)
            self.bytes.add(np.frombuffer(b"".join(some), dtype=np.uint8), np.array([len(w) for w in some], dtype=np.int64))

    def _numbers(self, words: tc.Words) -> np.ndarray | None:
        """The number of each unit; None if units of one hash differ."""
        h, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.known) + len(h) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.known, h)
        new = np.ones(len(h), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != h
        if new.any():
            n = len(self.ids.at) - 1
            raw = words.data.tobytes()
            self._learn([raw[a:b] for a, b in zip(words.start[first[new]].tolist(), words.end[first[new]].tolist(), strict=True)])
            self.known = np.insert(self.known, at[new], h[new])
            self.number = np.insert(self.number, at[new], np.arange(n, n + int(new.sum())))
            at = np.searchsorted(self.known, h)
        number = self.number[at][which]
        held, end = self.bytes.take(number)
        same = np.array_equal(np.diff(np.r_[0, end]), words.end - words.start) and np.array_equal(held, words.data[_WORD[words.data]])
        return number if same else None

    def encode(self, texts: list[str]) -> list[bytes]:
        # Longer texts are cut at white space, which no unit holds.
        parts: list[list[bytes]] = [[] if "<|" in t or _ODD.search(t) else tc.slices(t.lower().encode(), CHARS) for t in texts]
        flat = [p for own in parts for p in own]
        done: list[bytes] | None = []
        at = 0
        while done is not None and at < len(flat):
            end, size = at + 1, len(flat[at])
            while end < len(flat) and size + len(flat[end]) <= CHARS:
                size += len(flat[end])
                end += 1
            some = self._encode_plain(flat[at:end])
            done = None if some is None else done + some
            at = end
        out, at = [], 0
        for t, own in zip(texts, parts, strict=True):
            out.append(b"".join(done[at : at + len(own)]) if own and done is not None else self._encode(t).tobytes())
            at += len(own)
        return out

    def _encode_plain(self, texts: list[bytes]) -> list[bytes] | None:
        words = units(texts)
        number = self._numbers(words)
        if number is None:
            return None
        ids, end = self.ids.take(number)
        border = np.r_[0, end][words.first].tolist()
        return [ids[a:b].tobytes() for a, b in zip(border[:-1], border[1:], strict=True)]


#: A worker's tokenizers by file: the words that one task learned serve the next.
_made: dict[str, Tokenizer] = {}


def _pieces(path: str | None, name: str):
    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        at = path
        if at is None:
            import public_tokenizers

            at = public_tokenizers.path(name)
        if at not in _made:
            _made[at] = Tokenizer(at)
        tokenizer = _made[at]
        for frame in frames:
            ids, texts = frame.column("doc_id").to_pylist(), frame.column("text")
            start = 0
            while start < len(ids):
                end, size, block = start, 0, []
                while end < len(ids) and (not block or size < CHARS):
                    block.append(texts[end].as_py() or "")
                    size += len(block[-1])
                    end += 1
                rows: list[tuple] = []
                for doc, own in zip(ids[start:end], tokenizer.encode(block), strict=True):
                    own += b"\0\0\0\0"
                    for k in range(0, len(own), 4 * ROOM):
                        rows.append((doc, k // (4 * ROOM), k // 4, len(own[k : k + 4 * ROOM]) // 4, zlib.crc32(own[k : k + 4 * ROOM])))
                columns = list(zip(*rows, strict=True))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])
                start = end

    return cut


def tokenize(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, name: str = "word_bpe_49k.json") -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of documents: ids, then id 0, cut into ROOM tokens at most.

    tokenizer: a file that executors can open; else that of the given name which each of them has installed. Null and empty texts are
    the one id 0; rows of null or repeated ids are cut like others; other columns are left out; an empty table gives an empty result.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(_pieces(tokenizer, name), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Best fit decreasing: the bin and the offset of each item, and the number of bins. Ties go to the item that came first.

    Bins are kept by what they have left, so that an item finds the fullest that it fits in by a search among ROOM sizes.
    """
    which, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(ROOM + 1)]
    left: list[int] = []  # sizes that some bin has left, sorted
    bins = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = bisect_left(left, n)
        if at == len(left):
            which[i], offset[i], rest, bin_ = bins, 0, ROOM - n, bins
            bins += 1
        else:
            size = left[at]
            bin_ = open_[size].pop()
            if not open_[size]:
                del left[at]
            which[i], offset[i], rest = bin_, ROOM - size, size - n
        if rest:
            if not open_[rest]:
                insort(left, rest)
            open_[rest].append(bin_)
    return which, offset, bins


def _pack_local(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the bin of this task, by number, and their offset there. Full pieces are bins of their own and are
    passed on; the others wait until there are ITEMS of them or the task ends."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    made = 0
    waiting: list[pa.RecordBatch] = []

    def emit(batch: pa.RecordBatch, which: np.ndarray, offset: np.ndarray, fill: np.ndarray) -> pa.RecordBatch:
        number = (task << 36) + made + which
        return pa.record_batch([*batch.columns, pa.array(number, pa.int64()), pa.array(offset, pa.int64()), pa.array(fill, pa.int64())], [*batch.schema.names, "bin", "offset", "fill"])

    def pack() -> pa.RecordBatch:
        nonlocal made
        batch = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        waiting.clear()
        lengths = batch.column("length").to_numpy()
        which, offset, n = best_fit(lengths)
        out = emit(batch, which, offset, np.bincount(which, lengths, minlength=n).astype(np.int64)[which])
        made += n
        return out

    for frame in frames:
        full = pc.equal(frame.column("length"), ROOM)
        whole = frame.filter(full)
        if whole.num_rows:
            n = whole.num_rows
            yield emit(whole, np.arange(n), np.zeros(n, dtype=np.int64), np.full(n, ROOM))
            made += n
        rest = frame.filter(pc.invert(full))
        if rest.num_rows:
            waiting.append(rest)
        if sum(w.num_rows for w in waiting) >= ITEMS:
            yield pack()
    if waiting:
        yield pack()


def _merge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bin, fill) to (bin, into, base, fill): best fit of bins as items; a merged bin has the number of one of its bins."""
    batches = [f for f in frames if f.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks().sort_by("bin")
    number, fill = table["bin"].to_numpy(), table["fill"].to_numpy()
    which, offset, n = best_fit(fill)
    first = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(first, which, number)
    total = np.bincount(which, fill, minlength=n).astype(np.int64)
    yield pa.record_batch([pa.array(x, pa.int64()) for x in (number, first[which], offset, total[which])], ["bin", "into", "base", "fill"])


def pack(pieces: DataFrame) -> DataFrame:
    """Pieces with sequence_id and offset: hierarchical best-fit packing into sequences of ROOM tokens.

    Each task packs its own pieces best-fit decreasing. Bins that lack more than SLACK tokens go on as items (bin, fill) to
    a round of fewer tasks, FAN_IN bins for each, until one task's bins are left; the last round merges those. If a round
    leaves more bins than that and merged less than a tenth, bins don't fit each other and it is the last. A round
    moves 16 bytes a bin, and bins that are full enough stay where they are. Pieces need a length; other columns may be null or repeated.
    Without pieces the result is empty.
    """
    spark = pieces.sparkSession
    packed = keep(pieces.mapInArrow(_pack_local, pieces.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ") + ", bin long, offset long, fill long"), "packed")
    under = packed.where(F.col("fill") < ROOM - SLACK).groupBy("bin").agg(F.max("fill").alias("fill"))
    under = keep(under, "under")
    rounds: list[DataFrame] = []
    n = under.count()
    while n > 1:
        tasks = -(-n // FAN_IN)
        dealt = under.repartition(tasks) if tasks > 1 else under.coalesce(1)
        merged = keep(dealt.mapInArrow(_merge, "bin long, into long, base long, fill long"), "merged")
        rounds.append(merged)
        if tasks == 1:
            break
        under = merged.where("bin = into").select("bin", "fill").where(F.col("fill") < ROOM - SLACK)
        m = under.count()
        if m > FAN_IN and m >= 0.9 * n:
            break
        n = m
    moved = packed.withColumn("base", F.lit(0).cast("long"))
    for merged in rounds:
        step = merged.select("bin", "into", F.col("base").alias("more")).where("bin <> into or more > 0")
        moved = moved.join(step, "bin", "left").withColumn("base", F.col("base") + F.coalesce("more", F.lit(0))).withColumn("bin", F.coalesce("into", "bin")).drop("into", "more")
    return moved.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), (F.col("offset") + F.col("base")).alias("offset"))


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """tokenize() and pack(). A null or empty text is the one id 0; rows of null or repeated ids are packed like others;
    other columns are left out; an empty table gives an empty result."""
    # A written table between the two: their workers' memory isn't needed at once, and a task that is run again makes the same bins.
    return pack(keep(tokenize(docs, doc_id, text, tokenizer), "pieces"))
