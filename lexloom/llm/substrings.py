"""Removal of byte strings that occur elsewhere: column-wise suffix order of aligned segments.

A string of LENGTH bytes has an anchor: its K-gram of the least hash. Equal strings have equal anchors at the same place, so
that all strings with one anchor form segments that can be aligned at it, and strings are compared only within the
segments of an anchor. There the order of all suffixes is built column by column from the right: each round puts one symbol ahead of
every segment's suffix, sorts the last order stably by it, and takes each new common prefix from the minimum of the last ones between
the two suffixes. That is the multi-document construction of Burrows-Wheeler order and common prefixes with one symbol
a document and round, in which alignment makes a round's work one symbol a segment instead of a pass over the whole transform.

Passages of words go the same way: a text is also seen as the hashes of its words, WORD bytes each, of which one is a symbol, so that
LENGTH bytes are LENGTH // WORD words. The lowest bit of an anchor's hash tells the two views of the texts apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import textcore as tc
from lexloom.llm.store import drop, keep, row_key

#: Bytes of the strings.
LENGTH = 400
#: Bytes of an anchor, and how many of them a string has.
GRAM = 64
#: Bytes of a word's hash.
WORD = 8
#: Distinct segments of an anchor that are aligned in one task; those of more frequent anchors are compared by their strings.
CAP = 16_000
#: Bytes of a text in which strings' starts are worked on at once.
SLICE = 1 << 20
#: Bytes of segments in one alignment.
ALIGNED = 8 << 20

_TOP = np.uint64(0xFFFFFFFF00000000)


def anchors(texts: list[bytes], unit: int = 1) -> tuple[np.ndarray, ...]:
    """(owner, h, s, geo) of the segments of a block of texts, a symbol of which has unit bytes: the text; hashes of the anchor and of the
    segment; and place << 20 | left << 10 | right, where strings start from left to right bytes before the anchor at place."""
    raw = b"".join(texts)
    n = np.array([len(t) // unit for t in texts], dtype=np.int64)
    length, gram = LENGTH // unit, GRAM // unit
    window = length - gram + 1
    if n.max(initial=0) < length:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))
    data = tc._CODE[np.frombuffer(raw, dtype=np.uint8)] if unit == 1 else np.frombuffer(raw, dtype=np.uint64)
    at = np.r_[0, np.cumsum(n)]
    up, down = tc.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data * up[: len(data)], out=sums[1:])
    count = len(data) - gram + 1
    h = tc.mix((sums[gram:] - sums[:count]) * down[:count])
    # The least of each window by minima from either end of blocks of its length; ties go to the first.
    key = (h & _TOP) | np.arange(count, dtype=np.uint64)
    blocks = -(-count // window) + 1
    padded = np.full(blocks * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:count] = key
    grid = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(at[:-1], at[1:], strict=True) if b - a >= length])
    place = (np.minimum(behind[starts], ahead[starts + window - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.searchsorted(at, starts, side="right") - 1
    head = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
    tail = np.r_[head[1:], len(starts)] - 1
    lo, hi, p, owner = starts[head], starts[tail], place[head], owner[head]
    left, right = p - lo, p - hi
    end = hi + length
    own = tc.mix((sums[end] - sums[lo]) * down[lo] + (left * 1024 + right).astype(np.uint64))
    return owner, h[p], own, ((p - at[owner]) << 20 | left << 10 | right) * unit


_READ = "doc_id long, key binary, n_bytes long, sha string, anchors array<struct<h:long,s:long,geo:long>>"
_ANCHOR = pa.struct([("h", pa.int64()), ("s", pa.int64()), ("geo", pa.int64())])


def sliced(texts: list[bytes], unit: int = 1) -> tuple[np.ndarray, ...]:
    """As anchors(), with bounded memory: longer texts are cut into slices in which each string starts in one of them. A segment may be
    cut in two, whose strings start at different places before the same anchor."""
    parts, of, shift = [], [], []
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), SLICE):
            parts.append(t[at : at + SLICE + LENGTH - unit])
            of.append(i)
            shift.append(at)
    found: list[tuple] = []
    a = 0
    while a < len(parts):
        b, size = a + 1, len(parts[a])
        while b < len(parts) and size + len(parts[b]) <= 2 * SLICE:
            size += len(parts[b])
            b += 1
        owner, h, s, geo = anchors(parts[a:b], unit)
        found.append((np.array(of[a:b], dtype=np.int64)[owner], h, s, geo + (np.array(shift[a:b], dtype=np.int64)[owner] << 20)))
        a = b
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def coded(texts: list[bytes]) -> list[bytes]:
    """The hashes of each text's words [^\\x20\\x09-\\x0D]+, with A-Z lower-cased."""
    out = [b""] * len(texts)
    some = [i for i, t in enumerate(texts) if len(t) <= SLICE]
    words = tc.split([texts[i] for i in some] or [b""], tc.SOLID)
    raw = words.hashes().tobytes()
    for i, a, b in zip(some, words.first[:-1].tolist(), words.first[1:].tolist(), strict=False):
        out[i] = raw[a * WORD : b * WORD]
    for i in set(range(len(texts))).difference(some):
        out[i] = b"".join(tc.split([x], tc.SOLID).hashes().tobytes() for x in tc.slices(texts[i], SLICE))
    return out


def _read(frames: Iterator[pa.RecordBatch], with_words: bool) -> Iterator[pa.RecordBatch]:
    for (ids, keys), texts in tc.batches(frames, "doc_id", "key"):
        views = [sliced(texts), *([sliced(coded(texts), WORD)] if with_words else [])]
        owner, h, s, geo = (np.concatenate(x) for x in zip(*((o, h & ~np.uint64(1) | np.uint64(i), s, g) for i, (o, h, s, g) in enumerate(views)), strict=True))
        order = np.argsort(owner, kind="stable")
        owner, h, s, geo = owner[order], h[order], s[order], geo[order]
        structs = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array(s.view(np.int64)), pa.array(geo)], fields=list(_ANCHOR))
        first = np.searchsorted(owner, np.arange(len(ids) + 1))
        yield pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.ListArray.from_arrays(pa.array(first, pa.int32()), structs)],
            ["doc_id", "key", "n_bytes", "sha", "anchors"],
        )


_SEGMENT = "h long, s long, single boolean, large boolean, geo long, segment binary"


def _cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted segments of each text."""
    for (wanted,), texts in tc.batches(frames, "wanted"):
        rows: list[tuple] = []
        some = [i for i, own in enumerate(wanted) if any(w["h"] & 1 for w in own)]
        codes = dict(zip(some, coded([texts[i] for i in some]), strict=True)) if some else {}
        for i, own in enumerate(wanted):
            for w in own:
                text, geo = codes[i] if w["h"] & 1 else texts[i], w["geo"]
                p, left, right = geo >> 20, geo >> 10 & 1023, geo & 1023
                rows.append((w["h"], w["s"], w["single"], w["large"], geo & 0xFFFFF, text[p - left : p - right + LENGTH]))
        if rows:
            c = list(zip(*rows, strict=True))
            yield pa.record_batch([pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary()), strict=True)], ["h", "s", "single", "large", "geo", "segment"])


def column_order(segments: list[bytes], left: np.ndarray, right: np.ndarray, group: np.ndarray, unit: int = 1) -> np.ndarray:
    """Which strings recur in another segment of the same group: a matrix (segment, symbols before the anchor).

    Segments of group g start left symbols of unit bytes before their anchor; strings of LENGTH bytes start from left to right symbols
    before it.
    """
    m, length = len(segments), LENGTH // unit
    most = int(left.max(initial=0))
    size = np.array([len(s) // unit for s in segments], dtype=np.int64)
    width = int((size - left).max(initial=0)) + most
    # One column for each place relative to the anchor, read from the last to the first; -1 where a segment has none.
    flat, kinds = np.frombuffer(b"".join(segments), dtype=np.uint8), 256
    if unit == WORD:
        different, flat = np.unique(flat.view(np.uint64), return_inverse=True)
        kinds = len(different)
    columns = np.full((width, m), -1, dtype=np.int16 if unit == 1 else np.int32)
    of = np.repeat(np.arange(m), size)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    columns[inside + np.repeat(most - left, size), of] = flat
    found = np.zeros((m, most + 1), dtype=bool)
    order = np.argsort(group, kind="stable")
    common = np.zeros(m, dtype=np.int32)  # with the one before in the order
    base = group.astype(np.int64) * (kinds + 1) + 1
    for c in range(width - 1, -1, -1):
        key = base[order] + columns[c, order]
        move = np.argsort(key, kind="stable")
        sorted_key = key[move]
        same = np.zeros(m, dtype=bool)
        same[1:] = sorted_key[1:] == sorted_key[:-1]
        now = order[move]
        same &= columns[c, now] >= 0
        # The least of the last common prefixes between two that are now neighbours, by a table of powers of two.
        b = move[same]
        a = move[np.flatnonzero(same) - 1] + 1
        span = b - a
        least = common[b].copy()
        table, step = common, 1
        while step <= int(span.max(initial=0)):
            nxt = table.copy()
            nxt[: m - step] = np.minimum(table[: m - step], table[step:])
            level = (span + 1 >= 2 * step) & (span + 1 < 4 * step)
            # from a, and up to b
            table, step = nxt, step * 2
            w = np.flatnonzero(level)
            least[w] = np.minimum(table[a[w]], table[b[w] - step + 1])
        common = np.zeros(m, dtype=np.int32)
        common[same] = np.minimum(least + 1, length)
        order = now
        before = most - c
        if 0 <= before <= most:
            full = common >= length
            hit = full.copy()
            hit[:-1] |= full[1:]
            found[order[hit], before] = True
    valid = (np.arange(most + 1)[None, :] <= left[:, None]) & (np.arange(most + 1)[None, :] >= right[:, None])
    return found & valid


_RUNS = "h long, s long, runs array<struct<first:int,last:int>>"
_RUN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _runs(flags: np.ndarray, unit: int) -> list[dict]:
    """Runs of set places, in bytes, from the one farthest before the anchor."""
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [{"first": (int(b) - 1) * unit, "last": int(a) * unit} for a, b in zip(edge[0::2], edge[1::2], strict=True)]


def _align(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by anchor to the runs of recurring strings of those that occur once: whole anchors at a time."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        for unit in (1, WORD):
            own = [r for r in rows if (r[0] & 1) == (unit == WORD)]
            if own:
                geo = np.array([r[3] for r in own], dtype=np.int64)
                group = np.unique(np.array([r[0] for r in own]), return_inverse=True)[1]
                found = column_order([r[4] for r in own], (geo >> 10) // unit, (geo & 1023) // unit, group, unit)
                out += [(r[0], r[1], _runs(f, unit)) for r, f in zip(own, found, strict=True) if r[2] and f.any()]
        h, s, runs = zip(*out, strict=True) if out else ((), (), ())
        return pa.record_batch([pa.array(h, pa.int64()), pa.array(s, pa.int64()), pa.array(runs, _RUN)], ["h", "s", "runs"])

    rows: list[tuple] = []
    size, last = 0, 0  # bytes; where the current anchor's rows begin
    for frame in frames:
        for r in zip(*(frame.column(c).to_pylist() for c in ("h", "s", "single", "geo", "segment")), strict=True):
            if rows and rows[-1][0] != r[0]:
                last = len(rows)
                if size >= ALIGNED:
                    yield flush(rows)
                    rows, size, last = [], 0, 0
            rows.append(r)
            size += len(r[4])
    if rows:
        yield flush(rows)


def _strings(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each string of segments."""
    for frame in frames:
        for h, s, single, geo, seg in zip(*(frame.column(c).to_pylist() for c in ("h", "s", "single", "geo", "segment")), strict=True):
            left, right = geo >> 10, geo & 1023
            before = list(range(left, right - 1, -WORD if h & 1 else -1))
            yield pa.record_batch(
                [pa.array([h] * len(before)), pa.array([s] * len(before)), pa.array([single] * len(before)), pa.array(before, pa.int32()), pa.array([hashlib.blake2b(seg[left - b : left - b + LENGTH], digest_size=16).digest() for b in before])],
                ["h", "s", "single", "before", "string"],
            )


def _merge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Starts of recurring strings to the spans that they cover, in bytes or in words."""
    for frame in frames:
        out: list[tuple] = []
        for key, words, runs in zip(*(frame.column(c).to_pylist() for c in ("key", "words", "runs")), strict=True):
            unit = WORD if words else 1
            spans: list[list[int]] = []
            for a, b in sorted((r["a"] // unit, (r["b"] + LENGTH) // unit) for r in runs):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
            out.append((key, words, [{"start": a, "end": b} for a, b in spans], sum(b - a for a, b in spans)))
        c = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.record_batch([pa.array(c[0], pa.binary()), pa.array(c[1], pa.bool_()), pa.array(c[2], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(c[3], pa.int64())], ["key", "words", "spans", "n_covered"])


def _kept(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (keys, spans), texts in tc.batches(frames, "key", "spans"):
        out: list[bytes] = []
        for own, text in zip(spans, texts, strict=True):
            at, parts = 0, []
            for s in own:
                parts.append(text[at : s["start"]])
                at = s["end"]
            out.append(b"".join([*parts, text[at:]]))
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in out]), pa.array(out, pa.binary())], ["key", "kept_sha", "kept"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, with_kept: bool = False, with_words: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), spans (start, end in bytes), kept_sha256, and,
    with_kept, kept (the bytes that stay; for documents without removals null, as their text stays as it is), and, with_words,
    n_repeated_words (words in a passage of LENGTH // WORD words that also starts anywhere else; a passage's bytes may be fewer than LENGTH, so
    that they stay).

    A byte of a text's UTF-8 is removed if a string of LENGTH bytes that covers it also starts anywhere else, in the
    same document or another. Anchors' hashes are counted over the whole corpus first; only segments of anchors that occur again are
    read, and of equal segments one. Anchors with more than CAP distinct segments are compared by digests of their
    strings, in a combined aggregate, so that no task gets all segments of a very common passage.

    Null texts are empty; texts shorter than LENGTH lose nothing. Rows are told apart by 128 bits of id and text: rows that
    share an id, or have none, have results of their own, and repeated rows count as documents of their own and get the same result.
    Other columns are left out, whatever their names. An empty table gives an empty result.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("key"), value.alias("text"))
    read = keep(source.mapInArrow(partial(_read, with_words=with_words), _READ), "read")
    occ = read.select("key", F.explode("anchors").alias("o")).select("key", "o.*")
    seg = occ.groupBy("h", "s").agg(F.count("*").alias("n"), F.min(F.struct("key", "geo")).alias("one"))
    often = seg.groupBy("h").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).where("total > 1")
    seg = keep(seg.join(often, "h").select("h", "s", "n", "one", "kinds"), "segments")
    want = seg.where("kinds > 1").groupBy(F.col("one.key").alias("key")).agg(F.collect_list(F.struct("h", "s", (F.col("n") == 1).alias("single"), (F.col("kinds") > CAP).alias("large"), F.col("one.geo").alias("geo"))).alias("wanted"))
    texts = source.select("key", "text")
    cut = texts.join(want.hint("merge"), "key").select("wanted", "text").mapInArrow(_cut, _SEGMENT)
    cut = keep(cut, "cut")
    some = cut.where("not large").select("h", "s", "single", "geo", "segment")
    aligned = some.repartition("h").sortWithinPartitions("h").mapInArrow(_align, _RUNS)
    strings = cut.where("large").mapInArrow(_strings, "h long, s long, single boolean, before int, string binary").dropDuplicates(["h", "s", "before"])
    common = strings.groupBy("h", "before", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    single = strings.where("single").join(common, ["h", "before", "string"], "left_semi").select("h", "s", F.col("before").alias("first"), F.col("before").alias("last"))
    runs = aligned.select("h", "s", F.explode("runs").alias("r")).select("h", "s", "r.*").unionByName(single)
    # A segment that occurs once is its anchor's only such; one that occurs again recurs as a whole wherever it stands.
    once = runs.join(seg.where("n = 1").select("h", "s", "one"), ["h", "s"]).select("h", "one.key", "one.geo", "first", "last")
    again = occ.join(seg.where("n > 1").select("h", "s"), ["h", "s"], "left_semi").select("h", "key", "geo", F.shiftright("geo", 10).bitwiseAND(F.lit(1023)).cast("int").alias("first"), F.col("geo").bitwiseAND(F.lit(1023)).cast("int").alias("last"))
    place = F.shiftright("geo", 20)
    marks = once.unionByName(again).select("key", (F.col("h").bitwiseAND(F.lit(1)) == 1).alias("words"), F.struct((place - F.col("first")).alias("a"), (place - F.col("last")).alias("b")).alias("r"))
    covered = keep(marks.groupBy("key", "words").agg(F.collect_set("r").alias("runs")).mapInArrow(_merge, "key binary, words boolean, spans array<struct<start:long,end:long>>, n_covered long"), "spans")
    for done in (cut, seg):
        drop(docs.sparkSession, done)
    spans = covered.where("not words").select("key", "spans", F.col("n_covered").alias("n_removed"))
    facts = read.select("doc_id", "key", "n_bytes", "sha").join(spans, "key", "left")
    part = spans.join(read.select("key", "n_bytes").distinct(), "key").where("n_removed < n_bytes").select("key", "spans")
    rest = texts.join(part.hint("merge"), "key").mapInArrow(_kept, "key binary, kept_sha string, kept binary")
    rest = rest if with_kept else rest.drop("kept")
    rest = rest.groupBy("key").agg(*(F.first(c).alias(c) for c in rest.columns if c != "key"))
    out = facts.join(rest, "key", "left")
    if with_words:
        out = out.join(covered.where("words").select("key", F.col("n_covered").alias("n_repeated_words")), "key", "left")
    empty = hashlib.sha256(b"").hexdigest()
    sha = F.when(F.col("spans").isNull(), F.col("sha")).when(F.col("n_removed") == F.col("n_bytes"), F.lit(empty)).otherwise(F.col("kept_sha"))
    kept = [F.when(F.col("spans").isNull(), F.lit(None)).when(F.col("n_removed") == F.col("n_bytes"), F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if with_kept else []
    words = [F.coalesce("n_repeated_words", F.lit(0).cast("long")).alias("n_repeated_words")] if with_words else []
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce(F.size("spans").cast("long"), F.lit(0).cast("long")).alias("n_spans"), F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")).alias("spans"), sha.alias("kept_sha256"), *kept, *words)
