"""Near-duplicate texts: MinHash signatures, banding, verification, and connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import textcore as tc
from lexloom.llm.components import connected_components
from lexloom.llm.filters import bit_filter
from lexloom.llm.store import keep

#: Consecutive words of a shingle.
WIDTH = 5
#: Similarity in hundredths from which two texts are linked.
PERCENT = 75
#: A pair of this similarity shares no band with probability (1 - 0.75 ** 4) ** 48, about one in 10 ** 8.
BANDS, ROWS = 48, 4
#: Share of equal minima under which a pair is not compared on its sets: six standard deviations under 0.75.
AGREE = 0.56
#: Buckets of up to this many distinct sets are compared in pairs; larger ones by stars and then exactly, see near_duplicates().
CAP = 48
#: Members of a bucket from which they are dealt to shares, and the bits of the filter of such buckets.
HOT, SHARES, FILTER_BITS = 200, 32, 1 << 20
#: Signatures of a large bucket that are compared with as many others at once.
SLAB = 1024
#: What the stars left apart is compared in one of so many large buckets first, so that few rows are left for all of them.
PARTS = (8, 1)

_draw = np.random.default_rng(20250102)
_LINE = _draw.integers(0, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = _draw.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = _draw.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, minima binary"


def shingles(words: tc.Words) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of a block, and where each text's begin (then the count). A text of fewer words has
    the whole sequence as its one shingle; one without words has none."""
    h = words.hashes()
    n = np.diff(words.first)
    count = np.where(n >= WIDTH, n - WIDTH + 1, np.minimum(n, 1))
    begin = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(count, out=begin[1:])
    start = np.arange(begin[-1]) + np.repeat(words.first[:-1] - begin[:-1], count)
    padded = np.r_[h, np.zeros(WIDTH, dtype=np.uint64)]
    out = np.zeros(len(start), dtype=np.uint64)
    length = np.repeat(np.minimum(n, WIDTH), count)
    short = bool((length < WIDTH).any())
    for j in range(WIDTH):
        part = padded[start + j] * _LINE[j]
        out += np.where(length > j, part, 0) if short else part
    return tc.mix(out + length.astype(np.uint64)), begin


def _sign(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (ids,), texts in tc.batches(frames, "doc_id"):
        each, begin = shingles(tc.split(texts, tc.SOLID))
        full = np.flatnonzero(np.diff(begin))
        low = np.zeros((len(full), len(_TIMES)), dtype=np.uint64)
        if len(full):
            product = np.empty_like(each)
            for k, a in enumerate(_TIMES):
                np.multiply(each, a, out=product)
                low[:, k] = np.minimum.reduceat(product, begin[full])
        top = low >> np.uint64(32)
        keys = tc.mix((top.reshape(len(full), BANDS, ROWS) * _ROW).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
        # Minima of a larger set are smaller: only their mixed bits serve to compare signatures.
        minima = (tc.mix(top) & np.uint64(255)).astype(np.uint8)
        row = {int(i): j for j, i in enumerate(full)}
        out: list[list] = [[], [], [], []]
        for i in range(len(ids)):
            own = np.unique(each[begin[i] : begin[i + 1]])
            out[0].append(len(own))
            out[1].append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            out[2].append(keys[row[i]] if i in row else np.empty(0, dtype=np.int64))
            out[3].append(minima[row[i]].tobytes() if i in row else b"")
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())], ["doc_id", "n_shingles", "digest", "bands", "minima"])


def _sets(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (ids,), texts in tc.batches(frames, "doc_id"):
        each, begin = shingles(tc.split(texts, tc.SOLID))
        own = [np.unique(each[begin[i] : begin[i + 1]]).view(np.int64) for i in range(len(ids))]
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(own, pa.list_(pa.int64()))], ["doc_id", "shingles"])


def _agree(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        x, y = (np.frombuffer(b"".join(frame.column(c).to_pylist()), dtype=np.uint8).reshape(frame.num_rows, BANDS * ROWS) for c in ("x", "y"))
        near = (x == y).mean(axis=1) >= AGREE if frame.num_rows else np.zeros(0, dtype=bool)
        yield pa.record_batch([frame.column(c) for c in ("a", "b")], ["a", "b"]).filter(pa.array(near))


def _slabs(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Pairs, one of either slab, of different components whose signatures agree."""
    x, y = (np.frombuffer(b"".join(t["minima"].to_pylist()), dtype=np.uint8).reshape(t.num_rows, BANDS * ROWS) for t in (left, right))
    a, b = left["doc_id"].to_numpy(), right["doc_id"].to_numpy()
    same = left["component"].to_numpy()[:, None] == right["component"].to_numpy()[None, :]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(len(a) if len(b) else 0):
        j = np.flatnonzero(((y == x[i]).mean(axis=1) >= AGREE) & ~same[i])
        found.append((np.full(len(j), a[i]), b[j]))
    p = np.concatenate([f[0] for f in found]) if found else np.empty(0, dtype=np.int64)
    q = np.concatenate([f[1] for f in found]) if found else np.empty(0, dtype=np.int64)
    return pa.table({"a": pa.array(np.minimum(p, q), pa.int64()), "b": pa.array(np.maximum(p, q), pa.int64())})


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles (size of its set), component_id, kept (it has the smallest id of its component).

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, a set holds the distinct five-word shingles, and two documents are
    linked if 100 * intersection >= 75 * union. Documents with equal sets are one class from the start, so that copies
    are never compared. Classes that share a band meet: in buckets of up to CAP classes, every pair; in larger ones,
    each class with the bucket's first, and after components are known, every class outside the bucket's largest
    component with all classes of other components, in slabs. A candidate pair is compared by signature and then on
    the full sets. The only links that can be missed are pairs that share no band or whose signatures disagree by six
    standard deviations.

    Null and empty texts, and texts of white space, have an empty set and are linked with nothing. Rows without an id are
    not linked: component_id is null and kept is true. Repeated rows come back repeated. Other columns are left out. An
    empty table gives an empty result.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = keep(source.mapInArrow(_sign, _SIGNED), "signed")
    some = signed.where("n_shingles > 0 and doc_id is not null")
    classes = keep(some.groupBy("digest").agg(F.min(F.struct("doc_id", "bands", "minima")).alias("r")).select("digest", "r.*"), "classes")
    minima = classes.select("doc_id", "minima")
    member = classes.select(F.explode("bands").alias("key"), "doc_id")
    buckets = keep(member.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("lead")).where("n > 1"), "buckets")
    # The members of hot buckets are dealt to shares, which all know the bucket; a filter of fixed size says which are.
    hot = bit_filter(buckets.where(F.col("n") > HOT), "key", FILTER_BITS, "hot")
    shares = F.when(hot("key"), F.sequence(F.lit(0), F.lit(SHARES - 1))).otherwise(F.array(F.lit(0)))
    own = F.when(hot("key"), F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)).cast("int")).otherwise(0)
    met = member.withColumn("share", own).join(buckets.withColumn("share", F.explode(shares)).hint("merge"), ["key", "share"])
    met = keep(met.drop("share"), "met")
    together = met.where(F.col("n") <= CAP).groupBy("key").agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).select("ids").distinct()
    pairs = together.select(F.explode(F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, i + 2, size(ids)), y -> struct(x as a, y as b))))")).alias("p")).select("p.*")
    stars = met.where((F.col("n") > CAP) & (F.col("doc_id") > F.col("lead"))).select(F.col("lead").alias("a"), F.col("doc_id").alias("b"))
    links = _linked(pairs.unionByName(stars).distinct(), minima, source)
    found = keep(connected_components(links), "components")
    for part in PARTS:
        large = met.where((F.col("n") > CAP) & (F.pmod("key", F.lit(part)) == 0)).select("key", "doc_id")
        rest = keep(_outside(large, found, minima).distinct(), "rest")
        if not rest.isEmpty():
            more = _linked(rest, None, source)
            if not more.isEmpty():
                # What is known of components stands for the links before.
                found = keep(connected_components(more.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))), "components")
    of = classes.select("digest", F.col("doc_id").alias("node")).join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    out = some.select("doc_id", "n_shingles", "digest").join(of, "digest")
    none = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id").unionByName(none).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _linked(pairs: DataFrame, minima: DataFrame | None, source: DataFrame) -> DataFrame:
    """Those of the pairs that are similar enough, first by signature if minima are given, then on full sets."""
    if minima is not None:
        both = pairs.join(minima.select(F.col("doc_id").alias("a"), F.col("minima").alias("x")), "a").join(minima.select(F.col("doc_id").alias("b"), F.col("minima").alias("y")), "b")
        pairs = both.mapInArrow(_agree, "a long, b long")
    pairs = keep(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # As many ids as documents at worst: never broadcast.
    sets = keep(source.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, shingles array<long>"), "sets")
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t")), "b")
    common = F.size(F.array_intersect("s", "t"))
    return keep(both.where(100 * common >= PERCENT * (F.size("s") + F.size("t") - common)).select("a", "b").distinct(), "links")


def _outside(met: DataFrame, found: DataFrame, minima: DataFrame) -> DataFrame:
    """Candidate pairs of large buckets (key, doc_id) that stars left in different components."""
    named = met.join(found, met.doc_id == found.node, "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    parts = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    most = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.count("*").alias("parts"), F.sum("n").alias("all")).where("parts > 1").select("key", F.col("m.component").alias("main"), "all")
    # All of these buckets are large: their members are dealt to shares, which all know the bucket.
    share, every = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    dealt = named.withColumn("share", share).join(most.withColumn("share", every).hint("merge"), ["key", "share"]).drop("share")
    here = keep(dealt.join(minima, "doc_id"), "outside")
    slabs = F.ceil(F.col("all") / SLAB).cast("int")
    slab = F.pmod(F.xxhash64("doc_id"), slabs)
    right = here.select("key", slab.alias("right"), "doc_id", "component", "minima")
    left = here.where("component <> main").select("key", slab.alias("left"), slabs.alias("slabs"), "doc_id", "component", "minima")
    tiles = left.select("key", "left", "slabs").distinct().select("key", "left", F.explode(F.expr("sequence(0, slabs - 1)")).alias("right"))
    left = left.drop("slabs").join(tiles, ["key", "left"])
    right = right.join(tiles, ["key", "right"])
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # new columns, as both sides come from one table
    k = ["key", "left", "right"]
    return left.groupBy(*k).cogroup(right.groupBy(*k)).applyInArrow(_slabs, "a long, b long")
