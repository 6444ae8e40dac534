"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing, exact ranking of candidates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from lexloom.llm.store import keep

#: Neighbours of a query.
K = 20
#: Hash tables, and the width of a projection's cells in standard deviations of the projections.
TABLES, WIDTH = 10, 1.6
#: Projections of a table for each doubling of the vectors, at most so many, so that cells don't fill up as the vectors grow.
BITS_PER_DOUBLING, MOST_BITS = 0.5, 16
#: Cells that are visited in a table, at most; how many, and how many projections, is fitted on a sample: as few cells as find TARGET of
#: the sample's own nearest to ASKED of its vectors, as many as it should hold of the K nearest.
MOST_PROBES, TARGET, ASKED = 256, 0.94, 80
#: Rows of that bounded sample, by order of a hash of the id.
SAMPLE = 20_000
#: Vectors of a bucket that are ranked at once; larger buckets are split, and every part is visited. Rows that a task gets, as a rule.
PART, ROWS = 4096, 50_000


def probes(x: np.ndarray, most: int = MOST_PROBES) -> list[tuple[int, ...]]:
    """Moves (-1, 0, 1 for each projection) from a query's own cell in the order of estimated success: by the sum of the
    squared distances to the borders that are crossed. x: the query's places within its cells, from 0 to 1."""
    m = len(x)
    steps = sorted([(x[j] ** 2, j, -1) for j in range(m)] + [((1 - x[j]) ** 2, j, 1) for j in range(m)])
    out = [(0,) * m]
    heap: list[tuple[float, tuple[int, ...]]] = [(steps[0][0], (0,))]
    while heap and len(out) < most:
        cost, chosen = heappop(heap)
        last = chosen[-1]
        if last + 1 < len(steps):
            heappush(heap, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
            heappush(heap, (cost + steps[last + 1][0], (*chosen, last + 1)))
        moved = [steps[i] for i in chosen]
        if len({j for _, j, _ in moved}) == len(moved):
            move = [0] * m
            for _, j, d in moved:
                move[j] = d
            out.append(tuple(move))
    return out


@dataclass
class Hashing:
    """Tables of p-stable projections (p = 2) for vectors of at most the length norm. spread: what WIDTH is a multiple of."""

    norm: float
    bits: int
    spread: float
    probes: int = MOST_PROBES

    def cells(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """(tables, rows, projections): cells as real numbers. Vectors are brought to one length by one more coordinate, so
        that the nearest by distance are those of the largest inner product; a query's is 0."""
        last = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.norm**2 - (vectors**2).sum(axis=1)))
        if query:
            vectors = vectors * (self.norm / np.linalg.norm(vectors, axis=1, keepdims=True))
        full = np.column_stack([vectors, last])
        drawn = np.random.default_rng(20250103)
        directions, offset = drawn.standard_normal((TABLES, full.shape[1], self.bits)), drawn.random((TABLES, 1, self.bits))
        return (full @ directions) / (WIDTH * self.spread) + offset


def fit(sample: np.ndarray, norm: float, count: int) -> Hashing:
    """The hashing of count vectors, of which the sample is some: fewer projections where too many probes would be needed."""
    start = min(MOST_BITS, max(3, round(BITS_PER_DOUBLING * np.log2(max(count, 2)))))
    asked = sample[: min(ASKED, len(sample))]
    score = asked @ sample.T
    score[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    # One and a half times the share of the K nearest that a sample holds; eight at least.
    share = min(K, max(8, -(-3 * K * len(sample) // (2 * max(count, 1)))))
    near = np.argsort(-score, axis=1)[:, : min(share, max(1, len(sample) - 1))]
    for bits in range(start, 0, -1):
        h = Hashing(norm, bits, 1.0 / WIDTH)
        h.spread = float(np.std(h.cells(sample, query=False))) or 1.0
        held, real = np.floor(h.cells(sample, query=False)).astype(np.int64), h.cells(asked, query=True)
        own = np.floor(real).astype(np.int64)
        needed = np.full(near.shape, MOST_PROBES + 1)
        for t in range(TABLES):
            for i in range(len(asked)):
                order = {m: n for n, m in enumerate(probes(real[t, i] - own[t, i]), 1)}
                moves = held[t, near[i]] - own[t, i]
                needed[i] = np.minimum(needed[i], [order.get(tuple(m), MOST_PROBES + 1) for m in moves.tolist()])
        most = int(np.sort(needed.ravel())[min(needed.size - 1, int(np.ceil(TARGET * needed.size)) - 1)])
        if most <= MOST_PROBES or bits == 1:
            h.probes = min(most, MOST_PROBES)
            return h
    raise AssertionError


def _key(table: int, cells: np.ndarray) -> np.ndarray:
    from lexloom.llm.textcore import mix

    h = np.full(len(cells), table + 1, dtype=np.uint64)
    for j in range(cells.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[:, j].astype(np.int64).view(np.uint64))
    return h.view(np.int64)


def _matrix(frame: pa.RecordBatch, column: str = "v") -> np.ndarray:
    flat = frame.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(frame.num_rows, -1) if frame.num_rows else flat.reshape(0, 1)


def _index(h: Hashing):
    def index(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            if frame.num_rows:
                cells = np.floor(h.cells(_matrix(frame), query=False))
                for t in range(TABLES):
                    yield pa.record_batch([pa.array(_key(t, cells[t])), frame.column("c")], ["key", "c"])

    return index


def _ask(h: Hashing):
    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            if not frame.num_rows:
                continue
            real = h.cells(_matrix(frame), query=True)
            own = np.floor(real)
            ids = frame.column("query_id").to_numpy()
            for t in range(TABLES):
                cells, who = [], []
                for i in range(len(ids)):
                    moves = np.array(probes(real[t, i] - own[t, i], h.probes))
                    cells.append(own[t, i] + moves)
                    who.append(np.full(len(moves), ids[i]))
                yield pa.record_batch([pa.array(_key(t, np.concatenate(cells))), pa.array(np.concatenate(who))], ["key", "query_id"])

    return ask


def _rank(group: tuple, queries: pa.Table, held: pa.Table) -> pa.Table:
    """Of parts of buckets (key, part), the K + 1 nearest classes of all parts for each query that visits them. queries: visits, and for
    each query that makes some a row with its vector and no key."""
    none = pa.table({"query_id": pa.array([], pa.int64()), "c": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not queries.num_rows or not held.num_rows:
        return none
    vectors, visits = queries.filter(pc.is_null(queries["key"])), queries.filter(pc.is_valid(queries["key"])).drop_columns(["v"])
    vectors, (visits, held) = vectors.sort_by("query_id").combine_chunks(), (t.sort_by([("key", "ascending"), ("part", "ascending")]).combine_chunks() for t in (visits, held))
    names = [np.rec.fromarrays([t["key"].to_numpy(), t["part"].to_numpy()]) for t in (visits, held)]
    who, x, v = vectors["query_id"].to_numpy(), _matrix(vectors.to_batches()[0]), _matrix(held.to_batches()[0])
    of, classes = np.searchsorted(who, visits["query_id"].to_numpy()), held["c"].to_numpy()
    units, begin = np.unique(names[1], return_index=True)
    end = np.r_[begin[1:], len(v)]
    low, high = np.searchsorted(names[0], units, "left"), np.searchsorted(names[0], units, "right")
    found: list[tuple[np.ndarray, ...]] = []
    size = 0

    def best() -> None:
        """Keeps, of all that was found, the K + 1 nearest different classes of each query."""
        nonlocal size
        q, c, score = (np.concatenate(z) for z in zip(*found, strict=True))
        order = np.lexsort((c, q))
        new = np.r_[True, (np.diff(q[order]) != 0) | (np.diff(c[order]) != 0)]
        q, c, score = (z[order][new] for z in (q, c, score))
        order = np.lexsort((c, -score, q))
        q, c, score = (z[order] for z in (q, c, score))
        some = np.arange(len(q)) - np.searchsorted(q, q) <= K
        found[:] = [(q[some], c[some], score[some])]
        size = int(some.sum())

    for a, b, i, j in zip(low.tolist(), high.tolist(), begin.tolist(), end.tolist(), strict=True):
        for at in range(a, b, 256):
            asked = of[at : min(b, at + 256)]
            score = x[asked] @ v[i:j].T
            n = min(K + 1, j - i)
            # Ties at the border go to the smaller class.
            top = np.lexsort((np.broadcast_to(classes[i:j], score.shape), -score), axis=1)[:, :n] if n < j - i else np.broadcast_to(np.arange(n), score.shape)
            found.append((np.repeat(asked, n), classes[i:j][top].ravel(), np.take_along_axis(score, top, axis=1).ravel()))
            size += len(found[-1][0])
            if size > 1_000_000:
                best()
    if not found:
        return none
    best()
    q, c, score = found[0]
    return pa.table({"query_id": pa.array(who[q].astype(np.int64)), "c": pa.array(c.astype(np.int64)), "score": pa.array(score.astype(np.float64))})


def _met(asked: DataFrame, queries: DataFrame, held: DataFrame, rows: int) -> DataFrame:
    """(query_id, c, score) of queries and classes that meet in a part of a bucket; parts are dealt to groups of some ROWS rows each, and a
    query's vector goes to a group once."""
    groups = max(2 * held.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS))
    g = F.pmod(F.xxhash64("key", "part"), F.lit(groups)).cast("int").alias("g")
    visits = keep(asked.select(g, "key", "part", "query_id"), "visits")
    vectors = visits.select("g", "query_id").distinct().join(queries, "query_id").select("g", F.lit(None).cast("long").alias("key"), F.lit(None).cast("int").alias("part"), "query_id", "v")
    left = visits.withColumn("v", F.lit(None).cast("array<double>")).unionByName(vectors)
    right = held.select(g, "key", "part", "c", "v")
    right = right.select(*(F.col(x).alias(x) for x in right.columns))
    return left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(_rank, "query_id long, c long, score double")


def nearest(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the K nearest found of each query, by largest inner product, ties to the smaller id.

    Queries are the rows whose id is divisible by `every`; every other row is a candidate. All rows are indexed: equal vectors
    are one class, of which the K + 1 smallest ids can be neighbours of a query, so that copies fill no bucket. TABLES
    tables deal classes to cells; their projections grow with the vectors, and a query visits as many cells of a table, in the order of
    estimated success, as the sample needs. Classes of a cell are ranked in parts of PART at most by one product of matrices,
    and only K + 1 leave a task for a query. Queries for which this finds fewer than K are ranked against all classes, in such
    parts. The scores that are returned are sums over the original vectors in double precision.

    Null vectors, vectors of another length than the most frequent one, zero vectors and those with null or non-finite components
    take no part, nor do rows without an id. Rows that repeat an id count once, with the least of its vectors. Other columns are left out,
    whatever their names. Without vectors the result is empty.
    """
    v = F.col(embedding).cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null").where(good)
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    spark = vectors.sparkSession
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == sizes.d).withColumn("h", F.xxhash64("v"))
    rows = keep(rows, "vectors")
    # The smallest ids of a class, first within shares of it.
    some = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("h", "v", "salt").orderBy("vec_id"))).where(F.col("r") <= K + 1)
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))).where(F.col("r") <= K + 1)
    members = keep(some.select("h", "v", "vec_id", "r").withColumn("c", F.min("vec_id").over(Window.partitionBy("h", "v"))), "members")
    classes = members.where("r = 1").select("c", "v")
    facts = classes.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), F.count("*")).first()
    sample = classes.orderBy(F.xxhash64("c"), "c").limit(SAMPLE).select("v").toArrow().combine_chunks().to_batches()[0]
    hashing = fit(_matrix(sample), float(np.sqrt(facts[0])), facts[1])
    bucket = keep(classes.mapInArrow(_index(hashing), "key long, c long"), "index")
    parts = bucket.groupBy("key").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "v")
    visits = queries.mapInArrow(_ask(hashing), "key long, query_id long").distinct().join(parts, "key").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    held = bucket.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int")).join(classes, "c")
    found = _met(visits, queries, held, TABLES * facts[1])
    ranked = keep(_ranked(found, members, queries), "ranked")
    full = ranked.where(F.col("rank") == K).select("query_id")
    short = keep(queries.join(full, "query_id", "left_anti"), "short")
    n_short = short.count()
    if not n_short:
        return ranked
    shares, blocks = -(-n_short // PART), max(1, -(-facts[1] // PART))
    asked = short.withColumn("key", F.pmod(F.xxhash64("query_id"), F.lit(shares))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    held = classes.withColumn("part", F.pmod(F.xxhash64("c"), F.lit(blocks)).cast("int")).withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    every_one = _met(asked, short, held, shares * facts[1])
    return ranked.join(full, "query_id", "left_semi").unionByName(_ranked(every_one, members, short))


def _ranked(found: DataFrame, members: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score) of the K nearest members of the classes found."""
    near = found.groupBy("query_id", "c").agg(F.max("score").alias("score"))
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "c"))).where(F.col("r") <= K + 8)
    pairs = near.select("query_id", "c").join(members.select("c", "vec_id", F.col("v").alias("y")), "c").where("vec_id <> query_id").join(queries.withColumnRenamed("v", "x"), "query_id")
    scored = pairs.select("query_id", "vec_id", F.aggregate(F.zip_with("x", "y", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x).alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= K)
    return ranked.select("query_id", "rank", "vec_id", "score")
