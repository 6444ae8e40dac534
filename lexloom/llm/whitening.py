"""Whitening of embeddings: the leading eigenvectors of their covariance by block Lanczos, without the covariance matrix.

A pass multiplies the centred vectors' XᵀX by a block of directions: every task sums up its rows' share, the shares are added row by
row of the product, and the driver holds a basis of a few blocks. Each block is made orthogonal to the whole basis; a block that
breaks down goes on with random directions, and a basis that is full begins again from its best vectors. The passes end when the
residuals of the wanted eigenvectors are at rounding error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexloom.llm.store import keep

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries whose SCALE-fold is beyond this, which no 64 bits would hold, stand for it.
LIMIT = 2.0**62
#: Directions of one pass, and blocks of a basis before it begins again (at least twice what is wanted).
BLOCK, BLOCKS = 16, 12
#: Residuals, as a share of the trace and of the largest eigenvalue, at which a vector counts as found; the share of the trace up to which an
#: eigenvalue counts as none.
FOUND, ROUNDING, NOTHING = 1e-15, 4e-15, 1e-12
#: Passes after which the best vectors so far are taken.
PASSES = 200

_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_vectors(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, x array<long>) of the rows whose vector is not null and has only finite entries. Vectors without entries go, and so do
    those of another length than the most frequent one (of equally frequent lengths, the smaller)."""
    c = F.col(vector).cast("array<double>")
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.when(F.coalesce(fine, F.lit(False)) & (F.size(c) > 0), c).alias("c")).where("c is not null")
    x = F.transform("c", lambda e: (F.floor(F.greatest(F.least(e * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))) + SHIFT).cast("long"))
    rows = keep(rows.select("vec_id", x.alias("x")), "vectors")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("x") == (common.d if common else 0))


def _matrices(frames: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for frame in frames:
        if frame.num_rows:
            yield frame, frame.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def dimension_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and the exact sum of each dimension: a row of either for each task and dimension is shuffled."""
    size = rows.select(F.size("x").alias("d")).first()
    if size is None:
        return 0, []
    d = size.d

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for _, x in _matrices(frames, d):
            own = x.sum(axis=0) if len(x) * int(np.abs(x).max()) < 2**62 else x.astype(object).sum(axis=0)
            n, total = n + len(x), [a + b for a, b in zip(total, own.tolist(), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array([str(t) for t in total]), pa.array(np.full(d, n))], names=["i", "s", "n"])

    parts = rows.select("x").mapInArrow(add, "i int, s string, n long")
    found = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect()  # d rows
    return found[0].n, [int(r.s) for r in found]


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, in Python's integers where 64 bits might not hold it."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums)))
    return n * x - np.array(sums, dtype=np.int64) if most < 2**61 else n * x.astype(object) - np.array(sums, dtype=object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _scaled(x, n, sums).astype(np.float64) / n


def product(rows: DataFrame, directions: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """XᵀX times a block of directions, divided by n, X being the centred vectors: one pass over them."""
    d, width = directions.shape
    shared = rows.sparkSession.sparkContext.broadcast(directions)  # d times width doubles
    names = [f"s{j}" for j in range(width)]

    def share(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, width))
        for _, x in _matrices(frames, d):
            c = _centred(x, n, sums)
            total += c.T @ (c @ shared.value)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), *(pa.array(total[:, j]) for j in range(width))], names=["i", *names])

    parts = rows.select("x").mapInArrow(share, ", ".join(["i int", *(f"{s} double" for s in names)]))
    out = np.zeros((d, width))
    for r in parts.groupBy("i").agg(*(F.sum(s).alias(s) for s in names)).collect():  # d rows
        out[r.i] = r[1:]
    shared.destroy()
    return out / n


def _orthonormal(block: np.ndarray, basis: np.ndarray, random: np.random.Generator, small: float) -> np.ndarray:
    """The block made orthonormal, and to the basis, twice over. Columns that break down are replaced by random ones; there are no more
    columns than there is room for."""
    d = len(block)
    columns = []
    have = basis
    for v in block.T:
        if have.shape[1] == d:
            break
        least = max(small, 1e-10 * np.linalg.norm(v))
        while True:
            for _ in range(2):
                v = v - have @ (have.T @ v)
            if (left := np.linalg.norm(v)) > least:
                break
            v = random.standard_normal(d)
            least = 1e-10 * np.linalg.norm(v)
        v = v / left
        v = v - have @ (have.T @ v)
        v /= np.linalg.norm(v)
        columns.append(v)
        have = np.column_stack([have, v])
    return np.array(columns).T.reshape(d, len(columns))


def block_lanczos(multiply: Callable[[np.ndarray], np.ndarray], d: int, trace: float, wanted: int, block: int = BLOCK, blocks: int = BLOCKS, passes: int = PASSES, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of a symmetric matrix that is known by its products: the `wanted` largest, falling, without those
    that are nothing beside the trace. Fully reorthogonalised, with restarts from Ritz vectors and after breakdowns."""
    random = np.random.default_rng(seed)
    wanted, block = min(wanted, d), min(block, d)
    room = min(d, max(blocks * block, 2 * wanted + block))
    small = 1e-13 * max(trace, 1e-300)
    basis = images = np.zeros((d, 0))
    q = _orthonormal(random.standard_normal((d, block)), basis, random, 0.0)
    for _ in range(passes):
        image = multiply(q)
        basis, images = np.column_stack([basis, q]), np.column_stack([images, image])
        small_matrix = basis.T @ images
        values, vectors = np.linalg.eigh((small_matrix + small_matrix.T) / 2)
        order = np.argsort(values)[::-1]
        values, vectors = values[order], vectors[:, order]
        ritz, ritz_images = basis @ vectors, images @ vectors
        residual = ritz_images - ritz * values
        k = min(wanted, len(values))
        if basis.shape[1] == d or (k == wanted and np.linalg.norm(residual[:, :k], axis=0).max() <= max(FOUND * trace, ROUNDING * abs(values[0]))):
            break
        if basis.shape[1] + block > room:
            # What is wanted and as much again begins the next basis; the residuals of the first are its next block.
            keep_ = min(room - block, wanted + block)
            basis, images = ritz[:, :keep_], ritz_images[:, :keep_]
            image = residual[:, :block]
        q = _orthonormal(image, basis, random, small)
    real = values[:k] > NOTHING * trace
    return values[:k][real], ritz[:, :k][:, real]


def whitened(embeddings: DataFrame, components: int = 8, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each vector that takes part and each component.

    Vectors that are null, have no entries, or hold null or non-finite entries take no part (integer_vectors). Components are numbered from 1 by
    falling eigenvalue; those whose eigenvalue is nothing beside the trace (as many vectors or fewer, or equal ones) can't be whitened
    and are left out, so that one vector alone, or an empty table, gives no rows. Repeated rows count as often as they stand
    there, a null vec_id stays null, and further columns are ignored. deviation is null where it is more than 64 bits hold. Equal eigenvalues
    have any orthonormal directions of their space.
    """
    spark = embeddings.sparkSession
    rows = integer_vectors(embeddings, vector, key)
    n, sums = dimension_sums(rows)
    if not n:
        return spark.createDataFrame([], _RESULT)
    d = len(sums)

    def deviations(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame, x in _matrices(frames, d):
            y = _scaled(x, n, sums)
            safe = y.dtype != object and d * int(np.abs(y).max(initial=0)) ** 2 < 2**63
            own = (y * y).sum(axis=1) if safe else (y.astype(object) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([frame.column("vec_id"), frame.column("x"), pa.array([v if v < 2**63 else None for v in own.tolist()], pa.int64()), pa.array([str(v) for v in own.tolist()])], names=["vec_id", "x", "deviation", "exact"])

    rows = keep(rows.mapInArrow(deviations, "vec_id long, x array<long>, deviation long, exact string"), "deviations")
    # Sums of deviations grow with the cube of n; high and low parts are summed apart, so that they are exact.
    exact = F.col("exact")
    part = lambda a, b: F.sum(F.coalesce(F.nullif(F.substring(F.lpad(exact, 60, "0"), a, b), F.lit("")), F.lit("0")).cast("decimal(38,0)"))
    highs = rows.agg(part(1, 30).alias("high"), part(31, 30).alias("low")).first()
    total = int(highs.high) * 10**30 + int(highs.low)
    trace = total / n**3
    if not total:
        return spark.createDataFrame([], _RESULT)
    values, vectors = block_lanczos(lambda q: product(rows, q, n, sums), d, trace, components)
    covariance = vectors.T @ product(rows, vectors, n, sums) / np.sqrt(np.outer(values, values))
    error = float(np.abs(covariance - np.eye(len(values))).max())
    project = spark.sparkContext.broadcast(vectors / np.sqrt(values))  # d times 8 doubles
    m, shares = len(values), values / trace

    def result(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame, x in _matrices(frames, d):
            for at in range(0, len(x), 4096):
                own = frame.slice(at, 4096)
                w = _centred(x[at : at + 4096], n, sums) @ project.value
                k = len(w)
                each = np.repeat(np.arange(k), m)
                yield pa.RecordBatch.from_arrays(
                    [own.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)), pa.array(np.full(k * m, n, dtype=np.int64)), own.column("deviation").take(pa.array(each)), pa.array(w.ravel()), pa.array(np.tile(shares, k)), pa.array(np.full(k * m, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("vec_id", "x", "deviation").mapInArrow(result, _RESULT)
