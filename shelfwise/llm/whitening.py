"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

A vector is turned into integers x = floor(scale * c) + shift, so that sums and deviations are exact. The fit list X is
every distinct x once, with its mean taken off; it lies in blocks in the shared folder. The bidiagonalisation starts from a
fixed v and alternates two products of every block: u = Xv, then X'u. Left and right vectors are both reorthogonalised in
full against all earlier ones: every u is X times a short vector that the driver keeps, so its products with the earlier u
come from X'u, and a correction beyond rounding is followed by another round of products. What goes to the
driver per round are one vector and two numbers per partition, whatever the rows.

The singular values of the small bidiagonal matrix, over the root of n, are the deviations along the components, its right
singular vectors times V are the components. If a u or v vanishes (the products span a space that X does not leave), another
chain goes on from a vector outside that space, unless no variance is left there. The rounds end when V spans all dimensions, or earlier when the residuals of the
wanted components are below 1e-14 of the largest singular value; then a vector orthogonal to V starts a further chain, and
only if the best it can reach is below the wanted values too is the result taken (two components of one eigenvalue need two
chains).

Nulls: rows with a null vector, a null or non-finite entry or no entries are dropped. Vectors of one length only can be compared:
that of most rows, the larger of equals; rows of other lengths are dropped. Null and repeated identifiers are kept, each with
its rows. Copies of a vector count once in the fit. Components with no variance (below 1e-16 of the largest) are left out, so equal vectors, one vector or an empty
table give no rows. A sum of squares that leaves 64 bits raises OverflowError, as its exact value can't be given. Other columns
are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import scratch

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
BLOCK_BYTES = 4 << 20
TASK_BYTES = 64 << 20
SEED = 7
_ROUNDING = 1e-14
#: A deviation below this share of the largest is rounding of the squares, which hold 16 digits.
_NOTHING = 1e-9


def integer_vectors(embeddings: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> tuple[DataFrame, int, int]:
    """(id, x) of the rows that can be used, the length of their vectors, and the number of rows."""
    c = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(c, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    rows = embeddings.select(F.col(f"`{id_col}`").alias("id"), c.alias("c")).filter(c.isNotNull() & (F.size(c) > 0) & finite)
    lengths = rows.groupBy(F.size("c").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d, n = lengths or (0, 0)
    x = F.transform("c", lambda v: F.floor(v * scale) + shift)
    return rows.filter(F.size("c") == d).select("id", x.alias("x")), d, n


def fit_blocks(spark, vectors: DataFrame, d: int, n_rows: int) -> DataFrame:
    """Blocks of distinct vectors, (block binary), in few enough partitions that a round is not all start-up."""
    per_block = max(1, BLOCK_BYTES // (8 * d))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            return pa.record_batch({"block": pa.array([np.concatenate(held).tobytes()], pa.binary())})

        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, d)
            for lo in range(0, len(x), per_block):
                held.append(x[lo : lo + per_block])
                size += len(held[-1])
                if size >= per_block:
                    yield block()
                    held, size = [], 0
        if size:
            yield block()

    tasks = max(spark.sparkContext.defaultParallelism, -(-8 * d * n_rows // TASK_BYTES))
    path = scratch(spark, "whitening-fit")
    vectors.select("x").distinct().coalesce(tasks).mapInArrow(pack, "block binary").write.parquet(path)
    # one file per task of the write; they are not cut or joined again by size
    return spark.read.parquet(path).coalesce(tasks)


def summed(blocks: DataFrame, d: int, part, width: int) -> np.ndarray:
    """Sum over all blocks of ``part(x)``, a float vector of ``width``; one vector per partition reaches the driver."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for raw in batch.column(0):
                total += part(np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, d))
        yield pa.record_batch({"part": pa.array([total.tobytes()], pa.binary())})

    return np.sum([np.zeros(width), *[np.frombuffer(r["part"]) for r in blocks.mapInArrow(partial, "part binary").collect()]], axis=0)


def exact_sums(blocks: DataFrame, d: int) -> tuple[int, list[int], int]:
    """Vectors, sums per dimension, largest absolute entry; integers."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, most, total = 0, 0, [0] * d
        for batch in batches:
            for raw in batch.column(0):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, d)
                n, most = n + len(x), max(most, int(x.max()), -int(x.min()))
                # halves of 32 bits: sums of a block stay exact whatever the entries
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high, low)]
        yield pa.record_batch({"part": pa.array([json.dumps([n, total, most])])})

    n, most, total = 0, 0, [0] * d
    for r in blocks.mapInArrow(partial, "part string").collect():
        k, sums, top = json.loads(r["part"])
        n, most, total = n + k, max(most, top), [a + b for a, b in zip(total, sums)]
    return n, total, most


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


@dataclass
class Whitening:
    """Mean (as n and integer sums), components (one per column), their deviations, total variance, identity error."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    deviations: np.ndarray
    total: float
    identity_error: float


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``v`` without its parts along ``basis``; twice is enough."""
    if basis:
        b = np.array(basis)
        for _ in range(2):
            v = v - b.T @ (b @ v)
    return v


def bidiagonalize(product, d: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (columns) and singular values of X, descending. ``product(w)`` is X'Xw and |Xw|^2, over the blocks."""
    rng = np.random.default_rng(SEED)
    right: list[np.ndarray] = []  # v_k
    short: list[np.ndarray | None] = []  # z_k with u_k = X z_k; None where u vanished
    pulled: list[np.ndarray] = []  # X'u_k
    small = np.zeros((d, d))  # u_i X v_k: bidiagonal within a chain
    starts: list[int] = []  # first vector of each chain
    ends: list[tuple[int, float]] = []  # last vector of each chain left before its end, with what it lacks
    norm = 0.0

    def fresh() -> np.ndarray | None:
        """First vector of a chain, outside ``right`` and inside the rows' space; none if no variance is left outside."""
        v = _orthogonal(rng.standard_normal(d), right)
        xtx, norm2 = product(v / np.linalg.norm(v))
        v = _orthogonal(xtx, right)
        if norm2 <= (_NOTHING * norm) ** 2 or np.linalg.norm(v) <= (_NOTHING * norm) ** 2:
            return None
        v = _orthogonal(v / np.linalg.norm(v), right)
        return v / np.linalg.norm(v)

    v, beta = fresh(), 0.0
    while v is not None:
        k = len(right)
        if beta == 0.0:
            starts.append(k)
        right.append(v)
        w = v.copy()
        if beta:
            small[k - 1, k] = beta
            w -= beta * short[-1]
        xtx, norm2 = product(w)
        for _ in range(2):
            along = [(i, float(z @ xtx)) for i, z in enumerate(short) if z is not None]  # u_i . Xw
            for i, c in along:
                small[i, k] += c
                w = w - c * short[i]
            size2 = sum(c * c for _, c in along)
            if size2 <= 1e-20 * norm2:
                for i, c in along:
                    xtx = xtx - c * pulled[i]
                norm2 -= size2
                break
            xtx, norm2 = product(w)
            if norm2 <= (_NOTHING * norm) ** 2:
                break
        alpha = float(np.sqrt(max(norm2, 0.0)))
        norm = max(norm, alpha, beta)
        if alpha <= _NOTHING * norm:
            short.append(None)
            pulled.append(np.zeros(d))
        else:
            small[k, k] = alpha
            short.append(w / alpha)
            pulled.append(xtx / alpha)
        rest = _orthogonal(pulled[-1], right)
        beta = float(np.linalg.norm(rest))
        k += 1
        if k == d:
            break
        if beta <= _ROUNDING * norm * d:
            v, beta = fresh(), 0.0
            continue
        left, values, _ = np.linalg.svd(small[:k, :k])
        # X'Xv - s^2 v of a triplet is s times what the ends of the chains lack, by its left vector's entries there
        lacks = sum(b * np.abs(left[i, :wanted]) for i, b in [*ends, (k - 1, beta)])
        if k > wanted and np.all(lacks <= _ROUNDING * values[0]):
            if len(starts) == 1:
                ends.append((k - 1, beta))
                v, beta = fresh(), 0.0
                continue
            # the last chain began outside the others; its best value is known, or is too small with all it lacks
            own_left, own, _ = np.linalg.svd(small[starts[-1] : k, starts[-1] : k])
            open_part = beta * abs(own_left[-1, 0])
            if open_part <= 1e-10 * values[0] or (len(own) >= 8 and own[0] + open_part < values[wanted - 1]):
                break
        v = _orthogonal(rest / beta, right)
        v /= np.linalg.norm(v)
    k = len(right)
    _, values, vt = np.linalg.svd(small[:k, :k])
    vectors = np.array(right).T @ vt.T
    keep = values > 10 * _NOTHING * values[0]
    return vectors[:, keep][:, :wanted], values[keep][:wanted]


def fit(blocks: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Whitening of the vectors in ``blocks`` (:func:`fit_blocks`)."""
    n, sums, most = exact_sums(blocks, d)
    if n == 0:
        return Whitening(0, np.zeros(d, np.int64), np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    if 2 * n * most >= 1 << 62:
        raise OverflowError("n * x leaves 64 bits")
    s = np.array(sums, np.int64)

    def product(w: np.ndarray) -> tuple[np.ndarray, float]:
        def part(x: np.ndarray) -> np.ndarray:
            x = centred(x, n, s)
            u = x @ w
            return np.append(x.T @ u, u @ u)

        out = summed(blocks, d, part, d + 1)
        return out[:-1], float(out[-1])

    total = summed(blocks, d, lambda x: np.array([np.square(centred(x, n, s)).sum()]), 1)[0] / n
    if total == 0.0:
        return Whitening(n, s, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    vectors, values = bidiagonalize(product, d, min(components, d))
    deviations = values / np.sqrt(n)
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, s) @ vectors / deviations
        return np.append((y.T @ y).ravel(), y.sum(axis=0))

    out = summed(blocks, d, moments, k * k + k)
    mean = out[k * k :] / n
    error = np.abs(out[: k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max()
    return Whitening(n, s, vectors, deviations, float(total), float(error))


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    vectors, d, n_rows = integer_vectors(embeddings, id_col, vec_col, scale, shift)
    id_type = embeddings.schema[id_col].dataType
    schema = f"`{id_col}` {id_type.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if n_rows == 0:
        return spark.createDataFrame([], schema)
    model = fit(fit_blocks(spark, vectors, d, n_rows), d, components)
    k = len(model.deviations)
    explained = np.square(model.deviations) / model.total if k else np.zeros(0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            off = model.n * x - model.sums
            if len(off) and float(np.abs(off).max()) ** 2 * d >= 2**62:
                raise OverflowError("the squared deviation leaves 64 bits")
            deviation = np.square(off).sum(axis=1)
            y = off / model.n @ model.components / model.deviations
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.record_batch(
                {
                    id_col: batch.column(0).take(pa.array(rows)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(rows), model.n, np.int64)),
                    "deviation": pa.array(deviation[rows]),
                    "whitened": pa.array(y.ravel()),
                    "explained": pa.array(np.tile(explained, len(x))),
                    "identity_error": pa.array(np.full(len(rows), model.identity_error)),
                }
            )

    return vectors.mapInArrow(project, schema)
