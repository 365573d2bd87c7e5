"""Whitening of embeddings by matrix-free block subspace iteration.

Entries c become whole numbers x = floor(256 c), and every different x-vector
counts once. The top eigenvectors of the covariance V of that list are found
without forming V: a Spark pass centres the rows of a task, multiplies them by a
block Q of ``BLOCK`` columns and back, and sums X'(XQ) over the tasks. The block
is made orthonormal by QR and joins the blocks of earlier passes, Rayleigh-Ritz
over this subspace gives approximate components, and their residuals
V q - e q become the next block. Once a subspace holds ``BLOCKS`` blocks it starts
anew from its best vectors. The iteration ends when the residual of each of the
k components certifies it: the angle to the true eigenvector is at most the
residual over the gap to the nearest other eigenvalue.

Only sums over rows reach the driver: d numbers once, d x BLOCK a pass.

Defined results: rows whose vector is null, or has null, infinite or undefined
entries, or one whose x is no 64-bit whole number, are left out, and so are vectors
of another length than the most frequent among the different ones (ties: the
longer). Repeated vectors get equal values; a null id stays null. A component
without variance (all vectors equal, or fewer different ones than components)
has whitened 0 and explained 0 and takes no part in identity_error. A deviation beyond 64 bits is
null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm.arrow_text import release
from gleanmill.session import ensure_checkpoint_dir, table

COMPONENTS = 4
#: Columns of the block that one pass multiplies.
BLOCK = 16
#: Blocks of a subspace before it starts anew.
BLOCKS = 12
#: Largest angle of a component to the true eigenvector.
ANGLE = 1e-10
#: Residuals under this share of the largest eigenvalue are rounding.
ROUNDING = 2e-14
PASSES = 2000
#: Rows that a task works on at a time.
ROWS = 4096
SCALE = 256.0
_LIMIT = 2.0**63


@dataclass(frozen=True)
class Moments:
    """Exact sums over the different vectors."""

    n: int
    sums: tuple[int, ...]
    squares: tuple[int, ...]

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def trace(self) -> float:
        """Trace of the covariance."""
        return sum(self.n * q - s * s for s, q in zip(self.sums, self.squares, strict=True)) / self.n**2


@dataclass(frozen=True)
class Components:
    """Columns of ``vectors`` are unit eigenvectors by falling eigenvalue."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    passes: int


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, size, x): x as little-endian whole numbers of 2, 4 or 8 bytes, the least that hold the vector."""
    for batch in _rows(batches):
        ids, lists = batch.column(0), batch.column(1)
        sizes = np.nan_to_num(np.asarray(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False), float)).astype(np.int64)
        numbers = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), float)  # null entries become NaN
        ends = np.concatenate([[0], np.cumsum(sizes)])
        with np.errstate(invalid="ignore", over="ignore"):
            whole = np.floor(SCALE * numbers)
        fits = np.isfinite(whole) & (whole >= -_LIMIT) & (whole < _LIMIT)
        wrong = np.concatenate([[0], np.cumsum(~fits)])
        good = np.asarray(lists.is_valid().to_numpy(zero_copy_only=False), bool) & (wrong[ends[1:]] == wrong[ends[:-1]])
        x = np.where(fits, whole, 0).astype("<i8")
        made = []
        for i in np.flatnonzero(good).tolist():
            row = x[ends[i] : ends[i + 1]]
            low, high = (int(row.min()), int(row.max())) if len(row) else (0, 0)
            kind = "<i2" if low >= -(1 << 15) and high < 1 << 15 else "<i4" if low >= -(1 << 31) and high < 1 << 31 else "<i8"
            made.append(row.astype(kind).tobytes())
        yield pa.RecordBatch.from_arrays([ids.filter(pa.array(good)), pa.array(sizes[good].astype(np.int32)), pa.array(made, pa.binary())], ["vec_id", "size", "x"])


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    """Whole numbers, a row for each vector."""
    out = np.zeros((len(column), d), np.int64)
    for i, raw in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(raw, f"<i{len(raw) // d}")
    return out


def packed(vectors: DataFrame) -> DataFrame:
    """vec_id, size, x of all rows that can be used."""
    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return chosen.mapInArrow(_pack, "vec_id long, size int, x binary")


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, int]:
    """Each different vector of the most frequent length once, checkpointed, and that length (0: no vector has entries)."""
    once = rows.filter("size > 0").select("size", "x").distinct().checkpoint()
    top = once.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if top is None:
        return once.select("x"), 0
    return once.filter(F.col("size") == top["size"]).select("x"), top["size"]


def _summed(fit: DataFrame, each: Callable[[np.ndarray], np.ndarray], d: int, length: int) -> np.ndarray:
    """Sum over all rows of each(rows), which has ``length`` numbers; a task sends one row for each number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(length), False
        for batch in _rows(batches):
            if batch.num_rows:
                total += each(_unpacked(batch.column(0), d))
                some = True
        release()
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(total)], ["at", "v"])

    out = np.zeros(length)
    for r in fit.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():  # one row for each number
        out[r["at"]] = r["v"]
    return out


def moments(fit: DataFrame, d: int) -> Moments:
    """Exact number, sums and sums of squares by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, [0] * d, [0] * d
        for batch in _rows(batches):
            if not batch.num_rows:
                continue
            x = _unpacked(batch.column(0), d)
            if int(np.abs(x).max()) >= 1 << 24 or x.min() == np.iinfo(np.int64).min:  # squares of a batch could leave 64 bits
                x = x.astype(object)
            n += len(x)
            s = [a + int(b) for a, b in zip(s, x.sum(0), strict=True)]
            q = [a + int(b) for a, b in zip(q, (x * x).sum(0), strict=True)]
        if n:
            # Squares move as two parts of at most 38 digits.
            parts = [[Decimal(v) for v in s], [Decimal(v >> 64) for v in q], [Decimal(v & (2**64 - 1)) for v in q]]
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int64()), *[pa.array(p, pa.decimal128(38, 0)) for p in parts], pa.array([n] * d, pa.int64())], ["at", "s", "high", "low", "n"])

    rows = fit.mapInArrow(run, "at long, s decimal(38,0), high decimal(38,0), low decimal(38,0), n long")
    found = {r["at"]: r for r in rows.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("s", "high", "low", "n")]).collect()}  # d rows
    return Moments(int(found[0]["n"]), tuple(int(found[i]["s"]) for i in range(d)), tuple((int(found[i]["high"]) << 64) + int(found[i]["low"]) for i in range(d)))


def product(fit: DataFrame, mean: np.ndarray, n: int, q: np.ndarray) -> np.ndarray:
    """V q in one pass over the rows: they are centred, multiplied by the block and back."""
    d, p = q.shape
    shipped = fit.sparkSession.sparkContext.broadcast((mean, q))

    def each(x: np.ndarray) -> np.ndarray:
        centre, block = shipped.value
        rows = x - centre
        return (rows.T @ (rows @ block)).ravel()

    out = _summed(fit, each, d, d * p).reshape(d, p) / n
    shipped.destroy()
    return out


def _orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The part of the block outside the basis, as orthonormal columns; directions that the basis holds already go."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    if not block.size:
        return block
    # What is left of a column must stand out from rounding.
    kept: list[np.ndarray] = []
    for column in block.T:
        v = column
        for _ in range(2):
            for k in kept:
                v = v - k * (k @ v)
            v = v - basis @ (basis.T @ v)
        if (length := np.linalg.norm(v)) > 1e-10:
            kept.append(v / length)
    return np.linalg.qr(np.array(kept).T)[0] if kept else np.zeros((len(block), 0))


def subspace(multiply: Callable[[np.ndarray], np.ndarray], d: int, k: int, block: int = BLOCK, blocks: int = BLOCKS) -> Components:
    """The top k eigenpairs of a symmetric matrix of which only products with blocks are known."""
    k, block = min(k, d), min(block, d)
    limit = max(block * blocks, 2 * (k + block))
    fresh = np.linalg.qr(np.random.default_rng(7).standard_normal((d, block)))[0]
    basis, image = np.zeros((d, 0)), np.zeros((d, 0))
    for done in range(1, PASSES + 1):
        basis, image = np.hstack([basis, fresh]), np.hstack([image, multiply(fresh)])
        projected = basis.T @ image
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, moved = basis @ turn, image @ turn
        rest = moved - ritz * values
        norms = np.linalg.norm(rest, axis=0)
        top = max(abs(values[0]), np.finfo(float).tiny)
        near = np.array([np.abs(np.delete(values, i) - values[i]).min(initial=np.inf) for i in range(min(k, len(values)))])
        told = len(values) >= k and all(norms[i] <= max(ANGLE * near[i] if np.isfinite(near[i]) else 0, ROUNDING * top * np.sqrt(d)) for i in range(k))
        wanted = rest[:, : max(block, k)]
        fresh = _orthonormal(wanted, basis) if basis.shape[1] < d else np.zeros((d, 0))
        if told or not fresh.shape[1]:  # a subspace without anything outside holds the eigenvectors to rounding
            vectors = ritz[:, :k]
            signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
            return Components(np.maximum(values[:k], 0), vectors * np.where(signs == 0, 1, signs), norms[:k], done)
        if basis.shape[1] + fresh.shape[1] > limit:
            basis, image = ritz[:, : limit // 2], moved[:, : limit // 2]
    raise RuntimeError(f"no certificate after {PASSES} passes: residuals {norms[:k]}")


def fitted(fit: DataFrame, d: int, k: int = COMPONENTS) -> tuple[Moments, Components]:
    """Moments and certified components of the different vectors."""
    told = moments(fit, d)
    mean = told.mean()
    return told, subspace(lambda q: product(fit, mean, told.n, q), d, k)


def _scales(found: Components) -> np.ndarray:
    """Columns that whiten: eigenvectors over the root of their eigenvalue, zero where there is no variance."""
    least = found.values[0] * len(found.vectors) * np.finfo(float).eps if len(found.values) else 0.0
    some = found.values > max(least, 0)
    return np.where(some, found.vectors / np.sqrt(np.where(some, found.values, 1)), 0.0)


def identity_error(fit: DataFrame, told: Moments, scales: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    d, k = scales.shape
    mean = told.mean()

    def each(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ scales
        return np.concatenate([(w.T @ w).ravel(), w.sum(0)])

    out = _summed(fit, each, d, k * k + k) / told.n
    centre = out[k * k :]
    some = np.abs(scales).max(0) > 0
    error = np.abs(out[: k * k].reshape(k, k) - np.outer(centre, centre) - np.eye(k))[np.ix_(some, some)]
    return float(error.max(initial=0.0))


def _deviations(x: np.ndarray, told: Moments) -> list[int | None]:
    """Exact sum over the dimensions of (n x - S)^2; null beyond 64 bits."""
    d = x.shape[1]
    largest = told.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, told.sums))
    kind = np.int64 if d * largest**2 < 1 << 63 else object
    apart = told.n * x.astype(kind) - np.array(told.sums, kind)
    return [v if v < 1 << 63 else None for v in map(int, (apart * apart).sum(1))]


def whitened(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable vector and component."""
    ensure_checkpoint_dir(vectors.sparkSession)
    rows = packed(vectors)
    fit, d = distinct_vectors(rows)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not d:
        return vectors.sparkSession.createDataFrame([], schema)
    told, found = fitted(fit, d, k)
    scales = _scales(found)
    error, trace = identity_error(fit, told, scales), told.trace()
    k, mean = len(found.values), told.mean()
    share = found.values * (np.abs(scales).max(0) > 0) / trace if trace else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches):
            if batch.num_rows:
                x = _unpacked(batch.column(1), d)
                n = len(x)
                values = ((x - mean) @ scales).ravel()
                at = pa.array(np.repeat(np.arange(n), k))
                exact = pa.array(_deviations(x, told), pa.int64()).take(at)
                numbers = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n))
                columns = [batch.column(0).take(at), numbers, pa.array(np.full(n * k, told.n)), exact, pa.array(values), pa.array(np.tile(share, n)), pa.array(np.full(n * k, error))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
        release()

    return rows.filter(F.col("size") == d).select("vec_id", "x").mapInArrow(run, schema)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    return whitened(table(spark, sf_dir, "embeddings"))
