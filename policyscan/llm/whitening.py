"""Whitening of embeddings by shifted CholeskyQR of their centred rows.

Entries become integers, x = floor(1024 c) + 100000, so counts and sums are exact and a
centred entry, (n x - S) / n, is rounded once.  With A the centred rows, a pass computes
the Gram matrix of the rows, its Cholesky factor R and from the next pass on uses the rows
of A R^-1 (triangular solves) in place of those of A.  The first factor is taken of the Gram
matrix plus a small multiple of the identity (the shift), so that it exists for any
condition number; later passes make the rows orthogonal to double precision.  The composed
factor R has A's singular values and right singular vectors: its SVD gives the eigenvalues
sigma^2 / n and the components of the covariance, which is never formed and whose
condition number, the square of A's, never loses digits.

Every pass is one narrow read of the vectors that returns one d x d matrix per task.  The
matrices are summed as a tree of tasks with ``FAN_IN`` inputs each, in blocks of rows of at
most ``BLOCK_BYTES``, so what one task adds up is bounded and the driver sees one matrix.
Rows are never stored in another form.  Factors (d x d, d the length of a vector) are on the
driver, as the method has it.

Defined results
    vector null, or with a null or non-finite entry: left out
    entry of 2^40 or more in size: left out like a non-finite one (sums would not be exact)
    vectors of several lengths: the most frequent length is whitened (of ties the greater),
        other rows are left out
    no vectors, or vectors without entries: no rows
    directions without variance: no component (equal vectors: no rows)
    equal eigenvalues: any orthogonal components of their space, the same for all rows
    deviation beyond a long: null
    null vec_id, repeated rows: a vector of its own each
    extra input columns: not read
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

from policyscan.session import stage

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
FAN_IN = 64
BLOCK_BYTES = 1 << 18
MAX_PASSES = 6
ORTHOGONAL = 1e-6  # Gram matrix this near to the identity: its factor is the last one needed
_MOST = float(1 << 40)
_CHUNK_ROWS = 4096
_EPS = np.finfo(np.float64).eps


def vectors_of(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``column`` that are whole vectors of ``length`` entries, and their integers."""
    rows = np.flatnonzero(pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False) == length)
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    values = np.asarray(values, np.float64).reshape(len(rows), length)
    with np.errstate(invalid="ignore"):
        whole = (np.abs(values) < _MOST).all(axis=1)  # false for what is not a number
    return rows[whole], np.floor(values[whole] * SCALE).astype(np.int64) + OFFSET


def solve(rows: np.ndarray, factor: np.ndarray, block: int = 32) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular ``factor``, by substitution."""
    out = np.empty_like(rows)
    for begin in range(0, rows.shape[1], block):
        end = min(begin + block, rows.shape[1])
        part = rows[:, begin:end] - out[:, :begin] @ factor[:begin, begin:end]
        for j in range(begin, end):
            column = part[:, j - begin] - out[:, begin:j] @ factor[begin:j, j]
            out[:, j] = column / factor[j, j]
    return out


@dataclass
class Centre:
    """Number and sums of the vectors."""

    n: int
    sums: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x * self.n - self.sums) / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Exact sum of (n x - S)^2; null where it does not fit a long."""
        apart = x * self.n - self.sums
        wide = np.square(apart.astype(np.float64)).sum(axis=1) > 9.2e18
        return pa.array(np.square(apart).sum(axis=1), pa.int64(), mask=wide)


def _read(df: DataFrame, vec_col: str) -> DataFrame:
    return df.select(F.col(f"`{vec_col}`").cast("array<double>").alias("vector"))


def centre(df: DataFrame, vec_col: str = "embedding") -> Centre:
    """Count and exact sums of the whole vectors of the most frequent length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, _CHUNK_ROWS):
                column = batch.column(0).slice(begin, _CHUNK_ROWS)
                for length in pc.unique(pc.list_value_length(column).drop_null()).to_pylist():
                    _, x = vectors_of(column, length)
                    if len(x):
                        known = found.setdefault(length, [0, np.zeros(length, np.int64)])
                        known[0] += len(x)
                        known[1] += x.sum(axis=0)
        for length, (n, sums) in found.items():
            yield pa.RecordBatch.from_pydict({"length": [length], "n": [n], "sums": [sums]}, schema=arrow)

    arrow = pa.schema([("length", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
    parts = stage(_read(df, vec_col).mapInArrow(run, "length long, n long, sums array<long>"), "vector-sums")
    counts = parts.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if counts is None or not counts["length"]:
        return Centre(0, np.zeros(0, np.int64))
    entries = parts.filter(F.col("length") == counts["length"]).select(F.posexplode("sums").alias("j", "s"))
    sums = entries.groupBy("j").agg(F.sum("s").alias("s")).orderBy("j").collect()  # one row per dimension
    return Centre(counts["n"], np.array([r["s"] for r in sums], np.int64))


_PARTS = pa.schema([("part", pa.int64()), ("block", pa.int32()), ("matrix", pa.binary())])
_PARTS_DDL = "part long, block int, matrix binary"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for part, block, matrix in zip(*(batch.column(i) for i in range(3)), strict=True):
            key, values = (part.as_py(), block.as_py()), np.frombuffer(matrix.as_buffer(), np.float64)
            if key in sums:
                sums[key] += values
            else:
                sums[key] = values.copy()
    for (part, block), values in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([block], pa.int32()), pa.array([values.tobytes()], pa.binary())],
            schema=_PARTS,
        )


def _tree_sum(parts: DataFrame, n_parts: int) -> DataFrame:
    """``parts`` of equal ``block`` added up, ``FAN_IN`` at a time."""
    while n_parts > 1:
        n_parts = -(-n_parts // FAN_IN)
        grouped = parts.select(F.expr(f"part div {FAN_IN}L").alias("part"), "block", "matrix")
        parts = grouped.repartition("part", "block").mapInArrow(_added, _PARTS_DDL)
    return parts


def gram(df: DataFrame, vec_col: str, mid: Centre, turn: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all vectors of q q^T, where ``turn`` makes rows q (of ``width``) of centred rows."""
    length = len(mid.sums)
    step = max(1, BLOCK_BYTES // (8 * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for begin in range(0, batch.num_rows, _CHUNK_ROWS):
                _, x = vectors_of(batch.column(0).slice(begin, _CHUNK_ROWS), length)
                q = turn(mid.centred(x))
                total += q.T @ q
        part = TaskContext.get().partitionId()
        for block, begin in enumerate(range(0, width, step)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([block], pa.int32()),
                 pa.array([total[begin : begin + step].tobytes()], pa.binary())],
                schema=_PARTS,
            )

    parts = stage(_read(df, vec_col).mapInArrow(run, _PARTS_DDL), "gram-parts")
    n_parts = (parts.agg(F.max("part")).first()[0] or 0) + 1
    rows = _tree_sum(parts, n_parts).collect()  # one matrix, in blocks of rows
    out = np.zeros((width, width))
    for row in rows:
        values = np.frombuffer(bytes(row["matrix"]), np.float64).reshape(-1, width)
        out[row["block"] * step : row["block"] * step + len(values)] += values
    return out


def triangular(gram_matrix: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with R^T R the matrix; plus the shift if asked for or needed."""
    d = len(gram_matrix)
    shift = 11 * d * (d + 1 + np.sqrt(n)) * _EPS * np.trace(gram_matrix)
    if not shifted:
        try:
            return np.linalg.cholesky(gram_matrix).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram_matrix + shift * np.eye(d)).T


def orthogonalised(df: DataFrame, vec_col: str, mid: Centre) -> tuple[np.ndarray, float]:
    """Matrix M with M^T M = A^T A to double precision (the composed R), and the trace of A^T A."""
    d = len(mid.sums)
    factors: list[np.ndarray] = []
    trace = 0.0
    while True:
        done = list(factors)

        def turn(rows: np.ndarray) -> np.ndarray:
            for factor in done:
                rows = solve(rows, factor)
            return rows

        g = gram(df, vec_col, mid, turn, d)
        if not factors:
            trace = float(np.trace(g))
            if trace == 0:
                return np.zeros((d, d)), 0.0
        apart = np.abs(g - np.eye(d)).max()
        last = bool(factors) and apart < ORTHOGONAL
        if not last and len(factors) + 1 >= MAX_PASSES:
            # Directions without variance never become orthogonal: the root of the Gram
            # matrix stands for its factor.
            values, vectors = np.linalg.eigh(g)
            composed = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
            break
        factor = triangular(g, mid.n, shifted=not factors)
        if last:
            composed = factor
            break
        factors.append(factor)
    for factor in reversed(factors):
        composed = composed @ factor
    return composed, trace


@dataclass
class Whitening:
    """What whitens a centred row: ``components`` (rows, unit), their eigenvalues, the covariance's trace."""

    mid: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def rows(self, centred: np.ndarray) -> np.ndarray:
        return (centred @ self.components.T) / np.sqrt(self.eigenvalues)


def fit(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Leading components of the covariance (divisor n) of all whole vectors."""
    mid = centre(df, vec_col)
    if not mid.n:
        return Whitening(mid, np.zeros((0, 0)), np.zeros(0), 0.0)
    composed, trace = orthogonalised(df, vec_col, mid)
    _, singular, right = np.linalg.svd(composed)
    held = singular > singular[0] * len(singular) * 16 * _EPS if trace else np.zeros(len(singular), bool)
    k = min(components, int(held.sum()))
    right, singular = right[:k], singular[:k]
    signs = np.sign(right[np.arange(k), np.abs(right).argmax(axis=1)])
    return Whitening(mid, right * signs[:, None], np.square(singular) / mid.n, trace / mid.n)


def identity_error(df: DataFrame, vec_col: str, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity; their mean is zero as they are centred."""
    k = len(model.eigenvalues)
    covariance = gram(df, vec_col, model.mid, model.rows, k) / model.mid.n
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per whole vector and component.

    Columns: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.
    """
    model = fit(df, vec_col, components)
    k, length = len(model.eigenvalues), len(model.mid.sums)
    error = identity_error(df, vec_col, model) if k else 0.0
    explained = model.eigenvalues / model.trace if k else model.eigenvalues

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows if k else 0, _CHUNK_ROWS):
                ids, column = (batch.column(i).slice(begin, _CHUNK_ROWS) for i in range(2))
                rows, x = vectors_of(column, length)
                repeated = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)).take(repeated),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(rows) * k, model.mid.n, np.int64)),
                        model.mid.deviation(x).take(repeated),
                        pa.array(model.rows(model.mid.centred(x)).ravel()),
                        pa.array(np.tile(explained, len(rows))),
                        pa.array(np.full(len(rows) * k, error)),
                    ],
                    names=schema.names,
                )

    schema = StructType().add("vec_id", df.select(F.col(f"`{id_col}`")).schema[0].dataType)
    for name, kind in (("component", IntegerType()), ("n", LongType()), ("deviation", LongType()),
                       ("whitened", DoubleType()), ("explained", DoubleType()), ("identity_error", DoubleType())):
        schema = schema.add(name, kind)
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, schema)
