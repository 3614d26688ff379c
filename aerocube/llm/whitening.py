"""Whitening of embeddings by shifted CholeskyQR.

The centred matrix Y of the distinct vectors stays spread over tasks. A pass solves its rows against the triangular factors
found so far and sums the small Gram matrix of the result; the Gram matrix's Cholesky factor is the next triangular factor. The
first one is shifted, so that it exists however ill-conditioned Y is; two or three passes make the rows orthonormal. Then
Y = Q R with the composed R, and the SVD of R has the components and eigenvalues of Y's covariance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import work_table
from .vectors import longest, matrix, whole

#: Passes at most; the rounding unit.
PASSES, UNIT = 6, np.finfo(float).eps / 2


class Whitening(NamedTuple):
    """n distinct vectors with the sums of their components; components as columns, by falling eigenvalue."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None


def _total(rows: DataFrame, dims: int, size: int, kind: str, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows (x) of `size` numbers that `of` makes of a batch: each task sums its own, Spark the tasks'."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, "int64" if kind == "long" else float)
        for batch in batches:
            total += of(matrix(batch.column(0), dims)).ravel()
        yield pa.record_batch([pa.array(np.arange(size, dtype="int32")), pa.array(total)], ["slot", "value"])

    found = np.zeros(size, "int64" if kind == "long" else float)
    got = rows.select("x").mapInArrow(work, f"slot int, value {kind}").groupBy("slot").agg(F.sum("value").alias("value"))
    for slot, value in got.collect():  # as many as numbers
        found[slot] = value
    return found


def _differences(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: as Python's integers where 64 bits might not hold it or what it is multiplied with."""
    most = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if most**2 * max(x.shape[1], 1) < 2**63:
        return n * x - sums
    return n * x.astype(object) - sums.astype(object)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_differences(x, n, sums) / n).astype(float)


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows times the inverses of upper triangular factors, one after the other, by substitution."""
    for r in factors:
        out = np.empty_like(rows)
        for k in range(len(r)):
            out[:, k] = (rows[:, k] - out[:, :k] @ r[:k, k]) / r[k, k]
        rows = out
    return rows


def fit(vectors: DataFrame, x: str) -> Whitening | None:
    """The whitening of the distinct vectors x (array<long>, none null); None without rows.

    Shorter vectors count as zero beyond their end. Components with an eigenvalue of 0 are there, with exactly 0."""
    distinct = work_table(vectors.select(F.col(x).alias("x")).distinct())
    n, dims = distinct.count(), longest(distinct, "x")
    if not n:
        return None
    sums = _total(distinct, dims, dims, "long", lambda m: m.sum(0))
    factors: list[np.ndarray] = []
    off = np.inf
    while True:
        def gram(m: np.ndarray, known=tuple(factors)) -> np.ndarray:
            q = _solved(_centred(m, n, sums), known)
            return q.T @ q

        g = _total(distinct, dims, dims * dims, "double", gram).reshape(dims, dims)
        g = (g + g.T) / 2
        trace = trace if factors else float(np.trace(g)) / n
        # orthonormal, or zero in the directions that Y doesn't have
        was, off = off, np.abs(g @ g - g).max(initial=0) if factors else np.inf
        if not g.any() or off <= 16 * UNIT or (off <= 1e-12 and off > was / 4) or len(factors) == PASSES:
            break
        shift = 11 * (n * dims + dims * (dims + 1)) * UNIT * np.linalg.norm(g, 2) * np.eye(dims)
        try:
            lower = np.linalg.cholesky(g if factors else g + shift)
        except np.linalg.LinAlgError:
            lower = np.linalg.cholesky(g + shift)
        factors.append(lower.T)
    r = np.linalg.multi_dot([*factors[::-1], np.eye(dims)]) if factors else np.zeros((dims, dims))
    w, v = np.linalg.eigh(g)  # what little the last Gram matrix differs from the identity is part of R
    _, s, axes = np.linalg.svd(np.sqrt(np.maximum(w, 0))[:, None] * (v.T @ r)) if dims else (None, np.zeros(0), np.zeros((0, 0)))
    s = np.where(s > dims * 2 * UNIT * s.max(initial=0), s, 0)
    return Whitening(n, sums, axes.T, s**2 / n, trace, None)._replace(identity_error=_identity_error(distinct, n, sums, axes.T, s**2 / n))


def _whitened(x: np.ndarray, n: int, sums: np.ndarray, components: np.ndarray, eigenvalues: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return _centred(x, n, sums) @ components / np.sqrt(eigenvalues)


def _identity_error(distinct: DataFrame, n: int, sums: np.ndarray, components: np.ndarray, eigenvalues: np.ndarray, most: int = 4) -> float | None:
    """The largest entry of the covariance of the first whitened components, measured over all vectors, minus the identity."""
    k = min(most, int((eigenvalues > 0).sum()))
    if not k:
        return None
    of = lambda m: _whitened(m, n, sums, components[:, :k], eigenvalues[:k])
    dims = len(components)
    mean = _total(distinct, dims, k, "double", lambda m: of(m).sum(0)) / n

    def products(m: np.ndarray) -> np.ndarray:
        z = of(m) - mean
        return z.T @ z

    return float(np.abs(_total(distinct, dims, k * k, "double", products).reshape(k, k) / n - np.eye(k)).max())


def whiten(df: DataFrame, id_: str, vector: str, most: int = 4) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each row of df and each of the first `most`
    components, or as many as there are dimensions.

    Vectors are taken as whole numbers (vectors.whole); rows whose vector is null or has a null or non-finite component are
    left out. Equal vectors count once in the fit; repeated rows and ids, and null ids, stay, each with its result. Shorter vectors
    (empty ones too) count as zero beyond their end. Equal eigenvalues have components in no certain order. A component with
    an eigenvalue of 0 has a null `whitened` and explains 0, null if all are 0. A deviation that a long can't hold is null. An
    empty table gives no rows; other columns, of any name, don't matter. Vectors are never collected: to the driver come
    sums and Gram matrices, so the number of dimensions should be some thousand at most.
    """
    rows = df.select(F.col(id_).alias("id"), whole(F.col(vector)).alias("x")).filter("x is not null")
    schema = f"id {df.schema[id_].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, "x")
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_)
    n, sums, error = model.n, model.sums, model.identity_error
    k = min(most, len(sums))
    components, eigenvalues = model.components[:, :k], model.eigenvalues[:k]
    explained = eigenvalues / model.trace if model.trace else np.full(k, np.nan)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), len(sums))
            squares = (_differences(x, n, sums) ** 2).sum(1)
            deviation = pa.array([d if d < 2**63 else None for d in squares.tolist()], pa.int64())
            whitened = _whitened(x, n, sums, components, eigenvalues)
            whitened[:, eigenvalues == 0] = np.nan
            each = np.repeat(np.arange(len(x)), k)
            yield pa.record_batch({
                "id": batch.column("id").take(pa.array(each)), "component": pa.array(np.tile(np.arange(1, k + 1, dtype="int32"), len(x))), "n": pa.array(np.full(len(each), n)), "deviation": deviation.take(pa.array(each)),
                "whitened": pa.array(whitened.ravel(), from_pandas=True), "explained": pa.array(np.tile(explained, len(x)), from_pandas=True), "identity_error": pa.array([error] * len(each), pa.float64()),
            })

    return rows.mapInArrow(work, schema).withColumnRenamed("id", id_)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
