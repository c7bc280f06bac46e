"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never gathered. A step multiplies X by the newest right vector and the result by X', in one
job that sends back one vector per task, summed by Spark. Left vectors are as long as the table, so they aren't kept: a
task recomputes those of its rows from the right vectors and the coefficients so far, by the same
operations in the same order. Both sides are reorthogonalised in full: the left ones by the
coefficients that X' has given for the earlier ones, and once more by measured products; the right ones on the driver.
The singular values of the small bidiagonal matrix are the deviations, its right singular vectors
turn the right vectors into the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Entries become long(floor(SCALE * entry)) + SHIFT.
SCALE = 1024
SHIFT = 100_000
#: Entries from here on can't be told from infinite ones: their sums over a batch would leave 64 bits.
LARGEST = 2.0**36
#: Up to this many dimensions all steps are taken, so that equal eigenvalues are all found; beyond, they end when the
#: leading triplets have converged to rounding.
ALL_STEPS = 256
#: Relative size below which a coefficient is rounding.
TINY = 1e-13


@dataclass(frozen=True)
class Whitening:
    """n vectors with the exact sums per dimension; components as columns, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def integer_vectors(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key and x (array of long) of the rows that can be fitted, written to the shared folder.

    A null vector, or one that holds a null, NaN, infinite or (in magnitude) LARGEST or larger entry, is dropped, so is
    one whose length is not the commonest positive length (of equally common ones the largest). Repeated
    rows and null keys stay.
    """
    entry = F.col("_v")
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    usable = vectors.select(F.col(key).alias("vec_id"), F.col(column).cast("array<double>").alias("_v")).filter(
        entry.isNotNull() & (F.size(entry) > 0) & ~bad
    )
    x = F.transform(entry, lambda c: F.floor(c * SCALE) + SHIFT)
    found = written(usable.select("vec_id", x.alias("x")))
    length = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found.filter(F.size("x") == (length["d"] if length else 0))


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _reduced(x: DataFrame, task: Callable[[Iterator[np.ndarray]], np.ndarray], d: int) -> np.ndarray:
    """The sum over all tasks of the vector that `task` makes of the blocks of its partition."""

    def run(batches):
        values = task(_blocks(batches, d))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int64()), pa.array(values, pa.float64())], ["at", "value"])

    summed = x.select("x").mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    found = {r["at"]: r["value"] for r in summed.collect()}
    return np.array([found[i] for i in range(len(found))])


def _sums(x: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and exact sums per dimension."""

    def run(batches):
        n, total = 0, np.zeros(d, dtype=object)
        for block in _blocks(batches, d):
            for part in np.array_split(block, max(1, len(block) >> 15)):
                n, total = n + len(part), total + part.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int64()), pa.array([str(v) for v in (n, *total)])], ["at", "value"])

    parts = x.select("x").mapInArrow(run, "at long, value string")
    summed = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = {r["at"]: int(r["value"]) for r in summed.collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(d)]


def left_vectors(block: np.ndarray, right: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    """The rows' entries of the left vectors: what forward substitution makes of block @ right."""
    out = block @ right
    for i in range(out.shape[1]):
        size = coefficients[i, i]
        out[:, i] = (out[:, i] - out[:, :i] @ coefficients[:i, i]) / size if size else 0.0
    return out


def _step(blocks, mean, right, coefficients, newest, against) -> np.ndarray:
    """Of y = X newest - U against: its squared length, U'y and X'y."""
    j, d = len(against), len(mean)
    out = np.zeros(1 + j + d)
    for block in blocks:
        for part in np.array_split(block, max(1, len(block) >> 12)):
            rows = part - mean
            left = left_vectors(rows, right, coefficients)
            y = rows @ newest - left @ against
            out[0] += y @ y
            out[1 : 1 + j] += y @ left
            out[1 + j :] += y @ rows
    return out


def bidiagonalise(step: Callable[..., np.ndarray], d: int, scale: float, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (columns) and the upper bidiagonal matrix. `step(right, coefficients, newest, against)` is one pass
    over the rows, `scale` the Frobenius norm of X. A right vector without successor (an invariant
    subspace) is followed by a random orthogonal one."""
    random = np.random.default_rng(seed)
    right, turned = np.zeros((d, 0)), np.zeros((d, 0))  # V and X'U
    coefficients, band = np.zeros((0, 0)), np.zeros((d, d))

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v

    v = random.standard_normal(d)
    v /= np.linalg.norm(v)
    for j in range(d):
        against = turned.T @ v
        out = step(right, coefficients, v, against)
        again, z = out[1 : 1 + j], out[1 + j :]
        size = np.sqrt(max(out[0] - again @ again, 0.0))
        size = size if size > TINY * scale else 0.0
        w = (z - turned @ again) / size if size else np.zeros(d)
        grown = np.zeros((j + 1, j + 1))
        grown[:j, :j], grown[:j, j], grown[j, j] = coefficients, against + again, size
        coefficients, band[j, j] = grown, size
        right, turned = np.column_stack([right, v]), np.column_stack([turned, w])
        if j + 1 == d:
            break
        rest = orthogonal(w)
        length = np.linalg.norm(rest)
        if length > TINY * scale:
            band[j, j + 1], v = length, rest / length
        else:
            length, rest = 0.0, orthogonal(random.standard_normal(d))
            v = rest / np.linalg.norm(rest)
        if d > ALL_STEPS and j + 1 >= k and length:
            left, values, _ = np.linalg.svd(band[: j + 1, : j + 1])
            if (length * np.abs(left[-1, :k]) <= 1e-15 * values[0]).all():
                break
    m = right.shape[1]
    return right, band[:m, :m]


def fit(x: DataFrame, k: int = 8, seed: int = 0) -> Whitening | None:
    """The leading `k` components of the covariance (divisor n) of the integer vectors; fewer if the vectors
    have fewer dimensions or vary in fewer. None without rows."""
    first = x.select(F.size("x")).first()
    if not first:
        return None
    d = first[0]
    n, sums = _sums(x, d)
    mean = np.array([s / n for s in sums])
    total = _reduced(x, lambda blocks: np.array([sum((((b - mean) ** 2).sum() for b in blocks), 0.0)]), d)[0]
    if not total:
        return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)

    def step(right, coefficients, newest, against):
        return _reduced(x, partial(_step, mean=mean, right=right, coefficients=coefficients, newest=newest, against=against), d)

    right, band = bidiagonalise(step, d, np.sqrt(total), k, seed)
    _, values, turn = np.linalg.svd(band)
    some = min(k, int((values > 1e-10 * values[0]).sum()))
    components = right @ turn[:some].T
    return Whitening(n, sums, components / np.linalg.norm(components, axis=0), values[:some] ** 2 / n, total / n)


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (x - model.mean) @ model.components / np.sqrt(model.eigenvalues)


def identity_error(x: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    k = len(model.eigenvalues)

    def task(blocks):
        out = np.zeros(k + k * k)
        for block in blocks:
            z = _projected(block, model)
            out[:k] += z.sum(axis=0)
            out[k:] += (z.T @ z).ravel()
        return out

    out = _reduced(x, task, len(model.sums)) / model.n
    return float(np.abs(out[k:].reshape(k, k) - np.outer(out[:k], out[:k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n * x - sum)^2 per row; None where it doesn't fit in 64 bits."""
    rough = np.abs(n * x.astype(float) - np.array(sums, dtype=float)).max(initial=0.0)
    if max(n * float(np.abs(x).max(initial=0)), abs(max(sums, key=abs, default=0)), rough * rough * max(1, len(sums))) < 2.0**61:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def transform(x: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained: a row per vector and component."""
    k, kind = len(model.eigenvalues), dict(x.dtypes)["vec_id"]
    if not k:
        return x.select("vec_id").limit(0).selectExpr(
            "vec_id", "0 as component", "0L as n", "0L as deviation", "0d as whitened", "0d as explained")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            rows = np.repeat(np.arange(batch.num_rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), batch.num_rows), pa.int32()),
                pa.array(np.full(len(rows), model.n), pa.int64()), pa.array(deviations(block, model.n, model.sums), pa.int64()).take(pa.array(rows)),
                pa.array(_projected(block, model).ravel(), pa.float64()),
                pa.array(np.tile(model.eigenvalues / model.trace, batch.num_rows), pa.float64()),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return x.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double")


def whiten(vectors: DataFrame, k: int = 8, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every vector that can be fitted.

    For what is dropped see `integer_vectors`. A table without variance (empty, one vector, equal vectors) has no
    component that could be scaled to unit variance, so it gives no row; so do directions beyond its rank. Other columns are
    not looked at. Equal eigenvalues come with any orthonormal vectors of their space.
    """
    x = integer_vectors(vectors, column, key)
    model = fit(x, k) or Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    error: Column = F.lit(identity_error(x, model) if len(model.eigenvalues) else 0.0)
    return transform(x, model).withColumn("identity_error", error)
