"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation: the rows are only ever multiplied by a vector, from both sides."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fisclake.llm.shared import stored

#: Entries become ``floor(SCALE * c) + SHIFT``.
SCALE, SHIFT = 64, 1_000_000
#: Rows multiplied at a time.
ROWS = 8192
#: A new direction shorter than this part of the longest counts as none: what is left of it is rounding.
NOTHING = 1e-13


@dataclass(frozen=True)
class Whitening:
    """``components[k]`` (unit vectors, by falling ``eigenvalues``) of ``n`` vectors whose entries add up to ``sums``; ``trace`` of their
    covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.eigenvalues)


def scaled(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", most: float = 1e9) -> DataFrame:
    """``id`` and ``x`` of the vectors that take part: not null or empty, and every entry there, finite and smaller than ``most``."""
    number = F.col(vector).cast("array<double>")
    sound = F.forall(number, lambda c: F.coalesce(F.abs(c) < most, F.lit(False)))  # neither null, NaN nor infinite
    x = F.transform(number, lambda c: F.floor(c * SCALE) + SHIFT)
    return embeddings.filter((F.size(number) > 0) & sound).select(F.col(id_column).alias("id"), x.cast("array<long>").alias("x"))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The vectors, ``ROWS`` at a time, as a matrix."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            yield part, part.column("x").flatten().to_numpy().reshape(part.num_rows, -1)


def summed(rows: DataFrame, values: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all blocks of what ``values`` gives for one: added up in each task, then in Spark, place by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in blocks(batches):
            own = values(x)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "value"])

    added = rows.select("x").mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum("value").alias("value")).collect()
    return np.array([value for _, value in sorted(added)])


def orthogonal(w: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """What of ``w`` is orthogonal to the unit vectors of ``basis``; done twice, as once leaves rounding behind."""
    for _ in range(2 if basis else 0):
        w = w - np.array(basis).T @ (np.array(basis) @ w)
    return w


def bidiagonalise(product: Callable[[np.ndarray], tuple[np.ndarray, float]], dim: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """``v`` (rows: orthonormal) and the upper bidiagonal ``b`` with ``X v.T = U b``, U orthonormal, in ``dim`` steps: complete.

    ``product(z)`` gives X.T (X z) and the squared length of X z. Each u is X z for a short z, so that the long vectors are never kept:
    their products with a new one are those of their z with X.T (X z). Both sides are made orthogonal to all before them in every step.
    Where a direction vanishes the next one starts anew, orthogonal to all there are: equal singular values cost no component.
    """
    rng = np.random.default_rng(seed)
    start = rng.standard_normal(dim)
    v, z, back = [start / np.linalg.norm(start)], [], []
    b = np.zeros((dim, dim))
    longest = 0.0
    for j in range(dim):
        # u: X v, orthogonal to the earlier u.
        short = v[j].copy()
        mapped, square = product(short)
        longest = max(longest, np.sqrt(square))
        if z:
            parts = np.array(z) @ mapped  # u_i . X v
            b[: len(z), j] = parts
            short = short - np.array(z).T @ parts
            mapped = mapped - np.array(back).T @ parts
            again = np.array(z) @ mapped
            b[: len(z), j] += again
            short, mapped = short - np.array(z).T @ again, mapped - np.array(back).T @ again
        alpha = np.sqrt(max(short @ mapped, 0.0))
        if alpha > NOTHING * longest:
            z.append(short / alpha)
            back.append(mapped / alpha)
        else:
            alpha = 0.0
            z.append(np.zeros(dim))
            back.append(np.zeros(dim))
        b[j, j] = alpha
        if j + 1 < dim:
            # v: X.T u, orthogonal to the earlier v.
            w = orthogonal(back[j], v)
            if np.linalg.norm(w) <= NOTHING * longest:
                w = orthogonal(rng.standard_normal(dim), v)
            v.append(w / np.linalg.norm(w))
    return np.array(v), b


def fit_whitening(rows: DataFrame, dim: int, components: int = 32) -> Whitening | None:
    """Whitening of the vectors ``x`` of ``rows``, all of length ``dim``; None without rows.

    One pass adds up the entries, each of ``dim`` more multiplies the centred rows by one vector from both sides. The driver holds
    matrices of ``dim`` x ``dim``. Directions without variance are no components.
    """
    totals = summed(rows, lambda x: np.r_[len(x), x.sum(axis=0)], "long")
    if not len(totals):
        return None
    n, sums = int(totals[0]), totals[1:].astype(np.int64)

    def product(z: np.ndarray) -> tuple[np.ndarray, float]:
        def both(x: np.ndarray) -> np.ndarray:
            c = (n * x - sums) / n
            p = c @ z
            return np.r_[p @ c, p @ p, (c * c).sum()]

        found = summed(rows, both, "double")
        traces.append(found[-1] / n)
        return found[:-2], found[-2]

    traces: list[float] = []
    v, b = bidiagonalise(product, dim)
    _, sigma, right = np.linalg.svd(b)
    order = np.flatnonzero(sigma > 1e-10 * sigma[0])[:components] if sigma[0] > 0 else []
    return Whitening(n, sums, right[order] @ v, sigma[order] ** 2 / n, traces[0])


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    k = len(model.components)

    def products(x: np.ndarray) -> np.ndarray:
        w = model.whiten(x)
        return np.r_[(w.T @ w).ravel(), w.sum(axis=0)]

    if not k:
        return 0.0
    total = summed(rows, products, "double") / model.n
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(total[k * k :], total[k * k :]) - np.eye(k)).max())


def squares(model: Whitening, x: np.ndarray) -> list[str]:
    """Sum of the squares of ``n * x - sums`` of each row, exact whatever its size."""
    off = model.n * x - model.sums
    if np.abs(off).max() ** 2 * float(x.shape[1]) < 2.0**62:
        return list(map(str, (off * off).sum(axis=1).tolist()))
    return [str(sum(v * v for v in row)) for row in off.tolist()]


def whiten_embeddings(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """For each vector that takes part: ``id_column``, ``n`` (vectors fitted on), ``deviation`` (exact; decimal), ``whitened`` (one number per
    component), ``explained`` (share of the variance of each component) and ``identity_error`` (one value).

    Fitted on all rows. Vectors that are null or empty or hold a null, a non-finite entry or one of 10**9 or more take no part and get no
    row. Vectors of another length are fitted by themselves: each length is a table of its own. Of fewer directions with variance than ``components`` (few or equal rows) only
    those are components: ``whitened`` is shorter, empty for equal rows. Repeated rows count and get results as often as they are there. No rows: no rows. Other columns,
    whatever their names, are not looked at. Equal eigenvalues: any orthonormal basis of their space, the same for all rows.

    The scaled rows are written once; every pass reads them where they are and sends on a vector per task, added up by Spark.
    """
    rows = stored(scaled(embeddings, id_column, vector), "whitening")
    kind = rows.schema["id"].dataType.simpleString()
    names = f"id {kind}, n long, deviation string, whitened array<double>, explained array<double>, identity_error double"
    result = rows.limit(0).mapInArrow(lambda batches: iter(()), names)
    for dim in sorted(r[0] for r in rows.select(F.size("x")).distinct().collect()):  # lengths of vectors: those of the models in use
        own = rows.filter(F.size("x") == dim)
        model = fit_whitening(own, dim, components)
        error = identity_error(own, model)

        def run(batches: Iterator[pa.RecordBatch], model: Whitening = model, error: float = error) -> Iterator[pa.RecordBatch]:
            explained = (model.eigenvalues / model.trace).tolist() if model.trace else []
            for part, x in blocks(batches):
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array([model.n] * n, pa.int64()), pa.array(squares(model, x)), pa.array(model.whiten(x).tolist(), pa.list_(pa.float64())),
                        pa.array([explained] * n, pa.list_(pa.float64())), pa.array([error] * n, pa.float64()),
                    ],
                    ["id", "n", "deviation", "whitened", "explained", "identity_error"],
                )

        result = result.union(own.mapInArrow(run, names))
    return result.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")).withColumnRenamed("id", id_column)
