"""Embedding whitening from a polarised covariance.

Entries become whole numbers, so every sum is exact. No product of two dimensions is ever summed: the squares of each
centred dimension and of each centred sum of two dimensions are, and

    2 Cov(i, j) = Var(i + j) - Var(i) - Var(j)

gives every cross-covariance. Values are centred on the whole number next to the mean before they are squared; what is
left of the mean (at most a half) is taken off in exact integers. Tasks hold one block of vectors and a matrix of sums;
the driver gets one number per pair of dimensions, which the eigenvectors need, and never a vector.

Defined results: a row whose vector is null, or holds a null, NaN or infinite entry, is left out. The dimension is the
length most rows have (of equally common ones the greatest); rows of another length are left out as well. Equal
vectors count once in the fit and every row gets its own values, rows with a null or repeated vec_id too. A
component without variance (at most 1e-12 of the largest) has no whitened value, so it is left out; with one vector, or none,
there is no component and no row comes out. Other columns are ignored. Entries so large that a deviation leaves the
range of a long raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query

#: Units of a whole number to one of an entry, and the components returned (fixed values of the contract).
UNITS = 256
COMPONENTS = 4
#: Share of the largest variance at or below which a component counts as having none.
NO_VARIANCE = 1e-12
#: Vectors squared at a time.
BLOCK = 4096

EXACT = pa.decimal128(38, 0)


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): each usable vector in whole units, of any length."""
    entries = F.col("embedding").cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.where(F.col("embedding").isNotNull() & finite)
    return usable.select("vec_id", F.transform(entries, lambda c: F.floor(c * UNITS)).alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, centre: np.ndarray) -> Iterator[np.ndarray]:
    """Centred vectors, in a type in which sums of their squares over a block are exact."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            x = _matrix(batch.slice(at, BLOCK).column("x"), dims)
            small = np.abs(x.astype(float) - centre.astype(float)).max(initial=0) < 2**24
            yield x - centre.astype(np.int64) if small else x.astype(object) - centre


def _exact_batch(at: list[tuple[int, int]], sums: list[int]) -> pa.RecordBatch:
    if any(abs(v) >= 10**38 for v in sums):
        raise OverflowError("a sum of squares leaves 38 digits, so a deviation leaves the range of a long")
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()), pa.array([Decimal(int(v)) for v in sums], EXACT)],
        names=["i", "j", "total"],
    )


def _totals(fit: DataFrame, partial) -> dict[tuple[int, int], int]:
    """Exact sums over all vectors by (i, j); ``partial`` gives one batch of them per task."""
    found = fit.mapInArrow(partial, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(r["i"], r["j"]): int(r["total"]) for r in found.collect()}


def dimension_sums(fit: DataFrame, dims: int) -> list[int]:
    def partial(batches):
        total, none = [0] * dims, np.zeros(dims, object)
        for x in _blocks(batches, dims, none):
            total = [a + int(b) for a, b in zip(total, x.sum(0), strict=True)]
        yield _exact_batch([(i, i) for i in range(dims)], total)

    found = _totals(fit, partial)
    return [found[i, i] for i in range(dims)]


def squared_sums(fit: DataFrame, dims: int, centre: list[int]) -> dict[tuple[int, int], int]:
    """Sums of (x_i - c_i)^2 under (i, i) and of (x_i - c_i + x_j - c_j)^2 under (i, j), i < j."""
    middle = np.array(centre, object)

    def partial(batches):
        total = {(i, j): 0 for i in range(dims) for j in range(i, dims)}
        for d in _blocks(batches, dims, middle):
            for i in range(dims):
                pair = d[:, i : i + 1] + d[:, i:]
                pair[:, 0] = d[:, i]
                for j, v in enumerate((pair * pair).sum(0).tolist(), i):
                    total[i, j] += v
        yield _exact_batch(list(total), list(total.values()))

    return _totals(fit, partial)


def polarised_covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances, divisor n. ``rest`` are the sums of the centred values, which are left of the means."""
    dims = len(rest)
    variance = {(i, j): n * q - (rest[i] + rest[j] if i < j else rest[i]) ** 2 for (i, j), q in squares.items()}
    out = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            twice = 2 * variance[i, i] if i == j else variance[i, j] - variance[i, i] - variance[j, j]
            out[i, j] = out[j, i] = float(Fraction(twice, 2 * n * n))
    return out


class Whitening:
    """Means, leading components and what each row's values need."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int = COMPONENTS):
        self.n, self.sums, self.dims = n, sums, len(sums)
        self.centre = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = np.array([float(Fraction(s - n * c, n)) for s, c in zip(sums, self.centre, strict=True)])
        values, vectors = np.linalg.eigh(covariance) if self.dims else (np.empty(0), np.empty((0, 0)))
        values, vectors = values[::-1], vectors[:, ::-1]
        kept = int((values[:components] > NO_VARIANCE * max(values[0], 0)).sum()) if self.dims else 0
        self.values, self.vectors = values[:kept], vectors[:, :kept]
        if kept:  # either sign would do; this one does not depend on the solver
            lead = self.vectors[np.abs(self.vectors).argmax(0), np.arange(kept)]
            self.vectors = self.vectors * np.sign(lead)
        trace = float(np.trace(covariance))
        self.explained = self.values / trace if kept else self.values

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - np.array(self.centre, np.int64)).astype(float) - self.rest) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        widest = float(self.n) * (np.abs(x.astype(float)).max(initial=0) + max(abs(c) for c in self.centre) + 1)
        if widest * widest * self.dims < 2**62:
            return ((x * np.int64(self.n) - np.array(self.sums, np.int64)) ** 2).sum(1)
        exact = ((x.astype(object) * self.n - np.array(self.sums, object)) ** 2).sum(1)
        if max(exact, default=0) >= 2**63:
            raise OverflowError("a deviation leaves the range of a long")
        return exact.astype(np.int64)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, from the values themselves."""
    k = len(model.values)

    def sums_of(of):
        def partial(batches):
            total = np.zeros(of(np.zeros((0, k))).shape)
            for batch in batches:
                total += of(model.whitened(_matrix(batch.column("x"), model.dims)))
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["i", "total"])

        found = fit.mapInArrow(partial, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
        return np.array([r["total"] for r in sorted(found, key=lambda r: r["i"])]) / model.n

    mean = sums_of(lambda w: w.sum(0))
    covariance = sums_of(lambda w: (w - mean).T @ (w - mean) if len(w) else np.zeros((k, k))).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, float, int]:
    """(model, identity error, dimension) of ``whole_vectors``; no model without vectors or variance."""
    length = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if length is None or not length["dims"]:
        return None, 0.0, 0
    dims = length["dims"]
    fit = common.stored(rows.where(F.size("x") == dims).select("x").distinct(), "op13-fit")
    n, sums = fit.count(), dimension_sums(fit, dims)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    squares = squared_sums(fit, dims, centre)
    model = Whitening(n, sums, polarised_covariance(n, [s - n * c for s, c in zip(sums, centre, strict=True)], squares), components)
    if not len(model.values):
        return None, 0.0, dims
    return model, identity_error(fit, model), dims


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, embedding) -> one row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = whole_vectors(vectors)
    model, error, dims = fit_whitening(rows, components)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def values(batches):
        for batch in batches:
            x, rows = _matrix(batch.column("x"), dims), batch.num_rows
            whitened, deviation = model.whitened(x), model.deviation(x)
            owner = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(owner), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n)), pa.array(np.repeat(deviation, k)), pa.array(whitened.ravel()),
                    pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.where(F.size("x") == dims).mapInArrow(values, schema)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(common.read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
