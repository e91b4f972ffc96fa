"""Whitening of embeddings by cyclic Jacobi rotations of their covariance.

Entries become integers, so sums and the centred scatter are added up exactly by the tasks and by Spark, whatever the
order. The driver gets one number for each pair of dimensions, rotates until all off-diagonals have vanished next to their
diagonal entries (which keeps small eigenvalues accurate), and sends the sorted projection out again.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LARGEST = float(1 << 52)  # of an entry; beyond it no 64-bit integer is sure to hold the scaled one
_SAFE = 1 << 62
_EXACT = 1 << 53  # integers up to it are doubles


class Whitening(NamedTuple):
    """The fitted projection of integer vectors x: (x - total / n) @ axes / sqrt(values)."""

    n: int
    total: list[int]  # sums by dimension, exact
    low: int
    high: int  # over all entries
    values: np.ndarray  # eigenvalues, falling
    axes: np.ndarray  # a column for each eigenvalue
    trace: float

    def centre(self) -> list[int]:
        return [round(s / self.n) if abs(s) < _EXACT else (2 * s + self.n) // (2 * self.n) for s in self.total]


def tournament(d: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs that name each pair of 0 to d - 1 once: a cyclic order whose rotations of a round commute."""
    ring, rounds = list(range(d + d % 2)), []
    for _ in range(len(ring) - 1):
        pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[: len(ring) // 2], reversed(ring[len(ring) // 2 :]), strict=True) if max(p, q) < d]
        rounds.append(tuple(np.array(pairs).T) if pairs else (np.array([], int), np.array([], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return rounds


def cyclic_jacobi(matrix: np.ndarray, tolerance: float = 2.0**-52, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the largest entry of each is positive) of a symmetric matrix.

    Sweeps rotate every pair until each off-diagonal is within ``tolerance`` of the geometric mean of its diagonal entries."""
    a, d = np.array(matrix, float), len(matrix)
    axes, rounds = np.eye(d), tournament(d)
    for _ in range(sweeps):
        turned = 0
        for p, q in rounds:
            on = np.abs(a[p, q]) > tolerance * np.sqrt(np.abs(a[p, p])) * np.sqrt(np.abs(a[q, q]))
            p, q = p[on], q[on]
            if not len(p):
                continue
            turned += len(p)
            with np.errstate(over="ignore"):
                theta = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = np.where(theta < 0, -1.0, 1.0) / (np.abs(theta) + np.hypot(theta, 1))
            c = 1 / np.hypot(t, 1)
            s = t * c
            new_p, new_q = a[p, p] - t * a[p, q], a[q, q] + t * a[p, q]
            a[p], a[q] = c[:, None] * a[p] - s[:, None] * a[q], s[:, None] * a[p] + c[:, None] * a[q]
            for m in (a, axes):
                m[:, p], m[:, q] = c * m[:, p] - s * m[:, q], s * m[:, p] + c * m[:, q]
            a[p, p], a[q, q], a[p, q], a[q, p] = new_p, new_q, 0.0, 0.0
        if not turned:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    values, axes = np.diag(a)[order], axes[:, order]
    return values, axes * np.where(axes[np.abs(axes).argmax(0), np.arange(d)] < 0, -1.0, 1.0)


def usable(vector: Column) -> Column:
    """True if the vector is not null and all entries are finite and fit."""
    return vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))


def _integers(vectors: pa.ListArray, length: int, scale: int, shift: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(flat * scale).astype(np.int64) + shift).reshape(-1, length)


def _sums(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """length, i, n, total, low, high of each dimension i of the vectors of a length."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            lists = batch.column("vector")
            lengths = pc.list_value_length(lists)
            for d in pc.unique(lengths).to_pylist():
                if not d:
                    continue
                x = _integers(lists.filter(pc.equal(lengths, d)), d, scale, shift)
                low, high = x.min(0), x.max(0)
                wide = max(-int(low.min()), int(high.max())) * len(x) >= _SAFE
                add = x.astype(object).sum(0) if wide else x.sum(0).astype(object)
                n, total, least, largest = seen.get(d, (0, 0, low, high))
                seen[d] = [n + len(x), total + add, np.minimum(least, low), np.maximum(largest, high)]
        for d, (n, total, low, high) in seen.items():
            columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(list(map(Decimal, total)), pa.decimal128(38, 0)), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, ["length", "i", "n", "total", "low", "high"])

    found = vectors.select("vector").mapInArrow(sums, "length int, i int, n long, total decimal(38,0), low long, high long")
    return found.groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))


def _scatter(vectors: DataFrame, centre: list[int], scale: int, shift: int) -> np.ndarray:
    """Sums over all rows of the products of centred entries: one number for each pair of dimensions comes to the driver."""
    d = len(centre)
    rows, columns = np.triu_indices(d)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, some = np.zeros((d, d)), False
        for batch in batches:
            y = (_integers(batch.column("vector"), d, scale, shift) - np.array(centre)).astype(float)
            own, some = own + y.T @ y, True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(rows * d + columns, pa.int64()), pa.array(own[rows, columns])], ["at", "product"])

    sums = vectors.select("vector").mapInArrow(products, "at long, product double").groupBy("at").agg(F.sum("product").alias("product"))
    whole = np.zeros(d * d)
    for r in sums.collect():
        whole[r["at"]] = r["product"]
    return whole.reshape(d, d)


def fit_whitening(vectors: DataFrame, scale: int = 1024, shift: int = 100_000) -> Whitening | None:
    """Fits on all vectors (column ``vector``, usable ones) of the commonest length (the longest of equally common ones); None if there are none."""
    stats = written(_sums(vectors, scale, shift), "vector-sums")
    first = stats.where("i = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if first is None:
        return None
    rows = stats.where(F.col("length") == first["length"]).orderBy("i").collect()
    n, total = first["n"], [int(r["total"]) for r in rows]
    model = Whitening(n, total, min(r["low"] for r in rows), max(r["high"] for r in rows), np.array([]), np.array([]), 0.0)
    centre = model.centre()
    length = F.size("vector") == len(centre)
    products = _scatter(vectors.where(length), centre, scale, shift)
    # The centre is the mean to the next integer; the rest of the mean is taken off by exact integers.
    rest = [s - n * c for s, c in zip(total, centre, strict=True)]
    covariance = np.zeros_like(products)
    for i in range(len(centre)):
        for j in range(i, len(centre)):
            covariance[i, j] = covariance[j, i] = (n * int(products[i, j]) - rest[i] * rest[j]) / (n * n)
    values, axes = cyclic_jacobi(covariance)
    return model._replace(values=values, axes=axes, trace=float(np.trace(covariance)))


def whiten(vectors: DataFrame, model: Whitening, components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """vec_id, deviation (decimal; null beyond 38 digits), whitened (an entry for each component; null where the eigenvalue is zero to double precision)."""
    d, k = len(model.total), min(components, len(model.total))
    real = model.values[:k] > d * 2.0**-52 * max(model.values[0], 0.0)
    project = model.axes[:, :k] / np.sqrt(np.where(real, model.values[:k], 1.0))
    centre = model.centre()
    rest = np.array([(s - model.n * c) / model.n for s, c in zip(model.total, centre, strict=True)])
    widest = model.n * (model.high - model.low)
    short, n = d * widest * widest < _SAFE, model.n

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch.column("vector"), d, scale, shift)
            if not len(x):
                continue
            if short:  # n * (x - centre) - rest of the sums stays small, while n * x might not
                apart = n * (x - np.array(centre)) - np.array([s - n * c for s, c in zip(model.total, centre, strict=True)])
                squares = (apart * apart).sum(1).tolist()
            else:
                apart = n * x.astype(object) - np.array(model.total, object)
                squares = (apart * apart).sum(1).tolist()
            deviation = pa.array([Decimal(v) if v < 10**38 else None for v in squares], pa.decimal128(38, 0))
            white = ((x - np.array(centre)).astype(float) - rest) @ project
            flat = pa.array(white.ravel(), mask=np.tile(~real, len(x)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * k + 1, k), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, lists], ["vec_id", "deviation", "whitened"])

    return vectors.where(F.size("vector") == d).mapInArrow(rows, "vec_id long, deviation decimal(38,0), whitened array<double>")


def whitened_components(embeddings: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained, identity_error: a row for each usable vector and component.

    Vectors that are null, hold null or non-finite entries, or entries over ``LARGEST`` (no 64-bit integer would hold them) are dropped, and so
    are vectors of another length than the commonest. identity_error is measured on the whitened values themselves. Where an eigenvalue is
    zero to double precision (a single vector, equal vectors, dependent dimensions) whitened is null and identity_error leaves the component out.
    Vectors of fewer dimensions have fewer components. Null and repeated ids are kept; other columns are not read; without
    usable vectors the result is empty.
    """
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    model = fit_whitening(vectors, scale, shift)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    white = written(whiten(vectors, model, components, scale, shift), "whitened")
    k = min(components, len(model.total))
    entry = [F.element_at("whitened", i + 1) for i in range(k)]
    errors = [F.abs(F.covar_pop(entry[i], entry[j]) - float(i == j)) for i in range(k) for j in range(i, k)]
    apart = white.agg(F.array_max(F.array(*errors)).alias("apart")).first()["apart"]
    explained = F.array(*(F.lit(float(v / model.trace) if model.trace else 0.0) for v in np.maximum(model.values[:k], 0)))
    rows = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(apart).cast("double").alias("identity_error"))
