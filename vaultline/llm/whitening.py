"""Embedding whitening: pivoted Cholesky of the scatter, one-sided Jacobi on its triangular factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.tables import written

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 32)  # entries beyond it are left out, so that all sums fit 38 digits
SWEEPS = 60
GROUPS = 256  # in which the parts of tasks meet first
LONG = 1 << 63


@dataclass
class Whitening:
    """``n`` vectors with the sums ``sums`` a dimension; components are columns, by falling eigenvalue."""

    n: int
    sums: np.ndarray  # whole numbers
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float | None


def pivoted_cholesky(matrix: np.ndarray, tolerance: float = 1e-14) -> tuple[np.ndarray, np.ndarray]:
    """``lower`` and ``order`` with ``matrix[order][:, order] = lower @ lower.T``.

    The largest diagonal entry that is left is the next pivot; where none is left above rounding the matrix
    has no more rank, and ``lower`` no more columns.
    """
    left = np.array(matrix, dtype=float)
    size = len(left)
    order, lower = np.arange(size), np.zeros((size, size))
    floor = tolerance * max(left.diagonal().max(initial=0.0), 0.0) * size
    for k in range(size):
        pivot = k + int(left.diagonal()[k:].argmax())
        if left[pivot, pivot] <= floor:
            return lower[:, :k], order
        swap = [k, pivot], [pivot, k]
        order[swap[0]] = order[swap[1]]
        left[swap[0]] = left[swap[1]]
        left[:, swap[0]] = left[:, swap[1]]
        lower[swap[0], :k] = lower[swap[1], :k]
        lower[k, k] = np.sqrt(left[k, k])
        lower[k + 1 :, k] = left[k + 1 :, k] / lower[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(lower[k + 1 :, k], lower[k + 1 :, k])
    return lower, order


def turned_columns(factor: np.ndarray) -> np.ndarray:
    """``factor`` times the rotation that makes its columns orthogonal, by one-sided Jacobi sweeps.

    A sweep meets every two columns once, in rounds of pairs that share none, so a round turns all its pairs
    side by side.
    """
    turned = np.array(factor, dtype=float)
    count = turned.shape[1]
    ring = np.arange(count + count % 2)  # an odd column sits out, with the one that isn't there
    small = 1e-15
    for _ in range(SWEEPS):
        most = 0.0
        for _ in range(len(ring) - 1):
            one, two = ring[: len(ring) // 2], ring[::-1][: len(ring) // 2]
            real = (one < count) & (two < count)
            one, two = one[real], two[real]
            x, y = turned[:, one], turned[:, two]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            scale = np.sqrt(xx * yy)
            skew = np.divide(np.abs(xy), scale, out=np.zeros_like(xy), where=scale > 0)
            most = max(most, skew.max(initial=0.0))
            turn = skew > small
            ratio = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            sign = np.where(ratio < 0, -1.0, 1.0)
            tangent = np.where(turn, sign / (np.abs(ratio) + np.hypot(1.0, ratio)), 0.0)
            cosine = 1 / np.hypot(1.0, tangent)
            turned[:, one], turned[:, two] = cosine * (x - tangent * y), cosine * (tangent * x + y)
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if most <= small * 10:
            break
    return turned


def principal(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; as many as the matrix has rank."""
    lower, order = pivoted_cholesky(covariance)
    turned = turned_columns(lower)
    norms = np.sqrt((turned * turned).sum(axis=0))
    by_size = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(turned)
    vectors[order] = turned[:, by_size] / norms[by_size]
    return norms[by_size] ** 2, vectors


def whole_vector(vector: Column) -> Column:
    """``floor(64 c) + 1000000`` of every entry; null where an entry is null, not finite or beyond 2^32, or there is none."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= F.lit(LARGEST), F.lit(False)))
    whole = F.transform(entries, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return F.when(fine & (F.size(vector) > 0), whole)


def _block(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """A table of the lists of a column, which all have ``size`` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _summed(table: DataFrame, parts, size: int) -> np.ndarray:
    """``parts`` of every batch, added up exactly in Spark; one whole number for each place comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=object)  # whole numbers of any size
        for batch in batches:
            if batch.num_rows:
                total = total + parts(batch)
        totals = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), totals], names=["place", "total"])

    by_place = table.mapInArrow(run, "place int, total decimal(38,0)").groupBy("place")
    out = np.zeros(size, dtype=object)
    for row in by_place.agg(F.sum("total").alias("total")).collect():
        out[row["place"]] = int(row["total"])
    return out


def _exact_covariance(fit: DataFrame, dims: int, n: int, sums: np.ndarray) -> np.ndarray:
    """Of whole vectors, divisor n: products of distances from the nearest whole number to the mean, added
    up as whole numbers, and the rest of the centring in whole numbers of any size."""
    near = np.array([(2 * s + n) // (2 * n) for s in sums.tolist()], dtype=np.int64)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        off = _block(batch.column("x"), dims) - near
        if float(np.abs(off).max()) ** 2 * len(off) < 2.0**52:  # then doubles add them exactly too, and faster
            return (off.astype(float).T @ off.astype(float)).astype(np.int64).ravel()
        return (off.astype(object).T @ off.astype(object)).ravel()

    scatter = _summed(fit, products, dims * dims).reshape(dims, dims)
    rest = np.array([s - n * int(r) for s, r in zip(sums.tolist(), near.tolist())], dtype=object)
    centred = n * scatter - np.outer(rest, rest)
    return np.array([[float_ratio(v, n * n) for v in row] for row in centred])


def float_ratio(top: int, bottom: int) -> float:
    """The nearest double to the quotient of two whole numbers of any size."""
    return top / bottom


def _white(x: np.ndarray, fitted: Whitening, count: int) -> np.ndarray:
    """Rows of ``x - S/n`` on the first components, over the root of their eigenvalues."""
    whole = np.array([int(s) // fitted.n for s in fitted.sums], dtype=np.int64)
    part = np.array([float_ratio(int(s) % fitted.n, fitted.n) for s in fitted.sums])
    return ((x - whole) - part) @ (fitted.components[:, :count] / np.sqrt(fitted.eigenvalues[:count]))


def _identity_error(fit: DataFrame, dims: int, fitted: Whitening, count: int) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, from centred products of each
    task that are combined two by two, as means and scatters."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                white = _white(_block(batch.column("x"), dims), fitted, count)
                mean = white.mean(axis=0)
                total = _together(total, (len(white), mean, (white - mean).T @ (white - mean)))
        if total:
            yield pa.RecordBatch.from_pydict(
                {"n": [total[0]], "mean": [total[1].tolist()], "scatter": [total[2].ravel().tolist()]}
            )

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        total = None
        for row in frame.sort_values("part").itertuples():
            total = _together(total, (row.n, np.asarray(row.mean), np.asarray(row.scatter).reshape(count, count)))
        return pd.DataFrame(
            {"part": [frame["part"].min()], "n": [total[0]], "mean": [total[1]], "scatter": [total[2].ravel()]}
        )

    schema = "n long, mean array<double>, scatter array<double>"
    parts = fit.mapInArrow(own, schema).withColumn("part", F.spark_partition_id())
    for groups in (GROUPS, 1):  # tasks, then groups of tasks
        parts = parts.groupBy(F.pmod("part", F.lit(groups))).applyInPandas(joined, f"part int, {schema}")
    row = parts.first()
    return float(np.abs(np.reshape(row["scatter"], (count, count)) / row["n"] - np.eye(count)).max())


def _together(one: tuple | None, two: tuple) -> tuple:
    """Count, mean and centred scatter of two parts as of one."""
    if one is None:
        return two
    n, gap = one[0] + two[0], two[1] - one[1]
    scatter = one[2] + two[2] + np.outer(gap, gap) * (one[0] * two[0] / n)
    return n, one[1] + gap * (two[0] / n), scatter


def fit_whitening(vectors: DataFrame, count: int = 16) -> Whitening | None:
    """Of ``x`` (whole vectors of one length), each distinct one once; None if there is none."""
    fit = written(vectors.select("x").distinct(), "whitening-fit")
    head = fit.first()
    if head is None:
        return None
    dims, n = len(head["x"]), fit.count()
    sums = _summed(fit, lambda batch: _block(batch.column("x"), dims).sum(axis=0), dims)
    covariance = _exact_covariance(fit, dims, n, sums)
    eigenvalues, components = principal(covariance)
    fitted = Whitening(n, sums, eigenvalues, components, float(np.trace(covariance)), None)
    count = min(count, len(eigenvalues))
    if count:
        fitted.identity_error = _identity_error(fit, dims, fitted, count)
    return fitted


def whiten(embeddings: DataFrame, vector: str = "embedding", count: int = 16) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: ``count`` rows for each vector.

    Reads vec_id and ``vector``. Rows whose vector is null, empty, or holds entries that are null, not finite
    or beyond 2^32 are left out, and so are those of another length than most (of equally many, the longest).
    Entries count as whole numbers, ``floor(64 c) + 1000000``. Distinct vectors make the covariance, which
    is exact up to its last rounding, so neither the order of rows nor a lost executor changes a result.
    deviation is exact; it is null where it does not fit a long. Directions without any variance (beyond the
    rank of the covariance) have no component: fewer than ``count`` rows a vector then, none if all vectors
    are equal. Repeated rows each have their own; an empty table gives no rows.
    """
    whole = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), whole_vector(F.col(vector)).alias("x"))
    whole = whole.where("x is not null")
    sizes = whole.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if sizes is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    dims = sizes["dims"]
    whole = whole.where(F.size("x") == dims)
    fitted = fit_whitening(whole, count)
    width = min(count, len(fitted.eigenvalues))
    if not width:
        return embeddings.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array([int(s) for s in fitted.sums], dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _block(batch.column("x"), dims)
            far = float(np.abs(x).max()) * fitted.n + float(np.abs(exact).max())
            off = fitted.n * x - exact.astype(np.int64) if far < 2.0**62 else fitted.n * x.astype(object) - exact
            if float(np.abs(off).max()) ** 2 * dims < 2.0**62:
                deviation = pa.array((off.astype(np.int64) ** 2).sum(axis=1))
            else:
                sums = (off.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([s if s < LONG else None for s in sums.tolist()], pa.int64())
            rows = np.repeat(np.arange(len(x)), width)
            white = _white(x, fitted, width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), fitted.n)),
                    deviation.take(pa.array(rows)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(fitted.eigenvalues[:width] / fitted.trace, len(x))),
                    pa.array(np.full(len(rows), fitted.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return whole.mapInArrow(run, schema)
