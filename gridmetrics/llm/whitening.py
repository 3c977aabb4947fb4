"""Operator 13: embedding whitening with mixed-precision eigenvectors.

Every entry c of a vector becomes the integer ``x = floor(64 * c) + 1000000``.
Tasks sum the x-vectors, then the products of ``x - floor(S / n)``, both in
whole numbers, so the covariance does not depend on how rows are dealt out.
The matrix, one entry for each pair of dimensions, is all that reaches the
driver. Its eigenvectors are found in single precision and corrected there by
Ogita-Aishima steps in extended precision; vectors whose eigenvalues are too
close for a step to tell apart are parted by the eigenproblem of their own
small, shifted matrix (``eigen``). Every row is then projected, and a last pass
over the result measures how far its covariance is from the identity.

Defined cases: rows whose vector is null, empty, or holds null, non-finite or
such large entries that 64 * c is no long (2**62 and beyond) are dropped. Where
vectors differ in length, the most common length (the longer one of a tie) is
the dimension and vectors of other lengths are dropped too. A direction without variance (an
eigenvalue that rounding alone can give) has ``whitened`` null and takes no
part in ``identity_error``; without any, as with one row, ``explained`` is null.
``deviation`` is null where it is no long. Repeated rows count each, a null
vec_id stays null, other columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows whose products are summed at once.
BLOCK = 4096
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53
LONG = 1 << 63
MAX_STEPS = 40

EPS = float(np.finfo(np.float64).eps)


# --- eigenvectors -------------------------------------------------------------------------

def clusters(values: np.ndarray, near: float) -> list[slice]:
    """Runs of falling eigenvalues that lie within ``near`` of their neighbour."""
    ends = np.flatnonzero(values[:-1] - values[1:] > near) + 1
    return [slice(i, j) for i, j in zip([0, *ends], [*ends, len(values)]) if j - i > 1]


def correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: (corrected vectors, eigenvalues, what the step
    cannot tell apart)."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ a @ x
    s = (s + s.T) / 2
    value = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(value)
    near = float(2 * (np.sqrt((off * off).sum()) + np.abs(value).max() * np.sqrt((r * r).sum())))
    gap = value[None, :] - value[:, None]
    close = np.abs(gap) <= near
    step = np.where(close, r / 2, (s + value[None, :] * r) / np.where(close, 1, gap))
    return x + x @ step, value, near


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a symmetric matrix,
    to double precision, the largest entry of a vector positive."""
    scale = np.abs(matrix).max()
    if not scale:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    a = (matrix / scale).astype(np.longdouble)
    x = np.linalg.eigh((matrix / scale).astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    # a gap that doubles cannot show: the vectors of such eigenvalues are any basis of their space
    alike, last = 4 * len(a) * EPS, np.inf
    for _ in range(MAX_STEPS):
        x, value, near = correction(a, x)
        order = np.argsort(-value, kind="stable")
        x, value = x[:, order], value[order]
        together = clusters(value, near)
        for c in together:
            mean = value[c].mean()
            own = x[:, c].T @ (a @ x[:, c] - mean * x[:, c])
            own = ((own + own.T) / 2).astype(np.float64)
            x[:, c] = x[:, c] @ np.linalg.eigh(own)[1][:, ::-1].astype(np.longdouble)
        if near <= alike and near >= last / 2:  # settled: steps no longer gain
            break
        last = near
    for _ in range(2):  # the step alone leaves close vectors slightly oblique
        x = x + x @ (np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2
    value = (x * (a @ x)).sum(axis=0) / (x * x).sum(axis=0)
    rest = float(np.abs(a @ x - x * value[None, :]).max())
    if rest > 64 * len(a) * EPS:
        raise ArithmeticError(f"the eigenvectors did not settle: {rest}")
    order = np.argsort(-value, kind="stable")
    x, value = x[:, order], value[order]
    top = np.abs(x).argmax(axis=0)
    x *= np.sign(x[top, np.arange(len(a))])
    return (value * scale).astype(np.float64), x.astype(np.float64)


# --- sums over all rows -------------------------------------------------------------------

def usable(vector: Column) -> Column:
    """Vectors all of whose entries are numbers that 64 * c takes to a long."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 56))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine)


def blocks(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, values as rows) of a column of lists of equal length."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    for i in range(0, len(flat), BLOCK):
        yield i, flat[i:i + BLOCK]


def whole(entries: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * entries).astype(np.int64) + SHIFT


def exact_sum(rows: np.ndarray) -> np.ndarray:
    """Column sums of longs as Python numbers."""
    if len(rows) * int(np.abs(rows).max(initial=0)) < LONG:
        return rows.sum(axis=0).astype(object)
    return rows.astype(object).sum(axis=0)


def exact_products(rows: np.ndarray) -> np.ndarray:
    """``rows.T @ rows`` of longs as Python numbers: through doubles while every
    partial sum is exact in them."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < EXACT:
        part = rows.astype(np.float64)
        return (part.T @ part).astype(np.int64).astype(object)
    part = rows.astype(object)
    return part.T @ part


def number_sums(dim: int):
    """Of a task: the number of rows (cell -1) and the sum of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            for _, rows in blocks(batch, dim):
                n, total = n + len(rows), total + exact_sum(whole(rows))
        yield cells(np.arange(-1, dim), [n, *total])
    return run


def number_products(centre: np.ndarray):
    """Of a task: the sums of products of what is left after ``centre``, upper triangle."""
    dim = len(centre)
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        for batch in batches:
            for _, rows in blocks(batch, dim):
                x = whole(rows)
                wide = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, centre)) >= LONG
                left = x.astype(object) - centre if wide else x - centre.astype(np.int64)
                total = total + (left.T @ left if wide else exact_products(left))
        yield cells(upper[0] * dim + upper[1], total[upper])
    return run


def cells(number: np.ndarray, values) -> pa.RecordBatch:
    used = [(int(c), Decimal(int(v))) for c, v in zip(number, values) if v]
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in used], pa.int64()),
                                       pa.array([v for _, v in used], pa.decimal128(38, 0))], names=["cell", "value"])


def summed(df: DataFrame, task) -> dict[int, int]:
    """Sums by cell over all tasks: as many as there are cells, whatever the rows."""
    parts = df.mapInArrow(task, "cell long, value decimal(38,0)")
    return {r["cell"]: int(r["value"]) for r in parts.groupBy("cell").agg(F.sum("value").alias("value")).collect()}


def covariance(vectors: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums by dimension, covariance) of the x-vectors of the column ``v``."""
    sums = summed(vectors, number_sums(dim))
    n, total = sums.get(-1, 0), np.array([sums.get(k, 0) for k in range(dim)], object)
    if not n:
        return 0, total, np.zeros((dim, dim))
    centre = total // n
    rest = total - n * centre  # from 0 to n - 1: what the whole centre leaves over
    products, matrix = summed(vectors, number_products(centre)), np.zeros((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            matrix[i, j] = matrix[j, i] = (n * products.get(i * dim + j, 0) - rest[i] * rest[j]) / (n * n)
    return n, total, matrix


# --- projection ---------------------------------------------------------------------------

def projector(n: int, total: np.ndarray, vectors: np.ndarray, values: np.ndarray, live: np.ndarray):
    """Rows as (vec_id, deviation, w): w over the components, null where one has no variance."""
    dim, centre = len(total), total // n
    rest = (total - n * centre).astype(np.float64) / n
    basis = vectors[:, live] / np.sqrt(values[live])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows in blocks(batch, dim):
                x = whole(rows)
                wide = n * (int(np.abs(x).max()) + max(map(abs, total)) // n + 1) >= 1 << 31
                apart = n * (x.astype(object) if wide else x) - (total if wide else total.astype(np.int64))
                if not wide and dim * int(np.abs(apart).max()) ** 2 < LONG:
                    deviation = (apart * apart).sum(axis=1).tolist()
                else:
                    deviation = (apart.astype(object) ** 2).sum(axis=1)
                    deviation = [d if d < LONG else None for d in deviation]
                # the whole part of the mean goes first: what is left is small and exact
                left = (x.astype(object) - centre).astype(np.float64) if wide else (x - centre.astype(np.int64)).astype(np.float64)
                w = np.full((len(x), len(live)), np.nan)
                w[:, live] = (left - rest) @ basis
                flat = pa.array(w.ravel(), from_pandas=True)
                offsets = pa.array(np.arange(0, w.size + 1, len(live)), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").slice(i, len(x)), pa.array(deviation, pa.int64()),
                                                  pa.ListArray.from_arrays(offsets, flat)], names=["vec_id", "deviation", "v"])
    return run


def double_products(centre: np.ndarray):
    """Of a task: the products of what is left after ``centre``, in doubles."""
    dim = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for _, rows in blocks(batch, dim):
                total += (rows - centre).T @ (rows - centre)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["cell", "value"])
    return run


def identity_error(white: DataFrame, live: np.ndarray, n: int) -> float | None:
    """The largest entry of the covariance of ``v`` minus the identity, over the components with variance."""
    if not live.any():
        return None
    means = white.select([F.avg(F.get("v", F.lit(int(k)))).alias(f"m{k}") for k in np.flatnonzero(live)]).first()
    only = white.select(F.filter("v", lambda c: c.isNotNull()).alias("v"))
    parts = only.mapInArrow(double_products(np.array(means, np.float64)), "cell long, value double")
    found = {r["cell"]: r["value"] for r in parts.groupBy("cell").agg(F.sum("value").alias("value")).collect()}
    size = int(live.sum())
    matrix = np.array([found[k] for k in range(size * size)]).reshape(size, size) / n
    return float(np.abs(matrix - np.eye(size)).max())


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened vectors; see the module text. ``table`` needs ``vec_id,
    embedding``. Returns one row per remaining row and component: ``vec_id,
    component, n, deviation, whitened, explained, identity_error``."""
    spark = table.sparkSession
    scratch = Scratch(spark, "whitening")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(usable(F.col("v")))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], schema)
    dim = length["d"]
    rows = rows.filter(F.size("v") == dim)
    n, total, matrix = covariance(rows.select("v"), dim)
    values, vectors = eigen(matrix)
    values, vectors = values[:components], vectors[:, :components]
    trace = float(np.trace(matrix))
    live = values > 16 * dim * EPS * max(trace, 0.0)
    white = scratch.save(rows.mapInArrow(projector(n, total, vectors, values, live), "vec_id long, deviation long, v array<double>"),
                         "white")
    error = identity_error(white, live, n)
    share = F.array(*(F.lit(float(max(e, 0.0)) / trace if trace else None).cast("double") for e in values))
    return (white.select("vec_id", "deviation", F.posexplode(F.arrays_zip(F.col("v").alias("w"), share.alias("e"))))
            .select("vec_id", (F.col("pos") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    F.col("col.w").alias("whitened"), F.col("col.e").alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))
