"""Whitening of embeddings by shifted CholeskyQR.

Entries are quantised to integers (``floor(256 * entry)``). The fit list holds each distinct vector once. Its rows, centred by
the exact mean, are orthogonalised in distributed passes: a pass sends every row through triangular solves with the factors found so far and
sums the Gram matrix of the results; the Cholesky factor of that matrix, shifted in the first pass and wherever it isn't
positive definite, is the next factor. When the rows are orthonormal (on their range, if dimensions depend on each other), the product of
the factors is R of the centred matrix, and the SVD of R gives the components: right singular vectors, and eigenvalues of the
covariance by the squared singular values.

The driver gets a Gram matrix a pass: dimensions squared, whatever the number of rows. Tasks send one matrix each, cut into its rows, and
these meet by row number. Vectors that repeat meet once before the passes (``distinct``, combined in each task first).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.llm.graph import stage_table

SCALE = 256
#: Entries whose product with SCALE has no long.
_LIMIT = 2.0 ** 63 / SCALE
_UNIT = 2.0 ** -53
_DONE = 1e-11
_MOST_PASSES = 8


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``n`` vectors with exact per-dimension ``sums``; rows of ``components`` are unit eigenvectors by falling
    ``values``; ``total`` is the covariance's trace; ``passes`` counts the Gram passes."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    total: float
    identity_error: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


def usable(vec_col: str) -> Column:
    """No null, no null or non-finite entry, no entry whose quantised value has no long, not empty."""
    c = F.col(vec_col)
    return F.coalesce(F.forall(c, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < _LIMIT)) & (F.size(c) > 0), F.lit(False))


def quantised(vec_col: str) -> Column:
    return F.transform(F.col(vec_col), lambda v: F.floor(v.cast("double") * SCALE).cast("bigint"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows @ inv(factor)`` for an upper triangular factor, column by column."""
    out = np.empty_like(rows)
    for j in range(factor.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            x = _matrix(b.column(0), d)
            if len(x):
                small = int(max(abs(int(x.min())), abs(int(x.max())))) * len(x) < 2 ** 62
                add = x.sum(axis=0) if small else x.astype(object).sum(axis=0)
                n, total = n + len(x), [a + int(b_) for a, b_ in zip(total, add)]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([Decimal(v) for v in (n, *total)], kind)], ["i", "s"])

    got = {r.i: int(r.s) for r in fit.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}  # d + 1 rows
    return got.get(-1, 0), [got.get(i, 0) for i in range(d)]


def gram(rows: DataFrame, d: int, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Gram matrix (``width`` squared) of ``of(block of rows)`` over all rows of the first column of ``rows``."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = np.zeros((width, width))
        for b in batches:
            if b.num_rows:
                y = of(_matrix(b.column(0), d))
                total += y.T @ y
        at = np.arange(0, width * width + 1, width).astype(np.int32)
        part = np.full(width, TaskContext.get().partitionId(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(part), pa.ListArray.from_arrays(at, total.ravel())], ["i", "part", "v"])

    def added(group: pa.Table) -> pa.Table:
        group = group.sort_by("part").combine_chunks()
        v = _matrix(group.column("v").chunk(0), width).sum(axis=0)
        return pa.table({"i": group.column("i").slice(0, 1), "v": pa.array([v.tolist()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(partial, "i int, part int, v array<double>")
    out = np.zeros((width, width))
    for r in parts.groupBy("i").applyInArrow(added, "i int, v array<double>").collect():  # width rows
        out[r.i] = r.v
    return (out + out.T) / 2


def factor(g: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """Upper Cholesky factor; shifted by 11 (n d + d (d + 1)) u |g| if asked for or if g isn't positive definite."""
    d = len(g)
    if not shift:
        try:
            return np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            pass
    s = min(11 * (n * d + d * (d + 1)) * _UNIT, 1e-3) * max(np.linalg.norm(g, 2), np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(g + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            s *= 10


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = 4) -> Whitening | None:
    """Fit on the distinct quantised vectors of ``vectors``; at most ``components`` components, and none of no variance.

    The dimension is the length that most vectors have (the smaller one on a tie); vectors of another length take no part. None if no vector is usable."""
    good = vectors.where(usable(vec_col)).select(quantised(vec_col).alias("x"))
    common = good.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if common is None:
        return None
    d = common.d
    listed = stage_table(good.where(F.size("x") == d).distinct(), "whitening-fit")
    n, sums = _sums(listed, d)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    factors: list[np.ndarray] = []

    def orthogonalised(x: np.ndarray, factors=factors) -> np.ndarray:
        y = x.astype(float) - mean
        for r in factors:
            y = solve(y, r)
        return y

    whole = np.eye(d)
    for passes in range(1, _MOST_PASSES + 1):
        g = gram(listed, d, d, orthogonalised)
        if factors and np.abs(g @ g - g).max() <= _DONE:
            break
        factors.append(factor(g, n, shift=not factors))
        whole = factors[-1] @ whole
    _, s, vt = np.linalg.svd(whole)
    values, total = s ** 2 / n, float((s ** 2).sum() / n)
    k = int(min(components, (values > d * 1e-13 * max(total, 0.0)).sum())) if len(factors) and total > 1e-12 else 0
    vt = vt * np.where(np.take_along_axis(vt, np.abs(vt).argmax(axis=1)[:, None], 1) < 0, -1.0, 1.0)  # the largest entry is positive
    vt, values = vt[:k], values[:k]
    scaled = (vt / np.sqrt(values)[:, None]).T
    error = float(np.abs(gram(listed, d, k, lambda x: (x.astype(float) - mean) @ scaled) / n - np.eye(k)).max()) if k else 0.0
    return Whitening(n, tuple(sums), vt, values, total, error, passes)


def _deviation(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sum of (n x - S)^2 by row; None where no long holds it."""
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if most ** 2 * x.shape[1] < 2 ** 63:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(axis=1).tolist()
    y = n * x.astype(object) - np.array(sums, object)
    return [v if v < 2 ** 63 else None for v in map(int, (y * y).sum(axis=1))]


OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def transform(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: id, ``component`` (from 1), ``n``, ``deviation`` (exact squared distance of n x from the sums; null where no
    long holds it), ``whitened``, ``explained`` (share of the variance) and ``identity_error`` (of the fit). Vectors of another length
    than the fit's give no rows; neither does a table without variance, or without usable vectors. Repeated rows each give theirs; other columns are not read."""
    kind = vectors.schema[id_col]
    schema = T.StructType([T.StructField(id_col, kind.dataType), *T._parse_datatype_string(OUT).fields])
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    d, k, n, sums, mean = len(model.sums), len(model.values), model.n, model.sums, model.mean
    scaled = (model.components / np.sqrt(model.values)[:, None]).T
    explained, error = model.values / model.total, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), d)
            rows = len(x)
            at = pa.array(np.repeat(np.arange(rows), k))
            far = pa.array(_deviation(x, n, sums), pa.int64())
            white = (x.astype(float) - mean) @ scaled
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)), far.take(at),
                 pa.array(white.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))], schema.names)

    good = vectors.where(usable(vec_col)).select(F.col(id_col), quantised(vec_col).alias("quantised"))
    return good.where(F.size("quantised") == d).mapInArrow(run, schema)
