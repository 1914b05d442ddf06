"""Whitening of embeddings by shifted Cholesky QR.

The centred rows X are never held in one place. Each pass multiplies them inside the tasks and
brings back one small matrix: the Gram matrix X'X gives a Cholesky factor, a triangular solve
turns X into rows that are closer to orthogonal, and the next pass does the same with those. The
first factor is that of the Gram matrix plus a shift, so that it exists even for badly scaled
data; after three passes the rows are orthogonal to double precision and the product of the
factors is R of X = QR. The singular values of R give the variances, its right vectors the
components.

Rows without a usable vector (null, empty, a null or not finite entry) are left out. Ties and
repeated rows count as often as they occur; rows are not told apart by their id, which may be
null. Vectors of different lengths cannot be fitted together and raise. Directions without
variance (constant or dependent dimensions) have no component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An entry c becomes the whole number floor(SCALE * c) + OFFSET, so that means are exact.
SCALE, OFFSET = 64.0, 1_000_000
PASSES = 3
#: A dimension whose part outside the ones before it is below this share of it depends on them.
DEPENDENT = 1e-13
#: Entries of a block of rows that a task works on at a time.
BLOCK = 1 << 21
_ROUNDOFF = 2.0**-53


class Whitening(NamedTuple):
    """What the passes found; all of it is as small as one vector or one matrix of dimensions."""

    n: int
    sums: np.ndarray
    #: One unit vector per column, by falling variance.
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.total


Block = tuple[np.ndarray, np.ndarray]


def _whole(batch: pa.RecordBatch) -> Block:
    """(row numbers, whole-number rows) of the usable vectors of an Arrow batch."""
    lists = batch.column("embedding")
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum()))
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(sizes)
    usable = lists.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & (bad[ends] == bad[ends - sizes])
    rows = np.flatnonzero(usable)
    if not len(rows):
        return rows, np.empty((0, 0), np.int64)
    width = int(sizes[rows[0]])
    if (sizes[rows] != width).any():
        raise ValueError(f"vectors of different lengths: {sorted(set(sizes[rows].tolist()))[:5]}")
    kept = flat.reshape(-1, width) if len(rows) == len(sizes) else flat[np.repeat(usable, sizes)].reshape(-1, width)
    return rows, np.floor(SCALE * kept).astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for batch in batches:
        lists = batch.column("embedding")
        entries = max(1, int(lists.offsets[-1].as_py() - lists.offsets[0].as_py()))
        step = max(1, BLOCK * len(batch) // entries)
        for start in range(0, len(batch), step):
            part = batch.slice(start, step)
            rows, x = _whole(part)
            if len(rows):
                yield part, (rows, x)


def right_solve(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """x times the inverse of an upper triangle, column after column."""
    out = np.empty_like(x)
    for j in range(r.shape[1]):
        out[:, j] = (x[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``of(whole-number rows)`` over all blocks: tasks, then groups of tasks, then here.

    A task sends one matrix. The groups are about as many as the root of the number of tasks, and
    matrices are added in the order of the tasks, so that reruns agree.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, (_, x) in _blocks(batches):
            found = of(x)
            if total is not None and total.shape != found.shape:
                raise ValueError(f"vectors of different lengths: {total.shape[-1]} and {found.shape[-1]}")
            total = found if total is None else total + found
        if total is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"task": pa.array([task], pa.int32()), "kind": [total.dtype.str], "width": pa.array([total.shape[-1]], pa.int32()), "sum": [total.tobytes()]}
            )

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("task")
        if parts["width"].nunique() > 1:
            raise ValueError(f"vectors of different lengths: {sorted(parts['width'].unique())[:5]}")
        total = sum(np.frombuffer(s, parts["kind"].iloc[0]) for s in parts["sum"])
        return parts.head(1).assign(sum=[total.tobytes()])

    schema = "task int, kind string, width int, sum binary"
    parts = rows.mapInArrow(part, schema)
    groups = max(1, round(rows.rdd.getNumPartitions() ** 0.5))
    merged = parts.groupBy((F.col("task") % groups).alias("group")).applyInPandas(added, schema)
    left = merged.toPandas()  # one small matrix per group of tasks
    if left.empty:
        return None
    one = added(left).iloc[0]
    return np.frombuffer(one["sum"], one["kind"]).reshape(-1, one["width"])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Exact deviations from the mean, rounded once."""
    return (n * x - sums) / n


def independent(gram: np.ndarray) -> list[int]:
    """Dimensions that are no combination of the ones before them."""
    left, chosen = gram.copy(), []
    for j in range(len(gram)):
        if left[j, j] > DEPENDENT * gram[j, j]:
            chosen.append(j)
            left = left - np.outer(left[:, j], left[j]) / left[j, j]
    return chosen


def fit(rows: DataFrame, components: int = 32) -> Whitening | None:
    """Components of the column ``embedding``; None where no usable vector or no variance is left."""
    rows = rows.select("embedding")
    counted = _summed(rows, lambda x: np.vstack([x.sum(axis=0), np.full(x.shape[1], len(x))]))
    if counted is None:
        return None
    n, sums = int(counted[1, 0]), counted[0]

    def gram(of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            q = of(_centred(x, n, sums))
            return q.T @ q

        return _summed(rows, product)

    first = gram(lambda c: c)
    total = float(np.trace(first)) / n
    chosen = independent(first)
    if not chosen:
        return None
    width = len(chosen)
    # An upper bound of the largest singular value goes into the shift of the first pass.
    shift = 11 * (n * width + width * (width + 1)) * _ROUNDOFF * float(np.trace(first))
    shift = min(shift, 1e-3 * float(np.diag(first)[chosen].min()))
    factors: list[np.ndarray] = []

    def orthogonal(c: np.ndarray) -> np.ndarray:
        q = c[:, chosen]
        for r in factors:
            q = right_solve(q, r)
        return q

    for step in range(PASSES):
        g = first[np.ix_(chosen, chosen)] + shift * np.eye(width) if step == 0 else gram(orthogonal)
        factors.append(np.linalg.cholesky(g).T)
    if width == len(first):
        r = factors[0]
        for later in factors[1:]:
            r = later @ r
    else:
        # Dependent dimensions too, from the orthogonal rows themselves.
        def against_all(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums)
            return orthogonal(c).T @ c

        r = _summed(rows, against_all)
    _, values, vectors = np.linalg.svd(r, full_matrices=False)
    kept = min(components, width)
    vectors = vectors[:kept].T
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    variances = values[:kept] ** 2 / n
    white = gram(lambda c: c @ vectors / np.sqrt(variances)) / n
    return Whitening(n, sums, vectors, variances, total, float(np.abs(white - np.eye(kept)).max()))


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _writer(found: Whitening, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    k = len(found.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (rows, x) in _blocks(batches):
            apart = found.n * x - found.sums
            if (np.square(apart.astype(np.float64)).sum(axis=1) >= 2.0**63).any():
                raise OverflowError("the squared deviations of a vector do not fit into a long")
            white = (apart / found.n) @ found.components / np.sqrt(found.variances)
            size = len(rows) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(size, found.n, np.int64)),
                    pa.array(np.repeat(np.square(apart).sum(axis=1), k)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(found.explained, len(rows))),
                    pa.array(np.full(size, found.identity_error)),
                ],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(rows: DataFrame, key: str = "vec_id", components: int = 32) -> DataFrame:
    """One row per usable vector of ``embedding`` and component, numbered from 1.

    ``deviation`` is the squared distance from the mean times n squared, exact; ``identity_error``
    the largest entry by which the covariance of ``whitened`` differs from the identity.
    """
    rows = rows.select(key, "embedding")
    schema = f"`{key}` {dict(rows.dtypes)[key]}, {SCHEMA}"
    found = fit(rows, components)
    if found is None:
        return rows.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_writer(found, key), schema)
