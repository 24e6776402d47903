"""Whitening components of embeddings by shifted CholeskyQR.

The rows that are fitted stand in a written table.  A pass computes, in every task, the Gram matrix of its centred
rows behind the triangular solves so far, and adds the tasks' matrices by their rows.  Its Cholesky factor, after a
small shift of the diagonal where the matrix is near to singular, is the next solve.  Passes go on until the rows
are orthonormal, so that condition does not limit accuracy as it does where a covariance is decomposed.  The composed factors give R
with R'R = centred rows' Gram matrix; the singular values and right vectors of R are the components.

Only d x d matrices reach the driver, for d entries in a vector, and no task holds more than a batch of rows and one such matrix.
Each task reads as many rows as keep the number of tasks' matrices below TASKS.  Sums of entries are exact integers; rows are centred by
exact integers and rounded once.  Sums over tasks are made in an order of the values, so that repeated runs agree.

* Rows whose vector is null, has no entries, or holds nulls or values that are not finite (or that a long cannot hold once scaled) are dropped.
* Vectors of another length than the most common one (of several the longest) are not fitted; they come back once, with nulls.
* Vectors that are all alike have no components, and directions without any variance (below d machine epsilons of the
  largest deviation) are none: a row comes back once, with null for all components, if there are none at all.
* Repeated rows come back as often as they are there; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .shipping import ship

TASKS = 4096  # of one pass
_PASSES = 12
_ROWS = 2048  # of one block of a task
_BLOCK = 32  # dimensions solved together
_ORTHONORMAL = 1e-13
_EPSILON = float(np.finfo(np.float64).eps)
_LARGEST = 2.0**62  # of an entry that becomes a long
_EXACT = 1 << 62


def scaled(vector: Column, scale: int, shift: int) -> Column:
    """Entries as longs: floor(scale * entry) + shift; null for vectors that are dropped."""
    entries = vector.cast("array<double>")
    fits = F.forall(entries, lambda c: F.coalesce(F.abs(c * F.lit(float(scale))) < F.lit(_LARGEST - abs(shift)), F.lit(False)))
    whole = F.transform(entries, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift).cast("long"))
    return F.when(fits & (F.size(entries) > 0), whole)


@dataclass
class Whitening:
    """Components of the distinct vectors of a table."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # one component a column
    explained: np.ndarray = field(default_factory=lambda: np.zeros(0))
    identity_error: float = 0.0

    @property
    def width(self) -> int:
        return len(self.sums)

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """n * row - sums, exact: longs, or Python's integers where those would not do."""
        base = [s // self.n for s in self.sums] if self.n else list(self.sums)
        rest = np.array([s - b * self.n for s, b in zip(self.sums, base)], dtype=object)
        around = rows - np.array(base, dtype=np.int64)
        if len(rows) and self.n * (int(np.abs(around.astype(np.float64)).max()) + 2) >= _EXACT:
            return rows.astype(object) * self.n - np.array(self.sums, dtype=object)
        return around * np.int64(self.n) - rest.astype(np.int64)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return self.deviations(rows).astype(np.float64) / self.n

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ self.vectors / np.sqrt(self.eigenvalues)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _passed(fitted: DataFrame, width: int, use: Callable[[np.ndarray], np.ndarray], shape: int) -> np.ndarray:
    """The sum over all rows of ``use(rows)``, square matrices of ``shape`` rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((shape, shape))
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            for a in range(0, len(rows), _ROWS):
                total += use(rows[a : a + _ROWS])
        yield pa.record_batch([pa.array(range(shape), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["row", "part"])

    def added(group: pa.Table) -> pa.Table:
        parts = np.sort(_matrix(group.column("part").combine_chunks(), shape), axis=0)
        return pa.table({"row": group.column("row").slice(0, 1), "part": pa.array([parts.sum(axis=0)], pa.list_(pa.float64()))})

    schema = "row int, part array<double>"
    rows = fitted.coalesce(TASKS).mapInArrow(task, schema).groupBy("row").applyInArrow(added, schema).collect()
    result = np.zeros((shape, shape))
    for r in rows:
        result[r["row"]] = r["part"]
    return result


def _counted(fitted: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            n += len(rows)
            high += (rows >> 32).sum(axis=0)
            low += (rows & 0xFFFFFFFF).sum(axis=0)
        columns = [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(high), pa.array(low)]
        yield pa.record_batch(columns, names=["dimension", "n", "high", "low"])

    parts = fitted.mapInArrow(task, "dimension int, n bigint, high bigint, low bigint")
    wide = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("n", "high", "low")]
    found = {r["dimension"]: r for r in parts.groupBy("dimension").agg(*wide).collect()}
    if not found:
        return 0, [0] * width
    return int(found[0]["n"]), [(int(found[i]["high"]) << 32) + int(found[i]["low"]) for i in range(width)]


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows behind one triangular solve after the other: the rows of X with X R = rows."""
    x = np.ascontiguousarray(rows.T)
    for upper in factors:
        for a in range(0, len(x), _BLOCK):
            block = x[a : a + _BLOCK]
            block -= upper[:a, a : a + _BLOCK].T @ x[:a]
            for j in range(len(block)):
                block[j] -= upper[a : a + j, a + j] @ block[:j]
                block[j] /= upper[a + j, a + j]
    return x.T


def _factor(gram: np.ndarray, shifted: bool) -> np.ndarray:
    """The upper triangular R with R'R = Gram matrix, its diagonal shifted where it has to be."""
    shift = 11 * len(gram) * (len(gram) + 1) * _EPSILON * np.linalg.norm(gram, 2) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(100 * shift, _EPSILON * np.linalg.norm(gram, 2))


def fit(fitted: DataFrame, width: int, components: int = 16) -> Whitening:
    """The components of the rows of ``fitted``, whose one column holds arrays of ``width`` longs."""
    n, sums = _counted(fitted, width)
    model = Whitening(n, sums)
    if n < 2:
        return model
    factors: list[np.ndarray] = []
    upper, varying = np.eye(width), np.arange(width)
    for turn in range(_PASSES):

        def gram_of(rows: np.ndarray, factors=tuple(factors), varying=varying) -> np.ndarray:
            solved = _solved(model.centred(rows)[:, varying], list(factors))
            return solved.T @ solved

        gram = _passed(fitted, width, gram_of, len(varying))
        gram = (gram + gram.T) / 2
        if turn == 0:
            varying = np.flatnonzero(np.diag(gram) > 0)
            if not len(varying):
                return model
            gram, upper = gram[np.ix_(varying, varying)], np.eye(len(varying))
        if turn and np.abs(gram - np.eye(len(gram))).max() < len(gram) * _ORTHONORMAL:
            break
        # The first pass, and one behind which a direction is still far from unit length, is shifted.
        step = _factor(gram, shifted=turn == 0 or np.linalg.eigvalsh(gram)[0] < 0.5)
        factors.append(step)
        upper = step @ upper
    # What the last pass has measured is a factor too.
    values, turned = np.linalg.eigh(gram)
    upper = (turned * np.sqrt(np.maximum(values, 0))) @ turned.T @ upper
    _, deviations, right = np.linalg.svd(upper)
    real = deviations > len(upper) * _EPSILON * deviations[0]
    every = deviations**2 / n
    chosen = np.flatnonzero(real)[:components]
    model.eigenvalues, model.explained = every[chosen], every[chosen] / every.sum()
    model.vectors = np.zeros((width, len(chosen)))
    model.vectors[varying] = right[chosen].T

    def covered(rows: np.ndarray) -> np.ndarray:
        """Products of the whitened rows, and their sums in a last row and column."""
        values = np.hstack([model.whitened(rows), np.ones((len(rows), 1))])
        return values.T @ values

    products = _passed(fitted, width, covered, len(chosen) + 1)
    means = products[-1, :-1] / n
    model.identity_error = float(np.abs(products[:-1, :-1] / n - np.outer(means, means) - np.eye(len(chosen))).max())
    return model


RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row for each row of ``embeddings`` (vec_id, embedding) that is not dropped and each component: vec_id, component,
    n (vectors fitted), deviation (sum over dimensions of (n * x - sum)^2, exact; null beyond a long), whitened, explained (share of the
    variance), identity_error (of the whitened vectors' covariance).  Components are those of the distinct vectors."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding"), scale, shift).alias("x"))
    rows = rows.where(F.col("x").isNotNull())
    lengths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    width = lengths[0]["width"] if lengths else 0
    alike = rows.where(F.size("x") == width)
    fitted = materialize(alike.select("x").distinct(), "distinct-vectors")
    model = fit(fitted, width, components)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                yield _rows(batch.slice(a, _ROWS), model)

    result = alike.mapInArrow(told, RESULT)
    others = rows.where(F.size("x") != width)
    empty = (F.lit(None).cast(t).alias(c) for c, t in (f.split(" ") for f in RESULT.split(", ")[1:]))
    return result.unionByName(others.select("vec_id", *empty))


def _rows(batch: pa.RecordBatch, model: Whitening) -> pa.RecordBatch:
    x = _matrix(batch.column(1), model.width)
    size, k = len(x), len(model.eigenvalues)
    each = model.deviations(x)
    if each.dtype != object and len(x) and model.width * (int(np.abs(each.astype(np.float64)).max()) + 1) ** 2 >= _EXACT:
        each = each.astype(object)
    deviation = [v if v < 1 << 63 else None for v in (each * each).sum(axis=1).tolist()]
    repeat = max(1, k)
    at = np.repeat(np.arange(size), repeat)
    if k:
        own = [
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
            pa.array(model.whitened(x).reshape(-1)),
            pa.array(np.tile(model.explained, size)),
        ]
    else:
        own = [pa.nulls(size, pa.int32()), pa.nulls(size, pa.float64()), pa.nulls(size, pa.float64())]
    columns = [
        batch.column(0).take(pa.array(at)),
        own[0],
        pa.array(np.full(len(at), model.n, np.int64)),
        pa.array(deviation, pa.int64()).take(pa.array(at)),
        own[1],
        own[2],
        pa.array(np.full(len(at), model.identity_error)),
    ]
    return pa.record_batch(columns, names=[f.split(" ")[0] for f in RESULT.split(", ")])
