"""Whitening of vectors by shifted CholeskyQR.

The entries of a vector become whole numbers, so sums, means and deviations are exact. The rows less their mean are a matrix A with
very many rows and few columns. Spark adds up its Gram matrix, block by block; the Cholesky factor of it, with a small
multiple of the unit matrix added so that it exists whatever the rounding, is a first triangular R1, and the rows of A / R1, made by
triangular solves where the rows lie, are nearly orthogonal. The pass is repeated on these rows, without the shift, and the
factors are composed: R = R3 R2 R1, with A = Q R. The singular values and right vectors of the small R are those of A, found
without ever forming what squares its condition.

The driver holds sums and matrices of the width of a vector, never rows. Entries of a Gram matrix are added in Spark, one partial
matrix for each task. A pass reads the vectors once; the passes are one for the exact sums, three for the factors, one for the check of
the result. Float sums depend on the order of tasks in their last digits; the factors are made once and are the same for all rows.

Defined results: rows whose vector is NULL, has a NULL or an entry that is not finite, whose entry times ``SCALE`` is not below
2^53 and so not exact, or is of another length than most (the longer of equally frequent ones) are left out; empty vectors
are none. Components without variance (below ``NOTHING`` of the greatest deviation) do not exist, so equal rows alone have none. Repeated
rows and ids count each; a deviation beyond a long is NULL; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import ship

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows whose products are added up at once; the shift of the first factor allows for their rounding.
BLOCK = 4096
#: Passes of factors after the shifted one.
REPEATS = 2
#: A component is left out if its standard deviation is below this part of the greatest.
NOTHING = 1e-9
_EXACT = 1 << 62


def usable(vectors: DataFrame, vector: str, width: int | None = None) -> DataFrame:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | ~(F.abs(c) < F.lit(2.0**53 / SCALE)))
    rows = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)))
    return rows if width is None else rows.where(F.size(vector) == width)


def whole_numbers(entries: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * entries.astype(np.float64)).astype(np.int64) + OFFSET


def _blocks(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of a batch as rows of whole numbers, with the place of the first."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    for a in range(0, len(column), BLOCK):
        yield a, whole_numbers(flat[a : a + BLOCK])


def deviations(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """``n x - S``, exact: in Python's integers where 64 bits may not do."""
    most = max(int(np.abs(x).max(initial=0)) * n, max((abs(s) for s in sums), default=0))
    if most < _EXACT // 2:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(d: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, exact; None beyond a long."""
    most = int(np.abs(d).max(initial=0))
    if d.dtype != object and most * most * max(1, d.shape[1]) < _EXACT:
        return (d * d).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in d]
    return [v if v < 1 << 63 else None for v in exact]


def solve_right(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows / r`` for an upper triangular r, column by column."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def factor(gram: np.ndarray, shifted: bool) -> np.ndarray:
    """The upper triangular R with R'R = ``gram``; the shift grows until there is one."""
    d = len(gram)
    unit = np.finfo(float).eps / 2
    step = 11 * (d * BLOCK + d * (d + 1)) * unit * max(np.trace(gram), np.finfo(float).tiny)
    shift = step if shifted else 0.0
    while True:
        try:
            r = np.linalg.cholesky(gram + shift * np.eye(d)).T
            if np.isfinite(r).all() and r.diagonal().min() > 0:
                return r
        except np.linalg.LinAlgError:
            pass
        shift = max(step, 100 * shift)


@dataclass(frozen=True)
class Whitening:
    """``axes`` are the unit components as rows, by falling variance; ``variances`` theirs, ``trace`` that of all."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``n x - S`` and ``x - S / n``."""
        d = deviations(x, self.n, self.sums)
        return d, (d / self.n).astype(np.float64)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.axes.T / np.sqrt(self.variances)


def _sums(rows: DataFrame, vector: str, width: int) -> tuple[int, tuple[int, ...]]:
    """How many rows there are, and the exact sum of each entry."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * width, 0
        for batch in batches:
            for _, x in _blocks(batch.column(0), width):
                # In two parts, whose sums over a block fit 64 bits.
                high, low = (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)
                total = [t + (int(h) << 26) + int(v) for t, h, v in zip(total, high, low, strict=True)]
                n += len(x)
        if n:
            values = pa.array([str(v) for v in total])
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), values, pa.array([n] * width, pa.int64())], names=["i", "s", "n"])

    found = rows.select(vector).mapInArrow(partial, "i int, s string, n bigint")
    added = found.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    by = {r.i: r for r in added}
    return (by[0].n, tuple(int(by[i].s) for i in range(width))) if by else (0, ())


def _gram(rows: DataFrame, vector: str, width: int, of: int, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of y'y, and below it the sum of y, over the rows y = ``make(x)`` of length ``of``; one matrix from each task."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((of + 1, of))
        for batch in batches:
            for _, x in _blocks(batch.column(0), width):
                y = make(x)
                total[:of] += y.T @ y
                total[of] += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int64()), pa.array(total.ravel())], names=["i", "v"])

    parts = rows.select(vector).mapInArrow(partial, "i bigint, v double")
    out = np.zeros((of + 1) * of)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v
    return out.reshape(of + 1, of)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The whitening fitted to all usable rows, and these rows; None if there are none."""
    ship(vectors.sparkSession)
    fine = usable(vectors, vector)
    common = fine.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return None, fine
    width = common.width
    rows = usable(vectors, vector, width)
    n, sums = _sums(rows, vector, width)
    plain = Whitening(n, sums, np.zeros((0, width)), np.zeros(0), 0.0)
    factors: list[np.ndarray] = []

    def orthogonal(x: np.ndarray) -> np.ndarray:
        y = plain.centred(x)[1]
        for r in factors:
            y = solve_right(y, r)
        return y

    trace = 0.0
    whole = np.eye(width)
    for k in range(1 + REPEATS):
        gram = _gram(rows, vector, width, width, orthogonal)[:width]
        if k == 0:
            trace = float(np.trace(gram)) / n
            if trace == 0:
                return plain, rows
        r = factor(gram, shifted=k == 0)
        factors.append(r)
        whole = r @ whole
    _, singular, axes = np.linalg.svd(whole)
    there = singular > NOTHING * singular[0]
    singular, axes = singular[there][:components], axes[there][:components]
    sign = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
    return Whitening(n, sums, axes * sign[:, None], singular**2 / n, trace), rows


def identity_error(w: Whitening, rows: DataFrame, vector: str) -> float:
    """The greatest entry of the whitened rows' covariance less the unit matrix, measured on all rows."""
    k = len(w.axes)
    total = _gram(rows, vector, w.width, k, lambda x: w.project(w.centred(x)[1]))
    mean = total[k] / w.n
    return float(np.abs(total[:k] / w.n - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: ``(vec_id, component, n, deviation, whitened, explained, identity_error)``."""
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    w, rows = fit(vectors, vector, components)
    if w is None or not len(w.axes):
        return vectors.sparkSession.createDataFrame([], schema)
    error, explained, k = identity_error(w, rows, vector), w.variances / w.trace, len(w.axes)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, x in _blocks(batch.column(1), w.width):
                d, centred = w.centred(x)
                m = len(x)
                ids = batch.column(0).slice(a, m).take(pa.array(np.repeat(np.arange(m), k)))
                deviation = pa.array(squares(d), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)), deviation,
                        pa.array(w.project(centred).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select(id_column, vector).mapInArrow(apply, schema)
