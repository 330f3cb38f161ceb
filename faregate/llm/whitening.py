"""Embedding whitening by eigenvectors that start in float32 and are refined to double precision.

Every entry c becomes the whole number x = floor(64 * c) + 1000000. The fit list is
each distinct vector of x once; copies collapse in the tasks that read them, and
the list is written once.

1. Whole-number sums S over the list, and its count n, are exact.
2. Each task of the list centres its vectors and multiplies: x - S/n is formed as
   (x - m) - (S - n*m)/n with the whole number m next to S/n, so that nothing of it
   is rounded away, and the products are added up in extended precision. A task
   gives one row per dimension; those are added up per dimension, so that what
   reaches the driver is one d x d matrix, whatever the number of rows.
3. The driver takes eigenvectors of that matrix in float32 and corrects them by
   Ogita-Aishima iterations (``refine``): residuals of orthogonality and of
   diagonality, by matrix products in extended precision, give a correction of all
   vectors at once that squares their error. Where eigenvalues lie too close for the
   correction's quotient, the vectors of such a cluster are only made orthogonal, and
   then rotated by the eigenvectors of the small matrix they project onto, shifted by
   the cluster's centre.
4. Tasks project rows on the components; ``identity_error`` is measured by a pass of
   its own over the fit list, with the projections as they are returned.

Components are numbered from 1 by falling eigenvalue. Their entry of largest absolute
value is positive. Components without variance (an eigenvalue of at most 1e-13 of the
trace) are left out, as nothing can be divided by their root: a list of one vector has none.

A vector that is null, empty or holds a null or non-finite entry drops out, and so does
one with an entry of 2**45 or more (x then has no exact products). All vectors need one
length; other tables are refused by name of the lengths. Repeated rows and ids are
returned as often as they come. An empty table gives no rows. Further columns are not
read. ``deviation`` is exact; where it does not fit a long, it is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate.llm.common import field_ddl
from faregate.operators.layout import written

SCALE, SHIFT = 64, 1_000_000  # fixed values of the contract
LARGEST = float(1 << 45)
COMPONENTS = 16
NO_VARIANCE = 1e-13
ROWS_AT_ONCE = 4096
WIDE = np.longdouble  # 64 bits of fraction on common machines, never fewer than double


@dataclass(frozen=True)
class Fit:
    """What tasks need: bounded by the number of dimensions."""

    n: int
    sums: list[int]
    values: np.ndarray  # all eigenvalues, falling
    vectors: np.ndarray  # columns
    trace: float
    kept: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors[:, : self.kept] / np.sqrt(self.values[: self.kept])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n as doubles, each rounded once."""
    middle = [round(s / n) if abs(s) < 1 << 52 else s // n for s in sums]
    rest = np.array([(s - n * m) / n for s, m in zip(sums, middle)])
    return (x - np.array(middle, dtype=np.int64)).astype(np.float64) - rest


def whole_numbers(embedding: Column) -> Column:
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT)


def usable(embedding: Column) -> Column:
    fine = F.forall(embedding, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST), F.lit(False)))
    return F.coalesce((F.size(embedding) > 0) & fine, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield _matrix(batch.column("x").slice(at, ROWS_AT_ONCE), width)


def _gram(width: int, made, size: int):
    """Per task the sums and products of what ``made`` makes of its vectors: a row ``i, values`` per dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1), dtype=WIDE)
        seen = False
        for x in _blocks(batches, width):
            y = made(x)
            total[:, :size] += y.T @ y
            total[:, size] += y.sum(axis=0)
            seen = True
        if seen:
            yield _rows(dict(enumerate(total)))

    return task


def _rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Extended numbers leave as two doubles that add up to them."""
    high = [v.astype(np.float64) for v in sums.values()]
    low = [(v - h).astype(np.float64) for v, h in zip(sums.values(), high)]
    kind = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(high, kind), pa.array(low, kind)], ["i", "high", "low"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, high, low in zip(batch.column("i").to_pylist(), batch.column("high"), batch.column("low")):
            value = np.asarray(high.values).astype(WIDE) + np.asarray(low.values)
            sums[i] = sums[i] + value if i in sums else value
    if sums:
        yield _rows(sums)


def covariance(fit_list: DataFrame, width: int, n: int, made, size: int) -> np.ndarray:
    """Covariance, divisor n, of what ``made`` makes of each vector of the list."""
    ddl = "i int, high array<double>, low array<double>"
    parts = fit_list.select("x").mapInArrow(_gram(width, made, size), ddl)
    rows = parts.repartition(size, "i").mapInArrow(_added, ddl).collect()  # one row per dimension
    out = np.zeros((size, size + 1), dtype=WIDE)
    for r in rows:
        out[r["i"]] = np.array(r["high"], dtype=WIDE) + np.array(r["low"])
    mean = out[:, size] / n
    products = out[:, :size] / n - np.outer(mean, mean)  # the mean is 0 but for rounding
    return (products + products.T) / 2


def clusters(values: np.ndarray, least: float) -> list[np.ndarray]:
    """Places of falling values, a new list wherever the next lies more than ``least`` below."""
    cuts = np.flatnonzero(-np.diff(values) > least) + 1
    return np.split(np.arange(len(values)), cuts)


def refine(matrix: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix, from a float32 start."""
    size = len(matrix)
    scale = np.abs(matrix).max() if size else 0
    if not scale:
        return np.zeros(size), np.eye(size)
    a = matrix.astype(WIDE) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(WIDE)
    one = np.eye(size, dtype=WIDE)
    before = np.inf
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # a skewed rounding error would be divided by small gaps
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        norm = np.abs(values).max()
        off = np.linalg.norm((s - np.diag(values)).astype(np.float64)) + norm * np.linalg.norm(r.astype(np.float64))
        groups = clusters(values, 2 * off)
        group = np.empty(size, dtype=np.int64)
        for k, members in enumerate(groups):
            group[members] = k
        close = group[:, None] == group[None, :]
        gap = np.where(close, 1, values[None, :] - values[:, None])
        change = np.where(close, r / 2, (s + values[None, :] * r) / gap)
        x = x + x @ change
        turned = WIDE(0)
        for members in groups:
            if len(members) > 1:
                own = x[:, members]
                centre = values[members].mean()
                small = own.T @ (a @ own - centre * own)
                small = (small + small.T) / 2
                width = np.abs(small).max()
                if width:
                    turn = np.linalg.eigh((small / width).astype(np.float64))[1][:, ::-1].astype(WIDE)
                    x[:, members] = own @ turn
                    loose = small - np.diag(np.diag(small))
                    turned = max(turned, np.abs(loose).max())
        error = max(np.abs(np.where(close & ~np.eye(size, dtype=bool), r, change)).max(), turned)
        if error >= before / 2 and error < 1e-12 or error == 0:
            break
        before = error
    x = x + x @ (one - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(size)])
    return (values[order] * scale).astype(np.float64), (x * sign).astype(np.float64)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over the dimensions of (n*x - S)**2, exact."""
    # n*(x - m) - (S - n*m): small numbers, whatever the shift
    middle = [s // n for s in sums]
    rest = np.array([s - n * m for s, m in zip(sums, middle)], dtype=object)
    near = (x - np.array(middle, dtype=np.int64)).astype(np.float64)
    rough = np.square(near * n - np.array([float(r) for r in rest])).sum(axis=1)
    if (rough < 2.0**62).all():
        part = (x - np.array(middle, dtype=np.int64)) * n - rest.astype(np.int64)
        return pa.array(np.square(part).sum(axis=1), pa.int64())
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _project(fit: Fit, error: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, k = len(fit.sums), fit.kept
        explained = fit.values[:k] / fit.trace
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                x = _matrix(part.column("x"), width)
                own = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(own),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, fit.n, dtype=np.int64)),
                        _deviations(x, fit.n, fit.sums).take(own),
                        pa.array(fit.whitened(x).ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(x) * k, error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return task


def fit_whitening(fit_list: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The components of a written list of distinct vectors ``x``; None if it is empty."""
    lengths = fit_list.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if lengths["least"] is None:
        return None
    if lengths["least"] != lengths["most"]:
        raise ValueError(f"vectors of {lengths['least']} to {lengths['most']} entries in one table")
    width = lengths["most"]
    total = F.sum(F.col("value").cast("decimal(38,0)"))
    rows = fit_list.select(F.posexplode("x").alias("i", "value")).groupBy("i").agg(total.alias("s"), F.count(F.lit(1)).alias("n")).collect()
    n, sums = rows[0]["n"], [int(r["s"]) for r in sorted(rows, key=lambda r: r["i"])]
    wide = covariance(fit_list, width, n, lambda x: centred(x, n, sums), width)
    values, vectors = refine(wide)
    trace = float(np.trace(wide))
    kept = min(components, int((values > NO_VARIANCE * trace).sum()))
    return Fit(n, sums, values, vectors, trace, kept)


def whiten(docs: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` per usable row and component."""
    vector = F.col(f"`{embedding}`")
    rows = docs.where(usable(vector)).select(F.col(f"`{vec_id}`").alias("id"), whole_numbers(vector).alias("x"))
    ddl = (
        f"{field_ddl(rows, 'id')}, component int, n bigint, deviation bigint, "
        "whitened double, explained double, identity_error double"
    )
    fit_list = written(rows.select("x").distinct())
    fit = fit_whitening(fit_list, components)
    if fit is None or not fit.kept:
        return docs.sparkSession.createDataFrame([], ddl)
    measured = covariance(fit_list, len(fit.sums), fit.n, fit.whitened, fit.kept)
    error = float(np.abs(measured - np.eye(fit.kept)).max())
    return rows.mapInArrow(_project(fit, error), ddl)
