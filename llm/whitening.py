"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers (`1024 * c` rounded down, plus an offset). Each task keeps a mean and the spectrum of the
scatter about it, and takes vectors in one by one: a new vector moves the mean and adds one centred rank-one term, whose
effect on the eigenvalues are the roots of a secular equation. Terms that don't touch an eigenvector, or that touch several of
one eigenvalue, are deflated first; the eigenvectors follow from the roots and from a rank-one term recomputed from
them, which keeps them orthogonal. Equal vectors of a batch are one term with their number as its weight. The tasks' spectra
meet in groups of a few, each eigenpair of one being a rank-one update of the other, and one more for the means, until one is
left. A last distributed Rayleigh-Ritz pass forms the covariance of all vectors in that basis, about the exact mean,
and its eigenvectors correct what rounding has left.

A task's and a group's data are a few matrices of the dimension's square; the driver gets one. Sums, their squares and the number of
rows are exact, whatever their size.

Rows without a vector, with a null or an entry that isn't finite, or beyond 2**40 in size, take no part; nor do empty
vectors and those of another length than most rows have (the least length of equally frequent ones). Repeated rows and
equal ids count each, null ids too. Components without variance (at most 1e-13 of the largest eigenvalue for each
dimension) have a null `whitened`; with no variance at all `explained` is null. Where `deviation` doesn't fit
a long it is null, and `deviation_exact` has it. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from llm.tables import stage

_EPS = np.finfo(float).eps
_LIMIT = float(1 << 40)
_SPECTRUM = "part long, n long, mean array<double>, values array<double>, vectors array<double>"
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


@dataclass(frozen=True)
class Whitening:
    """components: of each row, at most; scale and shift: an entry c becomes floor(scale * c) + shift; together: spectra that
    are put together at once."""

    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    together: int = 8


def secular_roots(values: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho * sum(z**2 / (values - x)), one above each value, as differences to the nearest value.

    `values` rise strictly, no z is 0 and rho is positive. Returns for each root the place of the value that it is measured from, and
    the difference. Each step fits a constant and the poles on both sides of a root; a bracket guards it.
    """
    n, squares = len(values), rho * z * z
    if n == 1:
        return np.zeros(1, dtype=int), squares
    width = np.append(np.diff(values), squares.sum())
    places = np.arange(n)
    middle = np.ones(n)
    for i in range(0, n, 512):  # which end of its interval each root is nearer to
        at = places[i : i + 512]
        gaps = (values - values[at, None]) - width[at, None] / 2
        middle[at] = 1 + (squares / gaps).sum(axis=1)
    right = (middle < 0) & (places < n - 1)
    origin = places + right
    low, high = np.where(right, -width / 2, 0.0), np.where(right, 0.0, width)
    low, high = np.where(~right & (middle < 0), width / 2, low), np.where(~right & (middle >= 0), width / 2, high)
    root = (low + high) / 2
    delta = values - values[origin][:, None]
    lower, upper = np.minimum(places, n - 2), np.minimum(places + 1, n - 1)  # the last root has both poles below it
    below = places <= lower[:, None]
    active = places
    for _ in range(100):
        gap = delta[active] - root[active, None]
        terms = squares / gap
        slopes = terms / gap
        f = 1 + terms.sum(axis=1)
        done = np.abs(f) <= 4 * _EPS * (1 + np.abs(terms).sum(axis=1))
        over = f > 0
        high[active] = np.where(over, root[active], high[active])
        low[active] = np.where(over, low[active], root[active])
        done |= high[active] - low[active] <= 2 * _EPS * np.maximum(np.abs(high[active]), np.abs(low[active]))
        keep = ~done
        if not keep.any():
            break
        active, gap, slopes, f = active[keep], gap[keep], slopes[keep], f[keep]
        rows = np.arange(len(active))
        first, second = gap[rows, lower[active]], gap[rows, upper[active]]
        under = (slopes * below[active]).sum(axis=1)
        above = slopes.sum(axis=1) - under
        c = f - first * under - second * above
        a = (first + second) * f - first * second * (under + above)
        b = first * second * f
        with np.errstate(all="ignore"):
            square = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            inner = np.where(a <= 0, (a - square) / (2 * c), 2 * b / (a + square))
            outer = np.where(a >= 0, (a + square) / (2 * c), 2 * b / (a - square))
            step = np.where(active < n - 1, inner, outer)
        following = root[active] + step
        moving = ~(np.abs(step) <= 2 * _EPS * np.abs(root[active]))
        inside = (following > low[active]) & (following < high[active])
        root[active] = np.where(inside | ~moving, following, (low[active] + high[active]) / 2)
        active = active[moving]
        if not len(active):
            break
    return origin, root


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of `vectors @ diag(values) @ vectors.T + rho * outer(v, v)`; rho >= 0."""
    z = vectors.T @ v
    size = float(z @ z)
    if rho * size <= 0:
        return values, vectors
    z, rho = z / np.sqrt(size), rho * size
    small = 8 * _EPS * max(abs(values[-1]), abs(values[0]), rho)
    copied = False
    kept = [i for i in range(len(z)) if rho * abs(z[i]) > small]
    live: list[int] = []
    for i in kept:
        j = live[-1] if live else -1
        if j >= 0:
            r = np.hypot(z[i], z[j])
            c, s = z[i] / r, z[j] / r
            if abs((values[i] - values[j]) * c * s) <= small:  # one eigenvalue: turn its two vectors until one is untouched
                if not copied:
                    values, vectors, copied = values.copy(), vectors.copy(), True
                a, b = vectors[:, j].copy(), vectors[:, i].copy()
                vectors[:, j], vectors[:, i] = c * a - s * b, s * a + c * b
                x, y = values[j], values[i]
                values[j], values[i] = c * c * x + s * s * y, s * s * x + c * c * y
                z[j], z[i] = 0.0, r
                live.pop()
        live.append(i)
    if not live:
        return values, vectors
    at = np.array(live)
    at = at[np.argsort(values[at], kind="stable")]
    d = values[at]
    if len(d) > 1:
        d = np.maximum.accumulate(d)
        flat = np.flatnonzero(np.diff(d) <= 0)
        for i in flat:  # rounding may leave two equal
            d[i + 1] = np.nextafter(d[i], np.inf)
    origin, root = secular_roots(d, z[at], rho)
    distance = (d[:, None] - d[origin][None, :]) - root[None, :]  # d[i] - root j
    # the rank-one term whose roots these are exactly, so that the vectors come out orthogonal
    n = len(d)
    spread = d[:, None] - d[None, :]
    np.fill_diagonal(spread, 1.0)
    ratio = np.ones((n, n))
    lower = np.tri(n, n, -1, dtype=bool)
    ratio[lower] = (distance / spread)[lower]  # j < i
    shifted = np.roll(spread, -1, axis=1)
    upper = np.triu(np.ones((n, n), dtype=bool))
    upper[:, -1] = False
    ratio[upper] = (distance / shifted)[upper]  # i <= j < n - 1
    ratio[:, -1] = -distance[:, -1]
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1)))
    turned = np.where(z[at] < 0, -exact, exact)[:, None] / distance
    turned /= np.sqrt((turned * turned).sum(axis=0))
    values, vectors = values.copy(), vectors.copy()
    values[at], vectors[:, at] = d[origin] + root, vectors[:, at] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Number, mean and scatter of vectors, the scatter as eigenvalues and eigenvectors."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray, weight: int = 1) -> None:
        """Takes in `weight` vectors equal to x."""
        total = self.n + weight
        away = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * weight / total)
        self.n, self.mean = total, self.mean + away * (weight / total)

    def merge(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        total = self.n + other.n
        if self.n and other.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, other.mean - self.mean, self.n * other.n / total)
        if total:
            self.mean = self.mean + (other.mean - self.mean) * (other.n / total)
        self.n = total

    def row(self, part: int) -> pa.RecordBatch:
        columns = [pa.array([part], pa.int64()), pa.array([self.n], pa.int64())]
        columns += [pa.array([x.tolist()], pa.list_(pa.float64())) for x in (self.mean, self.values, self.vectors.ravel())]
        return pa.RecordBatch.from_arrays(columns, names=["part", "n", "mean", "values", "vectors"])

    @staticmethod
    def of(row: dict) -> Spectrum:
        out = Spectrum(len(row["mean"]))
        out.n, out.mean, out.values = row["n"], np.array(row["mean"]), np.array(row["values"])
        out.vectors = np.array(row["vectors"]).reshape(len(out.mean), -1)
        return out


def whole_vectors(vectors: DataFrame, how: Whitening) -> DataFrame:
    """vec_id and x (whole numbers) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("c")).where("c is not null and size(c) > 0")
    rows = rows.where(F.forall("c", lambda x: F.coalesce(F.abs(x) <= _LIMIT, F.lit(False)) & ~F.isnan(x)))
    return rows.select("vec_id", F.transform("c", lambda x: F.floor(x * how.scale).cast("long") + how.shift).alias("x"))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column(batch.schema.names.index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of rows, and the exact sum in each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in batches:
            x = _matrix(batch, size)
            for start in range(0, len(x), 1 << 18):  # 2**18 entries of 2**51 fit
                total = [a + b for a, b in zip(total, x[start : start + (1 << 18)].sum(axis=0).tolist())]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([list(map(Decimal, total))], pa.list_(pa.decimal128(38, 0)))], names=["n", "total"])

    parts = rows.mapInArrow(run, "n long, total array<decimal(38,0)>")
    each = parts.select("n", F.posexplode("total")).groupBy("pos").agg(F.sum("n").alias("n"), F.sum("col").alias("total")).orderBy("pos").collect()
    return each[0].n, [int(r.total) for r in each]


def spectrum(rows: DataFrame, size: int, how: Whitening) -> Spectrum:
    """The spectrum of all rows: one of each task, put together in groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Spectrum(size)
        for batch in batches:
            x, counts = np.unique(_matrix(batch, size), axis=0, return_counts=True)
            for vector, weight in zip(x.astype(float), counts.tolist()):
                found.add(vector, weight)
        if found.n:
            yield found.row(TaskContext.get().partitionId())

    def together(table: pa.Table) -> pa.Table:
        first, *others = sorted(table.to_pylist(), key=lambda r: r["part"])
        found = Spectrum.of(first)
        for other in others:
            found.merge(Spectrum.of(other))
        return pa.Table.from_batches([found.row(first["part"])])

    parts = stage(rows.mapInArrow(run, _SPECTRUM), "spectra")
    numbered = parts.select("part").collect()  # a number for each task
    order = {r.part: i for i, r in enumerate(sorted(numbered))}
    while len(order) > 1:
        group = parts.sparkSession.createDataFrame([(part, i // how.together) for part, i in order.items()], "part long, team long")
        parts = stage(parts.join(F.broadcast(group), "part").groupBy("team").applyInArrow(lambda key, table: together(table.drop_columns(["team"])), _SPECTRUM), "spectra")
        order = {r.part: i for i, r in enumerate(sorted(parts.select("part").collect()))}
    return Spectrum.of(parts.first().asDict())


def ritz(rows: DataFrame, basis: np.ndarray, total: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors (columns) of the covariance, from a basis near to the vectors."""
    size = len(total)
    whole, rest = np.array([t // n for t in total]), np.array([t % n / n for t in total])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((size, size))
        for batch in batches:
            y = (_matrix(batch, size) - whole - rest) @ basis
            products += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([products.ravel().tolist()], pa.list_(pa.float64()))], names=["products"])

    parts = rows.mapInArrow(run, "products array<double>").select(F.posexplode("products"))
    each = parts.groupBy("pos").agg(F.sum("col").alias("v")).collect()  # the dimension's square
    products = np.zeros(size * size)
    products[[r.pos for r in each]] = [r.v for r in each]
    products = products.reshape(size, size) / n
    values, turned = np.linalg.eigh((products + products.T) / 2)
    vectors = basis @ turned[:, ::-1]
    largest = np.abs(vectors).argmax(axis=0)
    return values[::-1], vectors * np.where(vectors[largest, np.arange(size)] < 0, -1.0, 1.0)


def deviations(x: np.ndarray, total: list[int], n: int) -> list[int]:
    """sum((n * x - total)**2) of each row, exactly."""
    whole, rest = np.array([t // n for t in total]), [t % n for t in total]
    away = x - whole
    most = int(np.abs(away).max(initial=0)) + 1
    if max(most, 1 << 24, (n >> 24) + 1) * most * len(total) < 1 << 62:
        low, high = np.array([r & 0xFFFFFF for r in rest]), np.array([r >> 24 for r in rest])
        squares, lows, highs = (away * away).sum(axis=1), (away * low).sum(axis=1), (away * high).sum(axis=1)
        constant = sum(r * r for r in rest)
        return [n * n * a - 2 * n * ((c << 24) + b) + constant for a, b, c in zip(squares.tolist(), lows.tolist(), highs.tolist())]
    return [sum((n * v - r) ** 2 for v, r in zip(row, rest)) for row in away.tolist()]


def whiten(vectors: DataFrame, how: Whitening = Whitening()) -> DataFrame:
    """A row for each vector and component: vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened,
    explained, identity_error, deviation_exact. `vectors` has vec_id and embedding."""
    spark = vectors.sparkSession
    rows = stage(whole_vectors(vectors, how), "whole-vectors")
    width = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if width is None:
        return spark.createDataFrame([], SCHEMA)
    size = width.width
    rows = rows.where(F.size("x") == size)
    n, total = sums(rows, size)
    values, components = ritz(rows, spectrum(rows, size, how).vectors, total, n)
    most = min(how.components, size)
    trace = float(np.maximum(values, 0).sum())
    varied = [i for i in range(most) if values[i] > 1e-13 * size * values[0] and values[i] > 0]
    whole, rest = np.array([t // n for t in total]), np.array([t % n / n for t in total])
    scaled = components[:, varied] / np.sqrt(values[varied])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, size)
            w = (x - whole - rest) @ scaled
            exact = pa.array(map(Decimal, deviations(x, total, n)), pa.decimal128(38, 0))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(varied))
            yield pa.RecordBatch.from_arrays([batch.column(0), exact, pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))], names=["vec_id", "exact", "w"])

    found = stage(rows.select("vec_id", "x").mapInArrow(run, "vec_id long, exact decimal(38,0), w array<double>"), "whitened")
    pairs = [(i, j) for i in range(len(varied)) for j in range(i + 1)]
    error = None
    if pairs:
        covariances = found.agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))) for i, j in pairs]).first()
        error = max(abs(v - (i == j)) for v, (i, j) in zip(covariances, pairs))
    explained = F.array(*[F.lit(float(max(v, 0) / trace) if trace else None).cast("double") for v in values[:most]])
    component = F.explode(F.sequence(F.lit(1), F.lit(most))).alias("component")
    return found.select("vec_id", component, "exact", "w").select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        F.col("exact").try_cast("long").alias("deviation"),
        F.get("w", F.col("component") - 1).alias("whitened"),
        F.get(explained, F.col("component") - 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        F.col("exact").alias("deviation_exact"),
    )
