"""Whitening directions of embeddings, by a bidiagonal qd solver.

Vectors are put on a grid (``floor(SCALE * entry)``), and the different ones are the fit
list. Their number and sums are exact integers, so rows are centred before anything is
multiplied. Blockwise QR turns the centred rows into one triangle R: each task folds its
rows into a triangle block by block, and triangles are folded into fewer ones until one is
left. No product of the rows is ever formed, so small singular values keep their digits.

On R, of the vectors' dimension, Householder reflections from both sides give a bidiagonal
matrix; dqds (the differential quotient-difference algorithm with shifts) finds its
singular values to high relative accuracy; for each of the highest a twisted
factorisation, from the stationary transform of the top and the progressive one of the
bottom and twisted where they meet best, gives the singular vector without iteration.
Vectors of values that lie close together are made orthogonal, and a small Rayleigh-Ritz
step turns them into their best combinations. The reflections from the right lead back to
directions of the embeddings, whose signs make the largest entry positive.

Defined results: vectors that are null or hold a null or an entry that is not finite are
left out; vectors shorter than the longest are taken to end in zeros; a direction without
variance (none, or rounding only) is no component, so constant or empty tables give no
row; null and repeated ids are ids; ``deviation`` is null beyond the range of a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from purchaseflow.sources.scratch import staged

SCALE = 256
COMPONENTS = 4
BLOCK = 4096  # rows that a QR step takes
FAN = 16  # triangles that one task folds into one
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``count`` vectors, their exact ``sums``, and per component a unit
    direction (a column of ``directions``) with its variance."""

    count: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    total: float  # variance over all dimensions

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows on the grid less the mean, rounded once."""
        exact = _exact(x, self.count, self.sums)
        if exact is not None:
            return exact / self.count
        return x.astype(float) - np.array([s / self.count for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row: sum over dimensions of (count * x - sum) squared."""
        exact = _exact(x, self.count, self.sums)
        if exact is not None and x.shape[1] * int(np.abs(exact).max(initial=0)) ** 2 < 1 << 63:
            return (exact * exact).sum(axis=1).tolist()
        rows = (sum((self.count * v - s) ** 2 for v, s in zip(r, self.sums)) for r in x.tolist())
        return [n if n < 1 << 63 else None for n in rows]


def _exact(x: np.ndarray, count: int, sums: tuple[int, ...]) -> np.ndarray | None:
    """``count * x - sums`` in 64 bits, or None where these could overflow."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    widest = max(map(abs, (low, high, *sums)))
    if (max(abs(low), abs(high)) * count + widest) >> 62:
        return None
    return x * np.int64(count) - np.array(sums, dtype=np.int64)


def on_grid(df: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """``vec_id`` and ``x`` (longs) of the vectors that count, and their dimension."""

    def finite(c: Column) -> Column:
        value = c.cast("double")
        return c.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))

    kept = df.filter(F.col(vector).isNotNull() & F.forall(vector, finite))
    sizes = kept.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    if sizes[0] != sizes[1]:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(sizes[1]) - F.size(x)))
    return kept.select(F.col(vec_id).alias("vec_id"), x.alias("x")), sizes[1] or 0


def _rows(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, width)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, square."""
    r = np.linalg.qr(rows, mode="r")
    if r.shape[0] < r.shape[1]:
        r = np.vstack([r, np.zeros((r.shape[1] - r.shape[0], r.shape[1]))])
    return r


def _sums(fit: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """Number of the vectors and their sums by dimension, exact."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = _rows(batch, "x", width)
            count += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        dims = np.arange(-1, width)
        yield pa.RecordBatch.from_pydict(
            {"dim": dims, "high": np.append([0], high), "low": np.append([count], low)}
        )

    parts = fit.mapInArrow(added, "dim long, high long, low long")
    big = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = {r["dim"]: (int(r["high"]) << 32) + int(r["low"]) for r in parts.groupBy("dim").agg(*big).collect()}
    return found[-1], tuple(found[i] for i in range(width))


def _folded(fit: DataFrame, width: int, count: int, sums: tuple[int, ...]) -> np.ndarray:
    """R of the centred vectors, by blockwise QR in tasks and a tree over their triangles."""
    plain = Whitening(count, sums, np.zeros((width, 0)), np.zeros(0), 0.0)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            rows = _rows(batch, "x", width)
            for at in range(0, len(rows), BLOCK):
                block = plain.centred(rows[at : at + BLOCK])
                r = _triangle(block if r is None else np.vstack([r, block]))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"r": [r.tobytes()]})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for one in batch.column(0):
                own = np.frombuffer(one.as_py()).reshape(width, width)
                r = own if r is None else _triangle(np.vstack([r, own]))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"r": [np.ascontiguousarray(r).tobytes()]})

    triangles = staged(fit.mapInArrow(reduced, "r binary"), "triangles")
    left = triangles.count()
    while left > 1:
        left = -(-left // FAN)
        triangles = triangles.repartition(left).mapInArrow(merged, "r binary")
    return np.frombuffer(triangles.first()["r"]).reshape(width, width)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B in r = U B V^T, and V, by Householder reflections."""
    a, n = np.array(r, dtype=float), r.shape[0]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        top = np.abs(x).max(initial=0)
        if not top or not np.abs(x[1:]).max(initial=0):
            return None
        u = x / top
        u[0] += math.copysign(np.sqrt(u @ u), u[0])
        return u / np.sqrt(u @ u)

    for k in range(n):
        u = reflector(a[k:, k])
        if u is not None:
            a[k:, k:] -= np.outer(2 * u, u @ a[k:, k:])
        if k < n - 2:
            u = reflector(a[k, k + 1 :])
            if u is not None:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ u, 2 * u)
                v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ u, 2 * u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling.

    Each sweep turns the squares q and e into those of a matrix whose values are less by
    the shift; a shift that was too large shows in a negative q and is tried again
    smaller. A value is found when the last e is negligible; matrices fall apart where
    an inner e is.
    """
    found: list[float] = []
    parts = [(np.square(diagonal).tolist(), np.square(above).tolist(), 0.0)]
    tiny = _EPS * _EPS
    while parts:
        q, e, total = parts.pop()
        sweeps = 0
        while q:
            n = len(q)
            if n == 1:
                found.append(q.pop() + total)
                continue
            if e[-1] <= tiny * (total + q[-1]) or e[-1] <= tiny * q[-2] * _EPS:
                found.append(q.pop() + total)
                e.pop()
                continue
            if n == 2:
                # both values of [[q1, .], [., q2]] without cancellation
                a, b, c = q[0] + q[1] + e[0], q[0] * q[1], (q[0] - q[1] + e[0])
                root = math.sqrt(c * c + 4 * q[1] * e[0])
                high = (a + root) / 2
                found += [high + total, b / high + total if high else total]
                q.clear()
                continue
            cut = next((i for i in range(n - 2) if e[i] <= tiny * (total + min(q[i], q[i + 1]))), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], total))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            sweeps += 1
            if q[0] < q[-1] and sweeps % 7 == 1:  # its transpose read from the other end
                q, e = q[::-1], e[::-1]
            shift = _lower_bound(q, e) if sweeps > 1 else 0.0
            while True:
                step = _sweep(q, e, shift)
                if step is not None:
                    break
                shift = shift / 4 if shift > tiny * (total + q[-1]) else 0.0
            q, e = step
            total += shift
    return np.sort(np.maximum(found, 0.0))[::-1]


def _lower_bound(q: list[float], e: list[float]) -> float:
    """A shift near the smallest value, from the end of the matrix (Rayleigh and Gershgorin)."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), e[-2] if len(e) > 1 else 0.0, q[-1]
    # the smaller value of the last two by two block of B B^T
    top, low, off = q[-2] + e[-1], c, math.sqrt(max(0.0, c * e[-1]))
    gap = math.hypot((top - low) / 2, off)
    guess = max(0.0, (top + low) / 2 - gap)
    return guess * (1 - 1e-3) if a and b < a else 0.25 * guess


def _sweep(q: list[float], e: list[float], shift: float):
    """One dqds transform, or None if the shift was beyond the smallest value."""
    d = q[0] - shift
    new_q, new_e = [], []
    if d < 0:
        return None
    for i in range(len(e)):
        top = d + e[i]
        if top <= 0:
            ratio = 0.0 if not q[i + 1] else 1.0
            d = q[i + 1] - shift if not top else -1.0
            new_e.append(0.0)
        else:
            ratio = q[i + 1] / top
            new_e.append(e[i] * ratio)
            d = d * ratio - shift
        if d < 0:
            return None
        new_q.append(top)
    return [*new_q, d], new_e


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> list[np.ndarray]:
    """Vectors z with (B^T B - value) z as near zero as possible, the best twists first."""
    n = diagonal.size
    square, cross = np.square(diagonal), diagonal[:-1] * above
    between = np.square(above)
    least = _EPS * _EPS * (square.max(initial=0) + between.max(initial=0)) + 1e-300

    def safe(x: float) -> float:
        return x if abs(x) > least else math.copysign(least, x)

    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):  # stationary, from the top
        pivot = safe(s[i] + square[i])
        down[i] = cross[i] / pivot
        s[i + 1] = between[i] * (s[i] / pivot) - value
    p[-1] = square[-1] - value
    for i in range(n - 2, -1, -1):  # progressive, from the bottom
        pivot = safe(between[i] + p[i + 1])
        up[i] = cross[i] / pivot
        p[i] = p[i + 1] * (square[i] / pivot) - value
    meet = np.abs(s + p + value)
    found = []
    for r in np.argsort(meet, kind="stable")[: min(n, 8)]:
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(r, n - 1):
            z[i + 1] = -up[i] * z[i]
            if abs(z[i + 1]) > 1e100:
                z /= abs(z[i + 1])
        found.append(z / np.linalg.norm(z))
    return found


def directions(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest squared singular values of ``r`` and their right singular vectors."""
    top = np.abs(r).max(initial=0)
    if not top:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    a, b, v = bidiagonal(r / top)
    values = dqds(a, b)
    rank = int((values > values[0] * (_EPS * r.shape[0]) ** 2 * 16).sum())
    wanted = min(components, rank)
    # some more than wanted, so that a group of close values is not torn apart
    tried = min(rank, components + 4)
    basis = np.zeros((r.shape[0], 0))
    for value in values[:tried]:
        for z in twisted(a, b, value):
            for _ in range(2):
                z = z - basis @ (basis.T @ z)
            size = np.linalg.norm(z)
            if size > 1e-3:
                basis = np.hstack([basis, (z / size)[:, None]])
                break
    image = a[:, None] * basis
    image[:-1] += b[:, None] * basis[1:]
    turn = np.linalg.svd(image, full_matrices=False)[2].T
    vectors = (v @ (basis @ turn))[:, :wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[: vectors.shape[1]] * top * top, vectors * signs


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """What whitens the different rows of ``x``, and these rows as a written table."""
    different = staged(vectors.select("x").distinct(), "vectors")
    count, sums = _sums(different, width)
    r = _folded(different, width, count, sums)
    squares, found = directions(r, components)
    total = float(np.square(r).sum()) / count
    return Whitening(count, sums, found, squares / count, total), different


def identity_error(model: Whitening, different: DataFrame) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    width, k = len(model.sums), model.variances.size

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            w = model.whitened(_rows(batch, "x", width))
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_pydict({"place": np.arange(total.size), "value": total})

    parts = different.mapInArrow(added, "place long, value double")
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(k + k * k)
    for row in rows:
        total[row["place"]] = row["value"] / model.count
    mean, square = total[:k], total[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def whiten(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """One row per vector that counts and component.

    vec_id, component (from 1), n, deviation, whitened, explained, identity_error.
    """
    vectors, width = on_grid(df, vec_id, vector)
    shape = T.StructType(
        [
            vectors.schema["vec_id"],
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if not width:
        return df.sparkSession.createDataFrame([], shape)
    model, different = fit(vectors, width, components)
    error, k = identity_error(model, different), model.variances.size
    explained = model.variances / model.total if k else model.variances

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, "x", width)
            n = len(x)
            which = pa.array(np.repeat(np.arange(n), k))
            far = pa.array(model.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(which),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, model.count)),
                    far.take(which),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, n)),
                    pa.array(np.full(n * k, error)),
                ],
                names=shape.names,
            )

    return vectors.mapInArrow(projected, shape)
