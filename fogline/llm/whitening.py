"""Whitening of embeddings through polarisation: covariances from variances of dimensions and of their pair sums.

Entries become integers x = floor(scale * entry). With n distinct vectors and sums S per dimension, the centred value of a
dimension is n x - S. For dimensions i, j the tasks add up the squares of the centred i, of the centred j and of the centred
sum i + j, and 2 cov(i, j) = var(i + j) - var(i) - var(j). No product of two dimensions is ever formed.

Sums are exact. With m = floor(S / n), y = x - m and r = S - n m, a centred value is n y - r, and as the y of a dimension add up
to r, its squares add up to n (n sum(y^2) - r^2). So tasks square the small numbers y (and y_i + y_j), and the rest of
the centring is done once per sum in unbounded integers. Only the last division rounds.

Scale: vectors travel as their narrowest integer bytes and are made distinct by a grouping that Spark combines before its shuffle,
so a vector that a third of all rows hold costs one row per task. The driver gets, per length of vectors, one number
per dimension and per pair of dimensions, whatever the number of rows, and keeps the matrix that ``eigh`` needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogline.session import cut_lineage

#: Vectors that a task works on at a time.
ROWS = 1024
#: Eigenvalues at or below this share of the largest count as zero.
FLAT = 1e-14


def quantise(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * entry) as longs; what lies beyond a long becomes the nearest one."""
    whole = np.floor(vectors.astype(np.float64) * scale)
    # The greatest double that a long can hold; what is beyond it is set apart.
    out = np.clip(whole, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    out[whole >= 2.0**63] = np.iinfo(np.int64).max
    return out


def usable(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) per length, for rows whose vector is whole and finite."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.float64)
    flat = column.flatten()
    values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    present = ~np.isnan(lengths)
    size = np.where(present, lengths, 0).astype(np.int64)
    starts = np.cumsum(size) - size
    for length in np.unique(size[present]).tolist():
        rows = np.flatnonzero(present & (size == length))
        matrix = values[starts[rows][:, None] + np.arange(length)]
        whole = np.isfinite(matrix).all(axis=1)
        yield rows[whole], matrix[whole]


def encode(x: np.ndarray) -> list[bytes]:
    """Rows of longs as bytes of their narrowest width, which the first byte names; equal rows give equal bytes."""
    if not x.shape[1]:
        return [b"\x01"] * len(x)
    top = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1))
    out: list[bytes] = [b""] * len(x)
    width = np.select([top < 1 << 7, top < 1 << 15, top < 1 << 31], [1, 2, 4], 8)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        head = bytes([w])
        for row, packed in zip(rows.tolist(), x[rows].astype(f"<i{w}")):
            out[row] = head + packed.tobytes()
    return out


def decode(codes: list[bytes]) -> Iterator[np.ndarray]:
    """Matrices of longs, one per length, from codes of one batch."""
    by_shape: dict[tuple[int, int], list[bytes]] = {}
    for code in codes:
        by_shape.setdefault((code[0], len(code)), []).append(code[1:])
    for (width, size), rows in by_shape.items():
        yield np.frombuffer(b"".join(rows), f"<i{width}").reshape(len(rows), (size - 1) // width).astype(np.int64)


def _exact(y: np.ndarray) -> np.ndarray:
    """``y`` in a type in which the squares of pair sums of all its rows add up without loss."""
    most = int(max(abs(int(y.max())), abs(int(y.min())))) if y.size else 0
    return y if len(y) * (2 * most) ** 2 < 2**63 else y.astype(object)


def square_sums(y: np.ndarray) -> np.ndarray:
    """Sums over rows of y_i^2 (on the diagonal) and (y_i + y_j)^2 (above it), as a flat upper triangle."""
    y = _exact(y)
    parts = []
    for i in range(y.shape[1]):
        together = y[:, i : i + 1] + y[:, i + 1 :]
        parts += [(y[:, i] * y[:, i]).sum(keepdims=True), (together * together).sum(axis=0)]
    return np.concatenate(parts).astype(object) if parts else np.zeros(0, object)


@dataclass(frozen=True)
class Whitening:
    """What the fit of one length of vectors found; ``axes`` has one column per component."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of rows of longs; a component without variance is 0."""
        # Centred before projecting: the whole part of the mean leaves integers, the rest is below 1.
        whole = np.array([s // self.n for s in self.sums], np.int64)
        centred = _shifted(x, whole).astype(np.float64) - np.array([s % self.n / self.n for s in self.sums])
        flat = self.values <= FLAT * max(self.trace, 0.0)
        return np.where(flat, 0.0, centred @ self.axes / np.sqrt(np.where(flat, 1.0, self.values)))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2 of each row, exact."""
        sums = np.array(self.sums, object)
        most = self.n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(s) for s in self.sums) if x.size else 0
        if x.shape[1] * most * most < 2**63:
            z = self.n * x - sums.astype(np.int64)
        else:
            z = self.n * x.astype(object) - sums
        return [int(v) for v in (z * z).sum(axis=1)]


def covariance(n: int, sums: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariance matrix from the sums of squares of shifted dimensions and pair sums, each entry rounded once."""
    rest = [s % n for s in sums]
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(len(sums))]
    out = np.empty((len(sums), len(sums)))
    for i in range(len(sums)):
        out[i, i] = own[i] / (n * n)
        for j in range(i + 1, len(sums)):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n * n)
    return out


def whiten(vectors: DataFrame, components: int = 4, scale: float = 256.0) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row of ``vectors`` and component.

    ``vectors``: rows of vec_id, embedding (a list of floats or doubles). Rows whose vector is NULL or holds a NULL, NaN or
    infinite entry are left out; all others stay, repeated rows and those without vec_id too. Each distinct x vector counts once
    in the fit. Vectors of different lengths are different spaces and each length has a fit of its own; one without entries has
    no components. Components are numbered from 1 by falling eigenvalue, at most ``components`` and never more than entries;
    equal eigenvalues leave the choice of their axes open. A component without variance has whitened and explained 0.
    ``deviation`` is a decimal(38, 0), as a long need not hold it, and NULL beyond that. ``identity_error`` is the largest
    absolute difference from the identity of the covariance of the whitened components with variance, over the fit lists, measured
    on the vectors again. Other columns are ignored. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in usable(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(encode(quantise(matrix, scale)), pa.binary())], ["code"])

    # The fit list is read three times: written once, in its narrow form.
    fit = cut_lineage(rows.select("embedding").mapInArrow(codes, "code binary").distinct())

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                yield from decode(batch.column(0).slice(at, ROWS).to_pylist())

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for x in parts_of(batches):
            sums = np.concatenate([[len(x)], x.astype(object).sum(axis=0)]) if np.abs(x).max(initial=0) > 1 << 52 else np.concatenate([[len(x)], x.sum(axis=0)])
            held[x.shape[1]] = held.get(x.shape[1], 0) + sums.astype(object)
        for length, sums in held.items():
            yield _numbers(length, [(-1, -1), *((i, i) for i in range(length))], sums)

    added = _added(fit.mapInArrow(plain, NUMBERS))
    lengths = sorted({key[0] for key in added if key[0] > 0})
    counts = {d: added[d, -1, -1] for d in lengths}
    sums = {d: [added[d, i, i] for i in range(d)] for d in lengths}
    shifts = {d: np.array([s // counts[d] for s in sums[d]], np.int64) for d in lengths}

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for x in parts_of(batches):
            if x.shape[1]:
                held[x.shape[1]] = held.get(x.shape[1], 0) + square_sums(_shifted(x, shifts[x.shape[1]]))
        for length, found in held.items():
            yield _numbers(length, [(i, j) for i in range(length) for j in range(i, length)], found)

    squared = _added(fit.mapInArrow(squares, NUMBERS)) if lengths else {}
    models: dict[int, Whitening] = {}
    for d in lengths:
        matrix = covariance(counts[d], sums[d], {(i, j): squared[d, i, j] for i in range(d) for j in range(i, d)})
        values, axes = np.linalg.eigh(matrix)
        falling = np.argsort(-values, kind="stable")[:components]
        models[d] = Whitening(counts[d], tuple(sums[d]), np.ascontiguousarray(axes[:, falling]), values[falling], float(np.trace(matrix)))
    shared = spark.sparkContext.broadcast(models)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for x in parts_of(batches):
            if x.shape[1]:
                w = shared.value[x.shape[1]].project(x)
                w = np.concatenate([np.ones((len(w), 1)), w], axis=1)
                held[x.shape[1]] = held.get(x.shape[1], 0) + w.T @ w
        for length, found in held.items():
            k = len(found)
            a, b = np.divmod(np.arange(k * k), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k * k, length), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(found.ravel())],
                ["length", "a", "b", "v"],
            )

    worst = 0.0
    measured = fit.mapInArrow(products, "length int, a int, b int, v double").groupBy("length", "a", "b").agg(F.sum("v").alias("v"))
    found = {(r["length"], r["a"], r["b"]): r["v"] for r in measured.collect()} if lengths else {}
    for d, model in models.items():
        k = [c for c in range(len(model.values)) if model.values[c] > FLAT * max(model.trace, 0.0)]
        mean = [found[d, 0, c + 1] / model.n for c in k]
        for p, a in enumerate(k):
            for q, b in enumerate(k):
                worst = max(worst, abs(found[d, a + 1, b + 1] / model.n - mean[p] * mean[q] - (a == b)))

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4 * ROWS):
                part = batch.slice(at, 4 * ROWS)
                for places, matrix in usable(part.column("embedding")):
                    if len(places) and matrix.shape[1]:
                        yield _result(part.column("vec_id").take(pa.array(places)), quantise(matrix, scale), shared.value[matrix.shape[1]], worst)

    return rows.mapInArrow(
        out, "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )


NUMBERS = "length int, i int, j int, part int, v decimal(38,0)"
#: Sums leave a task in three parts of at most 64 bits, so that Spark can add up those of very many tasks.
_LIMB = 1 << 64


def _shifted(x: np.ndarray, shift: np.ndarray) -> np.ndarray:
    far = x.size and max(abs(int(x.max())), abs(int(x.min()))) >= 1 << 61
    return x.astype(object) - shift.astype(object) if far else x - shift


def _numbers(length: int, keys: list[tuple[int, int]], values: np.ndarray) -> pa.RecordBatch:
    from decimal import Decimal

    rows = []
    for (i, j), value in zip(keys, values.tolist()):
        rest, part = int(value), 0
        while part < 2 and not -_LIMB < rest < _LIMB:
            rows.append((i, j, part, rest % _LIMB))
            rest, part = rest // _LIMB, part + 1
        rows.append((i, j, part, rest))
    i, j, part, v = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([length] * len(rows), pa.int32()),
            *(pa.array(c, pa.int32()) for c in (i, j, part)),
            pa.array([Decimal(x) for x in v], pa.decimal128(38, 0)),
        ],
        ["length", "i", "j", "part", "v"],
    )


def _added(numbers: DataFrame) -> dict[tuple[int, int, int], int]:
    """Sums over all tasks: one number per length and pair of dimensions comes to the driver."""
    out: dict[tuple[int, int, int], int] = {}
    for r in numbers.groupBy("length", "i", "j", "part").agg(F.sum("v").alias("v")).collect():
        key = r["length"], r["i"], r["j"]
        out[key] = out.get(key, 0) + int(r["v"]) * _LIMB ** r["part"]
    return out


def _result(ids: pa.Array, x: np.ndarray, model: Whitening, worst: float) -> pa.RecordBatch:
    from decimal import Decimal

    k = len(model.values)
    deviation = [Decimal(v) if v < 10**38 else None for v in model.deviations(x)]
    every = np.repeat(np.arange(len(x)), k)
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(every)),
            pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
            pa.array(np.full(len(every), model.n), pa.int64()),
            pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(every)),
            pa.array(model.project(x).ravel(), pa.float64()),
            pa.array(np.tile(explained, len(x)), pa.float64()),
            pa.array(np.full(len(every), worst), pa.float64()),
        ],
        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    )
