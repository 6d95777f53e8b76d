"""Embedding whitening: exact scatter of integer vectors from bit planes, centred as integers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256
COMPONENTS = 4
#: Vectors whose bit planes are packed at once.
BLOCK_ROWS = 16_384
#: Sums travel as limbs of so many bits, each summed as a decimal.
LIMB = 60
LIMBS = 5
#: Eigenvalues below this share of the largest count as zero.
LEAST_SHARE = 1e-13


def grid(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) of each entry, as longs."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("bigint"))


def usable(vector: Column) -> Column:
    """The vector and all its entries are there and finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def planes(x: np.ndarray) -> tuple[list[int], list[tuple[int, int]], np.ndarray]:
    """Per dimension the least value; (dimension, bit) of each plane; the planes, packed across
    rows into 64-bit words."""
    low = x.min(axis=0)
    y = (x.view(np.uint64) - low.view(np.uint64)).T  # differences fit into 64 unsigned bits
    words = -(-x.shape[0] // 64)
    kept, packed = [], []
    for d in range(y.shape[0]):
        for bit in range(int(y[d].max()).bit_length()):
            row = np.packbits((y[d] >> np.uint64(bit)).astype(np.uint8) & 1, bitorder="little")
            packed.append(np.pad(row, (0, words * 8 - row.size)).view(np.uint64))
            kept.append((d, bit))
    return low.tolist(), kept, np.array(packed, np.uint64).reshape(len(kept), words)


def scatter(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Sums of each dimension and of all products of two, exact.

    The planes of two dimensions meet by AND; the set bits of plane a and plane b together weigh
    2 ** (a + b).  The shift of each dimension is put back afterwards.
    """
    n, dims = x.shape
    low, kept, packed = planes(x)
    first = np.array([d for d, _ in kept], np.int64)
    bits = max((b + 1 for _, b in kept), default=0)
    kind = np.int64 if 2 * bits + n.bit_length() < 62 else object
    weight = np.array([1 << b for _, b in kept], kind) if kept else np.zeros(0, kind)
    ones = np.bitwise_count(packed).sum(axis=1, dtype=np.int64)
    sums, products = [0] * dims, [[0] * dims for _ in range(dims)]
    for (d, b), c in zip(kept, ones.tolist()):
        sums[d] += c << b
    for d in range(dims):
        mine = np.flatnonzero(first == d)
        rest = slice(int(mine[0]), None) if mine.size else slice(0, 0)  # this dimension and later ones
        row = np.zeros(len(kept) - (rest.start if mine.size else len(kept)), kind)
        for p in mine:
            common = np.bitwise_count(packed[rest] & packed[p]).sum(axis=1, dtype=np.int64)
            row = row + common.astype(kind) * weight[p]
        if mine.size:
            row = row * weight[rest]
            for e, v in zip(first[rest].tolist(), row.tolist()):
                products[d][e] += int(v)
    for d in range(dims):
        for e in range(d, dims):
            products[d][e] += low[e] * sums[d] + low[d] * sums[e] + n * low[d] * low[e]
            products[e][d] = products[d][e]
    return [s + n * m for s, m in zip(sums, low)], products


def limbs(v: int) -> list[int]:
    """Digits of base 2 ** LIMB, the last one signed."""
    low = [(v >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)]
    return [*low, v >> (LIMB * (LIMBS - 1))]


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column; missing places of shorter vectors are zero."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == dims).all():
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), values.dtype)
    out[np.arange(dims) < sizes[:, None]] = values
    return out


def scatter_sums(fit: DataFrame, dims: int, block_rows: int = BLOCK_ROWS) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and product sums of the ``x`` column, as Python integers.

    A task adds up its blocks and leaves one row for each pair of dimensions; what reaches the
    driver is one number a pair.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products, waiting, rows = 0, [0] * dims, [[0] * dims for _ in range(dims)], [], 0

        def add() -> None:
            nonlocal n
            x = np.concatenate(waiting)
            waiting.clear()
            for a in range(0, len(x), block_rows):
                s, p = scatter(np.ascontiguousarray(x[a:a + block_rows]))
                n += len(x[a:a + block_rows])
                for d in range(dims):
                    sums[d] += s[d]
                    for e in range(d, dims):
                        products[d][e] += p[d][e]

        for batch in batches:
            waiting.append(matrix(batch.column(0), dims))
            rows += batch.num_rows
            if rows >= block_rows:
                add()
                rows = 0
        if rows:
            add()
        if not n:
            return
        found = [(-1, -1, n)] + [(-1, d, sums[d]) for d in range(dims)]
        found += [(d, e, products[d][e]) for d in range(dims) for e in range(d, dims)]
        digits = [limbs(v) for _, _, v in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()),
             *(pa.array([g[k] for g in digits], pa.int64()) for k in range(LIMBS))],
            ["a", "b", *(f"l{k}" for k in range(LIMBS))])

    parts = fit.select("x").mapInArrow(run, "a int, b int, " + ", ".join(f"l{k} long" for k in range(LIMBS)))
    total = parts.groupBy("a", "b").agg(*(F.sum(F.col(f"l{k}").cast("decimal(20,0)")).alias(f"l{k}") for k in range(LIMBS)))
    n, sums, products = 0, [0] * dims, [[0] * dims for _ in range(dims)]
    for r in total.collect():
        v = sum(int(r[f"l{k}"]) << (LIMB * k) for k in range(LIMBS))
        if r["a"] >= 0:
            products[r["a"]][r["b"]] = products[r["b"]][r["a"]] = v
        elif r["b"] >= 0:
            sums[r["b"]] = v
        else:
            n = v
    return n, sums, products


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums S; unit eigenvectors as rows by falling eigenvalue; the eigenvalues of
    the covariance and its trace."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def kept(self) -> np.ndarray:
        """Which components have a variance."""
        return self.values > (self.values[0] if len(self.values) else 0.0) * LEAST_SHARE

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from n * x - S in integers."""
        return exact(x, self.n, self.sums).astype(float) / float(self.n)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN in components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = self.centred(x) @ self.vectors.T / np.sqrt(self.values)
        out[:, ~self.kept] = np.nan
        return out


def exact(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S: 64-bit integers where they surely fit, Python's otherwise."""
    most = int(np.abs(x.astype(object)).max()) if x.size and x.min() == np.iinfo(np.int64).min else (
        int(np.abs(x).max()) if x.size else 0)
    if n * most + max((abs(s) for s in sums), default=0) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sum over the dimensions of (n * x - S) ** 2 of each row, exact."""
    z = exact(x, n, sums)
    most = max(int(z.max()), -int(z.min())) if z.size else 0
    if z.dtype != object and most * most * max(z.shape[1], 1) < 1 << 62:
        return (z * z).sum(axis=1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in z]


def whitening(n: int, sums: list[int], products: list[list[int]], components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the covariance (n * products - sums x sums) / n ** 2, whose numerator is
    centred in integers before it becomes floating point."""
    dims = len(sums)
    centred = [[n * products[d][e] - sums[d] * sums[e] for e in range(dims)] for d in range(dims)]
    most = max((abs(v) for row in centred for v in row), default=0)
    shift = max(most.bit_length() - 900, 0)  # floats end at 2 ** 1023
    m = np.array([[float(v >> shift) for v in row] for row in centred], float).reshape(dims, dims)
    unit = float(np.abs(m).max()) if dims and most else 1.0
    values, vectors = np.linalg.eigh(m / unit) if dims else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(-values, kind="stable")[:components]
    chosen = vectors[:, order].T
    for v in chosen:  # the largest entry is positive
        if v[np.argmax(np.abs(v))] < 0:
            v *= -1
    factor = unit / max(n, 1) / max(n, 1) * 2.0 ** shift
    return Whitening(n, tuple(sums), chosen, np.maximum(values[order], 0) * factor,
                     sum(centred[d][d] for d in range(dims)) / (n * n) if n else 0.0)


def identity_error(fit: DataFrame, model: Whitening, dims: int) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    keep = np.flatnonzero(model.kept)
    if not keep.size or not model.n:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # moments, merged pairwise: count, means, centred products
        n, mean, cross = 0, np.zeros(keep.size), np.zeros((keep.size, keep.size))
        for batch in batches:
            w = model.project(matrix(batch.column(0), dims))[:, keep]
            if not len(w):
                continue
            own = w.mean(axis=0)
            step = own - mean
            cross += (w - own).T @ (w - own) + np.outer(step, step) * n * len(w) / (n + len(w))
            mean += step * len(w) / (n + len(w))
            n += len(w)
        if n:
            raw = cross + n * np.outer(mean, mean)
            values = [float(n), *(n * mean).tolist(), *raw.ravel().tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["k", "v"])

    total = dict(fit.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v")).collect())
    n, k = total[0], keep.size
    mean = np.array([total[1 + i] for i in range(k)]) / n
    second = np.array([total[1 + k + i] for i in range(k * k)]).reshape(k, k) / n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per remaining input row and component: id, component (from 1, by falling variance),
    n, deviation, whitened, explained, identity_error.

    Rows whose vector is NULL or holds a NULL, NaN or infinite entry go.  Entries become integers
    x = floor(scale * entry), and beyond 64 bits the nearest such integer.  The model is fitted on each distinct
    x vector once (the fit list): its exact sums and product sums come from bit planes, are centred as
    integers and only then become floating point for the eigenvectors, whose largest entry is
    positive.  ``deviation`` is the sum of (n * x - S) ** 2 over the dimensions, NULL where it
    exceeds 64 bits; ``deviation_digits`` has it as text always.

    Vectors shorter than the longest one, empty ones included, count as zero in the missing
    places.  A component without variance (fewer distinct vectors than dimensions, a constant dimension) has
    explained 0 and a NULL whitened value; without any variance explained and identity_error are
    NULL.  Repeated rows and NULL ids stay as they are; an empty table gives no rows.
    """
    rows = vectors.filter(usable(F.col(vector_col))).select(
        F.col(id_col).alias("i"), grid(F.col(vector_col), scale).alias("x"))
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    dims = longest or 0
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("x")))
    fit = written(rows.select(padded.alias("x")).distinct(), "fit")
    n, sums, products = scatter_sums(fit, dims, block_rows)
    model = whitening(n, sums, products, components)
    error = identity_error(fit, model, dims)
    count, kept = len(model.values), model.kept
    share = [float(v / model.trace) if k else 0.0 for v, k in zip(model.values, kept)] if model.trace else [None] * count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not count:
                continue
            x = matrix(batch.column("x"), dims)
            w = model.project(x)
            far = deviations(x, n, model.sums)
            each = np.repeat(np.arange(len(x)), count)
            fits = pa.array([d if d < 1 << 63 else None for d in far], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("i").take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), n, np.int64)), fits.take(pa.array(each)),
                 pa.array(w.ravel(), mask=np.isnan(w.ravel())), pa.array(share * len(x), pa.float64()),
                 pa.array([error] * len(each), pa.float64()), pa.array(map(str, far), pa.string()).take(pa.array(each))],
                ["i", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_digits"])

    kind = dict(rows.dtypes)["i"]
    out = rows.mapInArrow(run, f"i {kind}, component int, n long, deviation long, whitened double, explained double, "
                               "identity_error double, deviation_digits string")
    return out.select(F.col("i").alias(id_col), *out.columns[1:])
