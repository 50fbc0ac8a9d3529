"""Whitening of embedding vectors from an exact integer scatter matrix (operator 11).

Every entry c becomes the integer x = floor(64 c) + 1000000. Cross-products of the
fit list (each distinct x vector once) are taken from bit planes: in a block of
rows each dimension is shifted by its least value there, bit k of all rows is
packed into 64-bit words, and the sum of products of dimensions d and e is the
sum over their planes j and k of 2^(j+k) * popcount(plane_dj AND plane_ek). Blocks
are added up as integers of any size, centred as integers (n * cross - S * S), and
only then turned to doubles for the eigenvectors.

Defined results: rows whose vector is null or holds a null, NaN or infinite entry
are left out; repeated rows and null ids stay and count one by one in the output,
once in the fit list. Vectors of different lengths are whitened apart, each length
with its own fit list; a vector of length 0 has no component. A component without
variance (an eigenvalue not above rounding, as for a fit list of one) gets
whitened 0 and does not count in identity_error. x is held within +-2^62; a
deviation that 64 bits cannot hold is null. An empty table gives no rows. Columns
other than the id and the vector are not read. Memory is that of an Arrow batch
and a few matrices of D x D.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import scope, stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows whose bit planes are multiplied at a time.
BLOCK_ROWS = 8192
_LIMB = 32
_HELD = float(1 << 62)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and the integer vector x of every usable row."""
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = lambda c: F.greatest(F.least(F.floor(F.least(F.greatest(c * SCALE, F.lit(-_HELD)), F.lit(_HELD))),
                                        F.lit((1 << 62) - OFFSET)), F.lit(-(1 << 62) - OFFSET)) + OFFSET
    return (vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & usable).select("vec_id", F.transform("v", held).alias("x")))


def matrices(col: pa.Array):
    """(length, row numbers, matrix) of the vectors of one Arrow list column by length."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat, off = col.flatten().to_numpy(zero_copy_only=False), col.offsets.to_numpy()
    off = off - off[0]
    size = np.diff(off)
    for n in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == n)
        whole = len(rows) == len(size)
        yield n, rows, (flat.reshape(-1, n) if whole else flat[off[rows][:, None] + np.arange(n)])


def bit_planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(least value of each dimension, dimension and bit of each plane, planes) of
    the columns of x; a plane holds one bit of every row, 64 rows a word."""
    least = x.min(axis=0)
    shifted = (x - least).astype(np.uint64)
    width = [int(v).bit_length() for v in shifted.max(axis=0)]
    dim = np.repeat(np.arange(x.shape[1]), width)
    bit = np.concatenate([np.arange(w) for w in width]).astype(np.int64) if len(dim) else np.zeros(0, np.int64)
    words = -(-len(x) // 64)
    planes = np.zeros((len(dim), words), np.uint64)
    for p, (d, k) in enumerate(zip(dim.tolist(), bit.tolist(), strict=True)):
        own = np.zeros(words * 64, np.uint8)
        own[:len(x)] = (shifted[:, d] >> np.uint64(k)) & np.uint64(1)
        planes[p] = np.packbits(own, bitorder="little").view("<u8")
    return least, dim, bit, planes


def block_scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of each column, sums of products of all pairs of columns) of a block,
    as integers of any size."""
    n, dims = x.shape
    least, dim, bit, planes = bit_planes(x)
    weight = np.array([1 << int(k) for k in bit], dtype=object)
    held = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    shifted = np.zeros(dims, dtype=object)
    np.add.at(shifted, dim, held.astype(object) * weight)
    cross = np.zeros((dims, dims), dtype=object)
    starts = np.searchsorted(dim, np.arange(dims))
    used = np.flatnonzero(np.diff(np.append(starts, len(dim))) > 0)
    small = bool(len(bit)) and 2 * int(bit.max()) + 2 + n.bit_length() < 62
    number = np.int64 if small else object
    whole = weight.astype(number)
    for d in used.tolist():
        lo, hi = starts[d], starts[d] + np.count_nonzero(dim == d)
        rest = planes[lo:]
        both = (np.bitwise_count(planes[p] & rest).sum(axis=1, dtype=np.int64).astype(number) for p in range(lo, hi))
        row = sum(whole[p] * c for p, c in zip(range(lo, hi), both, strict=True)) * whole[lo:]
        later = used[used >= d]
        got = np.add.reduceat(row, starts[later] - lo)
        for e, v in zip(later.tolist(), got.tolist(), strict=True):
            cross[d, e] = cross[e, d] = v
    shift = np.array([int(v) for v in least], dtype=object)
    return (shifted + n * shift,
            cross + np.outer(shift, shifted) + np.outer(shifted, shift) + n * np.outer(shift, shift))


def _limbs(v: int):
    """(place, signed part of 32 bits) of an integer."""
    sign, v, k = (-1, -v, 0) if v < 0 else (1, v, 0)
    while v:
        if part := v & ((1 << _LIMB) - 1):
            yield k, sign * part
        v, k = v >> _LIMB, k + 1


def _scatter_parts(batches):
    """Counts, sums and cross-products of one task, in parts that add up as longs."""
    held: dict[int, list] = {}
    for b in batches:
        for dims, _, x in matrices(b.column(0)):
            own = held.setdefault(dims, [0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)])
            for at in range(0, len(x), BLOCK_ROWS):
                some = x[at:at + BLOCK_ROWS]
                s, c = block_scatter(some)
                own[0], own[1], own[2] = own[0] + len(some), own[1] + s, own[2] + c
    for dims, (n, s, c) in held.items():
        entries = [(-1, -1, n)] + [(d, -1, v) for d, v in enumerate(s.tolist())]
        entries += [(d, e, c[d, e]) for d in range(dims) for e in range(d, dims)]
        rows = [(dims, d, e, k, part) for d, e, v in entries for k, part in _limbs(int(v))]
        yield pa.record_batch([pa.array(col, pa.int64()) for col in zip(*rows, strict=True)], ["dims", "d", "e", "limb", "part"])


@dataclass
class Whitener:
    """The fit of one vector length. ``n`` distinct vectors with sums ``sums``;
    ``basis`` has a column for each of the first components: the unit eigenvector
    over the square root of its eigenvalue (zeros without variance)."""

    n: int
    sums: list[int]
    basis: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @classmethod
    def of(cls, n: int, sums: list[int], cross: np.ndarray, components: int) -> Whitener:
        s = np.array(sums, dtype=object)
        centred = (n * cross - np.outer(s, s)).astype(np.float64)
        values, vectors = np.linalg.eigh(centred / float(n) / float(n))
        values, vectors = values[::-1], vectors[:, ::-1]
        total, k = values[values > 0].sum(), min(components, len(sums))
        real = values[:k] > max(values[0], 0.0) * len(sums) * np.finfo(float).eps
        basis = np.where(real, vectors[:, :k] / np.sqrt(np.where(real, values[:k], 1.0)), 0.0)
        return cls(n, [int(v) for v in sums], basis, np.where(real, values[:k] / total if total > 0 else 0.0, 0.0))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), 1)
        if self.n * top + max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def deviation(self, centred: np.ndarray) -> list[int | None]:
        top = max((abs(int(v)) for v in (centred.max(initial=0), centred.min(initial=0))), default=0)
        if top * top * max(1, centred.shape[1]) < 1 << 63:
            c = centred.astype(np.int64)
            return (c * c).sum(axis=1).tolist()
        c = centred.astype(object)
        return [v if v < 1 << 63 else None for v in (c * c).sum(axis=1).tolist()]

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.basis


def _identity_parts(fits: dict[int, Whitener]):
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for dims, _, x in matrices(b.column(0)):
                w = fits[dims].project(fits[dims].centred(x))
                held[dims] = held.get(dims, 0.0) + w.T @ w
        for dims, m in held.items():
            i, j = np.indices(m.shape)
            yield pa.record_batch([pa.array(np.full(m.size, dims)), pa.array(i.ravel()), pa.array(j.ravel()), pa.array(m.ravel())],
                                  ["dims", "i", "j", "part"])
    return run


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener for each vector length among the distinct vectors (column x).

    The driver gets D * D / 2 numbers a length, whatever the number of rows.
    """
    parts = distinct.select("x").mapInArrow(_scatter_parts, "dims long, d long, e long, limb long, part long")
    sums: dict[int, dict] = {}
    for dims, d, e, limb, part in parts.groupBy("dims", "d", "e", "limb").agg(F.sum("part")).collect():
        own = sums.setdefault(dims, {})
        own[d, e] = own.get((d, e), 0) + (part << (_LIMB * limb))
    fits = {}
    for dims, own in sums.items():
        cross = np.array([[own.get((min(d, e), max(d, e)), 0) for e in range(dims)] for d in range(dims)], dtype=object)
        fits[dims] = Whitener.of(own[-1, -1], [own.get((d, -1), 0) for d in range(dims)], cross, components)
    found = distinct.select("x").mapInArrow(_identity_parts(fits), "dims long, i long, j long, part double")
    for dims, i, j, total in found.groupBy("dims", "i", "j").agg(F.sum("part")).collect():
        f = fits[dims]
        if f.basis[:, i].any() and f.basis[:, j].any():
            f.identity_error = max(f.identity_error, abs(total / f.n - (i == j)))
    return fits


def transform(rows: DataFrame, fits: dict[int, Whitener]) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of
    rows (vec_id, x). The fits (D x 16 doubles a length) travel with the tasks."""
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for dims, at, x in matrices(b.column(1)):
                f = fits[dims]
                for lo in range(0, len(x), BLOCK_ROWS):
                    some, own = x[lo:lo + BLOCK_ROWS], at[lo:lo + BLOCK_ROWS]
                    c, k = f.centred(some), f.basis.shape[1]
                    each = np.repeat(np.arange(len(own)), k)
                    yield pa.record_batch(
                        [b.column(0).take(pa.array(own[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(own))),
                         pa.array(np.full(len(each), f.n)), pa.array(f.deviation(c), pa.int64()).take(pa.array(each)),
                         pa.array(f.project(c).ravel()), pa.array(np.tile(f.explained, len(own))),
                         pa.array(np.full(len(each), f.identity_error))],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, "
                                "identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on the distinct integer vectors of a table and whiten all its rows."""
    rows = integer_vectors(vectors, id_col, vector_col)
    with scope(vectors.sparkSession):
        fits = fit(stored(rows.select("x").distinct(), "fit-list"), components)
    return transform(rows, fits)
