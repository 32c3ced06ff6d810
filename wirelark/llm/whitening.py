"""Operator 13: whitening of embeddings by merged covariances.

Components are put on a grid: c becomes floor(64 c) + 1000000. The fit list holds each distinct grid vector once. Every
partition computes count, mean and centred scatter of its share; a tree of reductions merges them pairwise by Chan's
formula, so that nothing is ever squared before it is centred; eigh runs on the driver on one d x d matrix. A second
pass over the fit list takes the covariance of what came out, by the same merging, and holds it against the identity.

What reaches the driver is one summary (d + d * d doubles) a branch of the tree, whatever the number of rows. The number
of rows and the sums are exact integers of any size.

Vectors that are null or hold null or non-finite components are dropped; null ids, repeated ids and repeated vectors
stay (a vector counts once in the fit). Vectors of each length are a space of their own, with its own n, components and
explained shares; ``identity_error`` is the largest of all. Components whose eigenvalue is zero to double precision (a
space of one point has no other) cannot be scaled to one and are left out. Grid values beyond 2^53 are held there. A
``deviation`` beyond 63 bits is null. An empty table gives no rows; columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 64, 1_000_000
#: Grid values beyond this are not whole numbers of their own in double precision.
_MOST = 2.0**53
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


class Moments(NamedTuple):
    """Count, mean, centred scatter (the sum of outer products) and exact sums of some vectors of one length."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray
    sums: tuple[int, ...]

    def merged(self, other: Moments) -> Moments:
        """Chan's pairwise formula."""
        n, apart = self.n + other.n, other.mean - self.mean
        mean = self.mean + apart * (other.n / n)
        scatter = self.scatter + other.scatter + np.outer(apart, apart) * (self.n * (other.n / n))
        return Moments(n, mean, scatter, tuple(a + b for a, b in zip(self.sums, other.sums, strict=True)))


def moments_of(x: np.ndarray, exact: bool = True) -> Moments:
    """Of the rows of a matrix; whole numbers are centred on their first row before they become doubles."""
    n, first = len(x), x[0]
    apart = x - first
    y = apart.astype(np.float64)
    mean = y.mean(axis=0)
    y -= mean
    sums: tuple[int, ...] = ()
    if exact:
        safe = float(np.abs(apart).max()) * n < 2.0**62
        own = apart.sum(axis=0) if safe else apart.astype(object).sum(axis=0)
        sums = tuple(n * a + b for a, b in zip(first.tolist(), own.tolist(), strict=True))
    return Moments(n, mean + first, y.T @ y, sums)


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the lists of each length; lists and their items are not null."""
    ends = column.offsets.to_numpy()
    flat, lengths = column.values.to_numpy(zero_copy_only=False), np.diff(ends)
    for d in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[ends[rows][:, None] + np.arange(d)]


def gridded(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): the rows that count, x an array of longs."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = lambda c: F.least(F.greatest(F.lit(SCALE) * c, F.lit(-_MOST)), F.lit(_MOST))
    return v.where(F.col("vec").isNotNull() & finite).select("vec_id", F.transform("vec", lambda c: F.floor(held(c)).cast("long") + F.lit(SHIFT).cast("long")).alias("x"))


def merged_moments(rows: DataFrame, column: str, prepared: Callable[[np.ndarray], np.ndarray | None] | None = None, exact: bool = True) -> dict[int, Moments]:
    """Moments of the vectors of each length in an array column; ``prepared`` turns a matrix of them first.

    Each partition gives one summary; they are merged in a tree.
    """

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, Moments] = {}
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                d = x.shape[1]
                y = prepared(x) if prepared else x
                if y is not None:
                    own = moments_of(y, exact)
                    total[d] = total[d].merged(own) if d in total else own
        for d, m in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d]), pa.array([m.n]), pa.array([m.mean.tobytes()]), pa.array([m.scatter.tobytes()]), pa.array([[str(s) for s in m.sums]], pa.list_(pa.string()))],
                names=["d", "n", "mean", "scatter", "sums"],
            )

    def read(row) -> dict[int, Moments]:
        mean = np.frombuffer(row.mean)
        return {row.d: Moments(row.n, mean, np.frombuffer(row.scatter).reshape(len(mean), -1), tuple(map(int, row.sums)))}

    def both(a: dict[int, Moments], b: dict[int, Moments]) -> dict[int, Moments]:
        return {d: a[d].merged(b[d]) if d in a and d in b else a.get(d) or b[d] for d in a.keys() | b.keys()}

    parts = rows.select(column).mapInArrow(summed, "d long, n long, mean binary, scatter binary, sums array<string>")
    return parts.rdd.map(read).treeAggregate({}, both, both, depth=3)


class Space:
    """What one length of vectors is whitened by."""

    def __init__(self, m: Moments, most: int):
        self.n, self.sums = m.n, m.sums
        values, vectors = np.linalg.eigh(m.scatter / m.n)
        values, vectors = values[::-1], vectors[:, ::-1]
        tiny = np.finfo(np.float64).eps * len(values) * max(values[0], 0.0)
        rank = int(np.count_nonzero(values > tiny))
        keep = min(most, rank)
        self.directions = vectors[:, :keep] / np.sqrt(values[:keep])
        self.explained = values[:keep] / np.trace(m.scatter / m.n)
        self.size = keep

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs, or Python's integers where those could overflow."""
        wide = max(abs(int(x.max())), abs(int(x.min())), 1) * self.n + max(map(abs, self.sums)) >= 1 << 62
        if wide:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)

    def whitened(self, apart: np.ndarray) -> np.ndarray:
        return (apart.astype(np.float64) / self.n) @ self.directions

    def deviations(self, apart: np.ndarray) -> list[int | None]:
        """Sums of squares, exact; None beyond 63 bits."""
        if apart.dtype != object and float(np.abs(apart).max()) ** 2 * apart.shape[1] < 2.0**62:
            return (apart * apart).sum(axis=1).tolist()
        squares = (apart.astype(object) ** 2).sum(axis=1)
        return [s if s < 1 << 63 else None for s in squares.tolist()]


def whitened(vectors: DataFrame, components: int = 16) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    grid = gridded(vectors)
    fit = stored(grid.select("x").distinct(), "whitening-fit")
    spaces = {d: Space(m, components) for d, m in merged_moments(fit, "x").items()}
    spaces = {d: s for d, s in spaces.items() if s.size}

    def turned(x: np.ndarray) -> np.ndarray | None:
        space = spaces.get(x.shape[1])
        return space and space.whitened(space.apart(x))

    seen = merged_moments(fit, "x", turned, exact=False) if spaces else {}
    error = max([float(np.abs(m.scatter / m.n - np.eye(len(m.mean))).max()) for m in seen.values()], default=0.0)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for places, x in matrices(batch.column(1)):
                if (space := spaces.get(x.shape[1])) is None:
                    continue
                apart, k = space.apart(x), space.size
                deviation = pa.array(space.deviations(apart), pa.int64())
                each, m = pa.array(np.repeat(np.arange(len(x)), k)), len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(places)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, space.n, np.int64)),
                        deviation.take(each), pa.array(space.whitened(apart).ravel()), pa.array(np.tile(space.explained, m)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained"],
                )

    return grid.mapInArrow(project, _OUT).withColumn("identity_error", F.lit(error))
