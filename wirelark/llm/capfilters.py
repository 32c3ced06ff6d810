"""Operator 8: near-duplicate embeddings with spherical-cap filters.

Filter directions are words of a random product code: a vector is turned by one random rotation, so that its norm is even over the dimensions however
uneven it came, then the dimensions are cut in two halves, each half has ``code`` random Gaussian vectors, and a direction is one of each. Because a direction's product with a vector is the sum of its
halves' products, all directions that exceed the threshold are listed by decoding the sorted halves, without looking at
the others. Several independent codes even out the luck of one. Vectors that share a filter are first compared on
128 sign bits of random projections, at five standard deviations over the expected difference (a near pair is missed
there about once in 10^6); the groups of such pairs are then compared exactly, in double precision.

Vectors of one label may lie close together, all at a cosine of 0.8 or 0.95 to one another: filters around the origin then
exceed for all or none. Such a label is centred first, on a mean estimated from a bounded sample; its pairs at ``cosine``
are further apart around that centre, so it gets its own code, with as many filters as find such a pair, and its vectors
go to the filters themselves, since no few bits tell such pairs from others: only pairs that are near make groups there.
Labels closer than ``TOO_CLOSE`` are left as they are.

Equal vectors (of equal label) are one class with a count, so copies are never expanded into pairs. Filters link the
classes into candidate groups; every pair of classes inside a group is verified, cell by cell of a grid if the group is
large. Only a pair of which no chain of filters finds the ends can be lost (over 0.99 are found in tests).

A vector that is null, zero, or holds null or non-finite components, or has a null label, links with nothing: n_links
0, its own component. Vectors of different lengths never link. Rows that repeat a vec_id count as vectors of their own. An
empty table gives no rows; columns of other names are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .common import Forest, cells, components, grid, starts_of, stored

#: Sign bits for the first comparison.
SIGNS = 128
#: Large groups are cut in chunks of 128 rows as long as they are 24 at most, then in larger ones.
SPREAD = (24, 128)


#: A label is centred if its vectors share from so much to so much of their squared length, and it has so many of them.
CENTRED, TOO_CLOSE, FEWEST = 0.3, 0.97, 64
#: Vectors of a label that its centre is estimated from, about.
CENTRE_SAMPLE = 2048


def both_exceed(threshold: float, cosine: float) -> float:
    """The probability that a vector exceeds a filter's threshold if one at ``cosine`` to it does."""
    z = np.linspace(threshold, threshold + 9, 2001)
    density = np.exp(-0.5 * z * z)
    rest = np.array([0.5 * math.erfc((threshold - cosine * x) / math.sqrt(2 * (1 - cosine * cosine))) for x in z])
    return float((density * rest).sum() / density.sum())


class ProductCode:
    """``tables`` random product codes for vectors of length ``d``; about ``filters`` directions exceed for a vector.

    ``near``: the cosine at which pairs of centred vectors have to be found. There are then as many filters as make it all
    but certain that such a pair shares one.
    """

    def __init__(self, d: int, expected: int, filters: int = 14, bucket: int = 24, tables: int = 7, seed: int = 7, near: float | None = None):
        share = min(0.05, bucket / max(1, expected))  # of the vectors in one cap
        if near is not None:
            filters = max(filters, math.ceil(14 / both_exceed(NormalDist().inv_cdf(1 - share), near)))
            tables = max(tables, math.ceil(filters / 2))
        self.code = max(2, math.ceil(math.sqrt(filters / tables / share))) if d > 1 else 1
        self.threshold = NormalDist().inv_cdf(1 - filters / tables / self.code**2) if d > 1 else 0.0
        rng = np.random.default_rng([seed, d])
        self.half = (d + 1) // 2
        self.rotation = np.linalg.qr(np.random.default_rng([seed, d, 1]).standard_normal((d, d)))[0]
        self.planes = rng.standard_normal((d, SIGNS))
        self.tables = [(rng.standard_normal((self.half, self.code)), rng.standard_normal((d - self.half, self.code)) if d > 1 else np.zeros((0, 1))) for _ in range(tables)]

    def signs(self, x: np.ndarray) -> np.ndarray:
        """Sign bits of random projections, as signed longs."""
        return np.packbits(x @ self.planes > 0, axis=1).view(np.int64)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all directions that exceed the threshold, for unit rows ``x``."""
        x, rows, found = x @ self.rotation, [], []
        for t, (left, right) in enumerate(self.tables):
            a, b = x[:, : self.half] @ left, x[:, self.half :] @ right
            oa, ob = np.argsort(-a, axis=1), np.argsort(-b, axis=1)
            sa, sb = np.take_along_axis(a, oa, 1), np.take_along_axis(b, ob, 1)
            live = np.arange(len(x))
            for i in range(sa.shape[1]):  # the i-th best of the left half, with ever fewer of the right
                live = live[sa[live, i] + sb[live, 0] >= self.threshold]
                if not len(live):
                    break
                here = live
                for j in range(sb.shape[1]):
                    here = here[sa[here, i] + sb[here, j] >= self.threshold]
                    if not len(here):
                        break
                    rows.append(here)
                    found.append((t * self.code + oa[here, i]) * self.code + ob[here, j])
        none = [np.empty(0, np.int64)]
        return np.concatenate(none + rows), np.concatenate(none + found)


def _key(*parts: np.ndarray) -> np.ndarray:
    """Mixes integers into one 64-bit key."""
    h = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _unit(column: pa.Array) -> list[np.ndarray]:
    return [v / np.linalg.norm(v) for v in (np.asarray(x, np.float64) for x in column.to_pylist())]


def classes_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec, node) of the vectors that can link; node is a hash of label and vector.

    Vectors are divided by their largest component, so that no square overflows or vanishes, whatever their scale;
    those that then are equal point the same way and are one class.
    """
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
    good = v.where(F.col("label").isNotNull() & F.col("vec").isNotNull()).where(finite).where(F.exists("vec", lambda x: x != 0))
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    shrunk = let(largest, lambda m: F.transform("vec", lambda x: x / m + F.lit(0.0)))  # -0.0 as 0.0
    named = good.select("vec_id", "label", shrunk.alias("vec"))
    return named.withColumn("node", F.xxhash64("label", "vec"))


def centres(classes: DataFrame) -> DataFrame:
    """(label, d, n, centre) of the labels, by length of their vectors, that are centred; a bounded sample of each."""
    length = F.size("vec").alias("d")
    sizes = classes.groupBy("label", length).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FEWEST)
    draw = F.pmod(F.xxhash64("node", F.lit("centre")), F.lit(1 << 30)) / float(1 << 30)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    unit = let(norm, lambda n: F.transform("vec", lambda x: x / n))
    some = classes.select("label", length, draw.alias("draw"), unit.alias("unit")).join(sizes, ["label", "d"]).where(F.col("draw") < CENTRE_SAMPLE / F.col("n"))
    means = some.select("label", "d", "n", F.posexplode("unit").alias("k", "x")).groupBy("label", "d", "n", "k").agg(F.avg("x").alias("x"))
    whole = means.groupBy("label", "d", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda c: c["x"]).alias("centre"))
    return whole.where(F.aggregate("centre", F.lit(0.0), lambda a, x: a + x * x).between(CENTRED, TOO_CLOSE))


def cap_links(classes: DataFrame, expected: int, cosine: float, hot: int = 2048, **code) -> DataFrame:
    """Links (a, b) of classes that share a filter and may be ``cosine`` near: a spanning forest of each bucket.

    ``classes``: node, label, vec, and the label's centre (null: none) and n.
    """
    codes: dict[tuple, ProductCode] = {}
    share = math.acos(min(1.0, max(-1.0, cosine))) / math.pi  # of sign bits that differ at this cosine
    most = math.ceil(SIGNS * share + 5 * math.sqrt(SIGNS * share * (1 - share)))

    def code_of(d: int, centre: np.ndarray | None, n: int) -> ProductCode:
        if centre is None:
            key, size, near = (d,), expected, cosine
        else:
            near = math.floor(50 * (1 - (1 - cosine) / max(1e-9, 1 - float(centre @ centre)))) / 50
            near, size = min(cosine, max(0.3, near)), 1 << max(0, n - 1).bit_length()
            key = (d, size, near)
        if key not in codes:
            codes[key] = ProductCode(d, size, near=near, **code)
        return codes[key]

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                node, label, unit = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), _unit(batch.column(2))
                length, centred = np.array([len(u) for u in unit]), batch.column(3).is_valid().to_numpy(zero_copy_only=False)
                own_label = np.where(centred, label, 0)  # labels without a centre share a code
                for d, name, held in sorted(set(zip(length.tolist(), own_label.tolist(), centred.tolist(), strict=True))):
                    own = np.flatnonzero((length == d) & (own_label == name) & (centred == held))
                    x = np.array([unit[i] for i in own])
                    centre = np.array(batch.column(3)[int(own[0])].as_py()) if held else None
                    own_code = code_of(d, centre, batch.column(4)[int(own[0])].as_py() if held else 0)
                    if held:
                        apart = x - centre
                        row, found = own_code.decode(apart / np.maximum(np.linalg.norm(apart, axis=1), 1e-12)[:, None])
                        sent = x.astype("<f4")
                    else:
                        row, found = own_code.decode(x)
                        sent = own_code.signs(x)
                    for some in range(0, len(row), 100_000):
                        k, f = row[some : some + 100_000], found[some : some + 100_000]
                        r, told = own[k], np.ascontiguousarray(sent[k])
                        ends = (np.arange(len(r) + 1) * told[:1].nbytes).astype(np.int32)
                        blob = pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(ends), pa.py_buffer(told)])
                        yield pa.RecordBatch.from_arrays([pa.array(_key(label[r], np.full(len(r), d), f)), pa.array(node[r]), blob, pa.array(np.full(len(r), held))], names=["key", "node", "told", "whole"])

    def near_in(told: np.ndarray, whole: bool, some: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of some rows may be near which others: by their vectors, or by sign bits."""
        if whole:
            x = told.view("<f4")
            return x[some] @ x[j].T >= cosine - 1e-5
        signs = told.view(np.uint64)
        apart = np.zeros((len(some), len(j)), np.int16)
        for w in range(signs.shape[1]):
            apart += np.bitwise_count(signs[some, w][:, None] ^ signs[j, w])
        return apart <= most

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in cells(batches, "key", 50_000):
            starts, node, chunk = starts_of(table, "key"), table.column("node").to_numpy(), table.column("chunk").to_numpy()
            whole, blobs, found = table.column("whole").to_numpy(), table.column("told").combine_chunks(), []
            for s, e in zip(starts[:-1], starts[1:]):
                told = np.frombuffer(b"".join(blobs[s:e].to_pylist()), np.uint8).reshape(e - s, -1)
                forest = Forest(e - s)
                for i, j in sides(chunk[s:e]):
                    for at in range(0, len(i), 512):
                        some = i[at : at + 512]
                        u, v = np.nonzero(near_in(told, bool(whole[s]), some, j))
                        forest.link(some[u], j[v])
                roots = forest.roots()
                moved = np.flatnonzero(roots != np.arange(e - s))
                found.append((node[s:e][moved], node[s:e][roots[moved]]))
            a, b = (np.concatenate(z) for z in zip(*found, strict=True))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    rows = classes.select("node", F.xxhash64("label").alias("label"), "vec", "centre", "n").mapInArrow(spread, "key long, node long, told binary, whole boolean")
    return grid(rows, "key", "node", hot, SPREAD).select("key", "cell_i", "cell_j", "chunk", "node", "told", "whole").mapInArrow(search, "a long, b long").distinct()


def sides(chunk: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The two sides of a cell: all rows with all rows, or one chunk with the other."""
    if (chunk == chunk[0]).all():
        every = np.arange(len(chunk))
        return [(every, every)]
    return [(np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk != chunk.min()))]


def verified(members: DataFrame, cosine: float, hot: int = 2048) -> DataFrame:
    """Rows (node, other, links) of members (label, node, vec, copies) of candidate groups, compared exactly.

    ``links``: vectors of other classes that a class links within one cell; ``other`` (null: none) spans its links.
    """

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in cells(batches, "key", 20_000):
            starts, node, chunk = starts_of(table, "key"), table.column("node").to_numpy(), table.column("chunk").to_numpy()
            copies, vec = table.column("copies").to_numpy(), table.column("vec").to_pylist()
            out_node, out_other, out_links = [], [], []
            for s, e in zip(starts[:-1], starts[1:]):
                size = e - s
                x = np.array(vec[s:e], np.float64)
                x = x / np.linalg.norm(x, axis=1)[:, None]
                forest, count = Forest(size), np.zeros(size, np.int64)
                for i, j in sides(chunk[s:e]):
                    for at in range(0, len(i), 512):
                        some = i[at : at + 512]
                        near = x[some] @ x[j].T >= cosine
                        if i is j:
                            near[np.arange(len(some)), at + np.arange(len(some))] = False
                        count[some] += near @ copies[s:e][j]
                        if i is not j:
                            count[j] += copies[s:e][some] @ near
                        u, v = np.nonzero(near)
                        forest.link(some[u], j[v])
                roots = forest.roots()
                out_node.append(node[s:e])
                out_other.append(node[s:e][roots])
                out_links.append(count)
            n, o, c = (np.concatenate(z) for z in (out_node, out_other, out_links))
            keep = (n != o) | (c > 0)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(n[keep]), pa.array(o[keep]), pa.array(c[keep])], names=["node", "other", "links"])

    dealt = grid(members.withColumnRenamed("label", "key"), "key", "node", hot, SPREAD)
    return dealt.select("key", "cell_i", "cell_j", "chunk", "node", "copies", "vec").mapInArrow(compare, "node long, other long, links long")


def _centred(classes: DataFrame) -> DataFrame:
    """Classes with the centre of their label, if it has one."""
    found = stored(centres(classes), "vector-centres")
    if found.isEmpty():
        return classes.withColumns({"centre": F.lit(None).cast("array<double>"), "n": F.lit(None).cast("long")})
    return classes.withColumn("d", F.size("vec")).join(found, ["label", "d"], "left").drop("d")


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, **code) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id (smallest vec_id reachable), kept."""
    named = stored(classes_of(vectors).select("vec_id", "node", "label", "vec"), "vectors")
    classes = stored(named.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"), F.any_value("label").alias("label"), F.any_value("vec").alias("vec")), "vector-classes")
    expected = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    groups = components(cap_links(_centred(classes), expected, cosine, **code), "vector-groups")
    pairs = stored(verified(groups.join(classes.select("node", "copies", "vec"), "node"), cosine), "vector-pairs")
    labels = components(pairs.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")), "vectors")
    counts = pairs.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.select("node", "copies", "first").join(labels, "node", "left").join(counts, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = known.groupBy("label").agg(F.min("first").alias("component_id"))
    known = known.join(lowest, "label").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = named.select("vec_id", "node").join(known, "node").select("vec_id", "n_links", "component_id")
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    alone = ids.exceptAll(named.select("vec_id")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN lowest ON lowest.a = vec_id
"""
