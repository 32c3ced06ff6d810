"""Shared pieces: text batches, hot-key grids and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import removed, stored, stored_at, work_dir  # noqa: F401 - the operators take them from here

#: ASCII blanks that separate words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
#: The same set for a regular expression.
BLANK_RE = r"[\x20\x09-\x0D]"
#: Python-side memory bound: rows of a text batch that are turned into Python strings at once.
SLICE_ROWS = 256


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``n``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def pinned(value: Column) -> Column:
    """``value``, computed once for each row: filters on it are not pushed below it, where it would be computed anew."""
    return F.when(F.spark_partition_id() >= 0, value)


def texts(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of Arrow batches with one column as Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            yield part, part.column(part.schema.get_field_index(column)).to_pylist()


class RecentCache(dict):
    """A dictionary of at most about ``2 * most`` entries: when ``most`` are new, the older half goes."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


# ---------------------------------------------------------------- groups of candidates


def grid(rows: DataFrame, key: str, order: str, hot: int, spread: tuple[int, int] = (0, 0)) -> DataFrame:
    """Deals the rows of each key to cells (key, i, j) so that every pair of rows of a key meets in one cell at least.

    A key of up to ``hot`` rows is one cell. A larger one is cut into c chunks and each pair of chunks is a cell, so
    that no cell holds more than about ``2 * hot`` rows, however many rows one key has. No row is dropped. A row goes to
    c cells; ``spread`` (n, rows) cuts smaller keys too, in chunks of ``rows`` as long as they are n at most, so that the
    pairs of a large key are dealt to many tasks before its rows are copied more than n times.
    Adds ``cell_i``, ``cell_j`` and ``chunk`` (the row's own chunk); sorted by cell and ``order`` within partitions.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    chunks = F.ceil(F.col("_n") / F.lit(hot)).cast("int")
    if spread[0]:
        chunks = F.greatest(chunks, F.least(F.ceil(F.col("_n") / F.lit(spread[1])).cast("int"), F.lit(spread[0])))
    dealt = (
        rows.join(sizes, key)
        .withColumn("_c", chunks)
        .withColumn("chunk", F.pmod(F.xxhash64(F.col(order)), F.col("_c")).cast("int"))
        .withColumn("_o", F.explode(F.when(F.col("_c") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_c") - 1))))
        .withColumn("cell_i", F.least("chunk", "_o"))
        .withColumn("cell_j", F.greatest("chunk", "_o"))
        .drop("_o", "_c", "_n")
    )
    return dealt.repartition(key, "cell_i", "cell_j").sortWithinPartitions(key, "cell_i", "cell_j", order)


def cells(batches: Iterable[pa.RecordBatch], key: str, most: int = 200_000) -> Iterator[pa.Table]:
    """Tables of whole cells, from batches sorted by cell. Small cells come together, up to ``most`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < most:
            continue
        table = pa.Table.from_batches(held)
        start = _last_cell(table, key)
        if start:
            yield table.slice(0, start)
        held = table.slice(start).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _last_cell(table: pa.Table, key: str) -> int:
    k, i, j = (table.column(c).to_numpy() for c in (key, "cell_i", "cell_j"))
    same = (k == k[-1]) & (i == i[-1]) & (j == j[-1])
    return int(np.argmax(same))


def starts_of(table: pa.Table, key: str) -> np.ndarray:
    """Where each cell of a table starts, and the number of rows at the end."""
    k, i, j = (table.column(c).to_numpy() for c in (key, "cell_i", "cell_j"))
    new = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    return np.concatenate([[0], new, [len(k)]]).astype(np.int64)


class Forest:
    """Union-find over 0..n-1 that takes links in bulk; the root of a tree is its smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if np.array_equal(p, q):
                self.parent = p
                return p
            p = q

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        while len(u):
            p = self.roots()
            a, b = p[u], p[v]
            open_ = a != b
            if not open_.any():
                return
            u, v, a, b = u[open_], v[open_], a[open_], b[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, name: str, rounds: int = 40) -> DataFrame:
    """Connected components of links (a, b) of longs, as (node, label): label is the smallest node reachable.

    Alternates large-star and small-star steps; every round is written to the shared folder, the round before goes.
    Degrees are never gathered in one row: a round takes a combinable minimum per node and one join, whose hot nodes
    Spark's adaptive skew handling splits (all rows of a node need one minimum alone). An empty input gives no rows.
    """
    spark = edges.sparkSession
    now, path = stored_at(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-links")
    seen = _digest(now)
    for k in range(rounds):
        if not seen[0]:
            break
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = path
        now, path = stored_at(small.union(low.select("a", F.col("m").alias("b"))).distinct(), f"{name}-round{k}")
        removed(spark, before)
        was, seen = seen, _digest(now)
        if was == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return leaves.union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
