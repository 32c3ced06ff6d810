"""Operator 3: SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints: each bit is set if it is set in over half of the XXH64 (seed 42) hashes of a text's word 3-grams, repeats
included. Equal fingerprints become one class. The classes are sorted by Gray rank and cut in ranges; each range is
searched with one hierarchical index: neighbours in Gray order are grouped, the masked bit patterns that a group shares
are factored into its node, and whole groups are pruned by the differences accumulated on the way down. Nothing else
finds or compares pairs, whatever the size of a range.

So that a range needs no other range, the classes are sorted once for each rotation: of two fingerprints that differ in
at most ``distance`` bits, cut in ``blocks`` blocks of bits, at least ``blocks - distance`` blocks agree; a rotation puts
one choice of blocks on top, and fingerprints that agree on top have neighbouring Gray ranks and fall in one range. A
range's width is set by the number of classes (about ``cell`` in each). A range yields a spanning forest of its links,
never all pairs; one that holds far more classes than others is dealt to a grid of cells. No link is lost.

Texts without words (null too) have fingerprint zero and link like any other; a text of any length takes memory for its
own words alone. Rows that repeat a doc_id are rows of one document. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANK_RE, Forest, cells, components, grid, starts_of, stored, texts

SEED, SHINGLE, BITS = 42, 3, 64
_BLANKS = re.compile(BLANK_RE.encode() + b"+")
#: bits of each byte, lowest first
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def shingle_hashes(text: str | None) -> np.ndarray:
    """Unsigned XXH64 of the 3-word shingles of a text, in order."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z alone
    words = [w for w in _BLANKS.split(raw) if w]
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts, h, s = [0, *[e + 1 for e in ends]], xxhash.xxh64_intdigest, SEED
    return np.array([h(joined[a:b], s) for a, b in zip(starts, ends[SHINGLE - 1 :])], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Majority bits; no hashes give zero. Counts by byte value, so memory does not grow with the text."""
    n = len(hashes)
    if not n:
        return 0
    by_byte = np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(n, 8)
    bits = np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * bits > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): fp as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in texts(batches):
            fp = np.array([fingerprint(shingle_hashes(t)) for t in rows], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order under nodes of ``fanout``; a node holds the bits its codes share and its parent's do not."""

    def __init__(self, codes: np.ndarray, fanout: int = 4):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes, self.fanout, self.levels = codes[self.order], fanout, []
        ones, zeros = self.codes, ~self.codes  # bits set, and unset, in all codes of a node
        while len(ones) > 1 or not self.levels:
            cut = np.arange(0, len(ones), fanout)
            ones, zeros = np.bitwise_and.reduceat(ones, cut), np.bitwise_and.reduceat(zeros, cut)
            self.levels.append([ones, ones | zeros])
        for (_, mask), (_, above) in zip(self.levels, self.levels[1:]):
            mask &= ~above[np.arange(len(mask)) // fanout]  # what the parent has counted is counted once
        self.shared = self._accumulated()
        #: Nodes and codes looked at, and pairs found: what the index did.
        self.visited = self.found = 0

    def _accumulated(self) -> np.ndarray:
        """The bits that the lowest nodes and all above them hold together."""
        total = self.levels[-1][1]
        for _, mask in reversed(self.levels[:-1]):
            total = mask | total[np.arange(len(mask)) // self.fanout]
        return total

    def within(self, queries: np.ndarray, distance: int, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) places of all pairs at most ``distance`` apart.

        ``after``: of each query, a place in Gray order; only codes behind it are sought, and groups before it pruned.
        """
        f, n = self.fanout, len(self.codes)
        q = np.arange(len(queries))
        node, diff = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, mask = self.levels[depth]
            self.visited += len(node)
            diff = diff + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            keep = diff <= distance
            if after is not None:
                keep &= (node + 1) * f ** (depth + 1) > after[q] + 1
            q, node, diff = self._down(q[keep], node[keep], diff[keep], len(self.levels[depth - 1][0]) if depth else n)
        self.visited += len(node)
        rest = ~self.shared[node // f]
        keep = diff + np.bitwise_count((queries[q] ^ self.codes[node]) & rest) <= distance
        if after is not None:
            keep &= node > after[q]
        self.found += int(keep.sum())
        return q[keep], self.order[node[keep]]

    def _down(self, q, node, diff, below: int):
        f = self.fanout
        child = (node[:, None] * f + np.arange(f)).ravel()
        inside = child < below
        return np.repeat(q, f)[inside], child[inside], np.repeat(diff, f)[inside]


def forest_of(codes: np.ndarray, chunk: np.ndarray, distance: int, frontier: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Links (place, place of its root) that span the groups of one cell; of a cell of two chunks, by links across.

    Queries go down in steps, so that no step can hold more than about ``frontier`` nodes.
    """
    n, forest = len(codes), Forest(len(codes))
    step = max(1, frontier // n)
    if (chunk == chunk[0]).all():
        index = GrayIndex(codes)
        for at in range(0, n, step):  # in Gray order, each with the codes behind it
            place = np.arange(at, min(n, at + step))
            q, c = index.within(index.codes[place], distance, place)
            forest.link(index.order[place[q]], c)
    else:
        asked, there = np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk != chunk.min())
        index = GrayIndex(codes[there])
        for at in range(0, len(asked), step):
            some = asked[at : at + step]
            q, c = index.within(codes[some], distance)
            forest.link(some[q], there[c])
    roots = forest.roots()
    moved = np.flatnonzero(roots != np.arange(n))
    return moved, roots[moved]


class Rotations:
    """One permutation of bits for each choice of ``blocks - distance`` blocks: the chosen ones come on top."""

    def __init__(self, blocks: int, distance: int):
        edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
        part = list(itertools.pairwise(edges))
        self.moves: list[list[tuple[int, int, int]]] = []
        self.top = BITS  # bits on top in every rotation
        for chosen in itertools.combinations(range(blocks), blocks - distance):
            place, moves = BITS, []
            for i in [*chosen, *(i for i in range(blocks) if i not in chosen)]:
                low, high = part[i]
                place -= high - low
                moves.append((low, high - low, place))
            self.moves.append(moves)
            self.top = min(self.top, sum(part[i][1] - part[i][0] for i in chosen))

    def turned(self, codes: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros_like(codes)
        for low, width, place in self.moves[n]:
            out |= ((codes >> np.uint64(low)) & np.uint64((1 << width) - 1)) << np.uint64(place)
        return out


def layout(classes: int, distance: int, blocks: int | None, cell: int) -> tuple[int, int]:
    """(blocks, bits): into how many blocks fingerprints are cut, and the top bits of Gray rank that make a range.

    Ranges hold about ``cell`` classes. The fewest blocks whose top bits allow that are taken; more blocks have more
    on top, and more rotations.
    """
    bits = max(0, math.ceil(math.log2(max(1, classes) / cell)))
    tried = [blocks] if blocks else range(distance + 1, distance + 5)
    for b in tried:
        top = Rotations(b, distance).top
        if bits <= top:
            return b, bits
    return b, top


def links(classes: DataFrame, distance: int = 3, blocks: int | None = None, cell: int = 4096, hot: int = 8192) -> DataFrame:
    """Links (a, b) of fingerprints (column ``fp``, distinct) that span all groups at most ``distance`` bits apart."""
    blocks, bits = layout(classes.count(), distance, blocks, cell)
    rotations = Rotations(blocks, distance)

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for n in range(len(rotations.moves)):
                rank = gray_rank(rotations.turned(codes, n))
                key = (rank >> np.uint64(BITS - bits) if bits else np.zeros_like(rank)).view(np.int64) | np.int64(n << 48)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(codes.view(np.int64))], names=["key", "fp"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in cells(batches, "key"):
            codes, chunk, key = (table.column(c).to_numpy() for c in ("fp", "chunk", "key"))
            codes, starts = codes.view(np.uint64), starts_of(table, "key")
            found = []
            for s, e in itertools.pairwise(starts.tolist()):
                own = rotations.turned(codes[s:e], int(key[s]) >> 48)
                a, b = forest_of(own, chunk[s:e], distance)
                found.append((codes[s:e][a], codes[s:e][b]))
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = grid(classes.select("fp").mapInArrow(spread, "key long, fp long"), "key", "fp", hot)
    return dealt.select("key", "cell_i", "cell_j", "chunk", "fp").mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, distance: int = 3, blocks: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links)."""
    prints = stored(fingerprints(docs), "simhash")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    labels = components(links(classes, distance, blocks), "simhash")
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    lowest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of = named.join(lowest, "label").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates, one row, with the smallest doc_id.

    Of rows that repeat that doc_id the one stays whose text, then whole row as JSON, is the least. Rows without a
    doc_id cannot be named as a group's first, and all stay. Columns may have any names.
    """
    names = docs.columns
    rows = docs.toDF(*[f"_in_{c}" for c in names])
    kept = near_duplicates(docs.select("doc_id", "text"), **how).where("doc_id = component_id")
    kept = stored(kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).select(F.col("doc_id").alias("kept_id"), "times"), "simhash-kept")
    # ids kept grow with the documents, so they are never broadcast
    found = rows.join(kept.hint("merge"), F.col("_in_doc_id").cast("long") == F.col("kept_id"))
    own = [F.col(f"_in_{c}").alias(c) for c in names]
    parts = [found.where("times = 1").select(*own)]
    if not kept.where("times > 1").isEmpty():  # a part that no row is in need not be planned
        whole = F.struct(*[f"_in_{c}" for c in names])
        repeated = found.where("times > 1").groupBy("kept_id").agg(F.min_by(whole, F.struct("_in_text", F.to_json(whole))).alias("row"))
        parts.append(repeated.select(*[F.col("row")[f"_in_{c}"].alias(c) for c in names]))
    if not docs.where("doc_id IS NULL").isEmpty():
        parts.append(rows.where("_in_doc_id IS NULL").select(*own))
    return reduce(DataFrame.unionByName, parts)
