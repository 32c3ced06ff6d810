"""Operator 5: vector bin packing of token sequences with the dot-product heuristic.

An example asks for (tokens, one segment, loss-bearing tokens); a sequence has a limit on each. The open sequence takes
the fitting example whose demand has the largest dot product with what is left of the limits, both as shares of the
limits. Plain documents may be cut: what is left of a sequence then takes the head of an example, so sequences are full.

A narrow map over partitions: no shuffle; memory is bounded by a pool of examples. At the end of a partition what is
left is cut at powers of two, which need no padding. Null texts are empty: their one piece is the end id alone.
Repeated rows are packed each on its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts
from .tokens import default_tokenizer, library_bpe

#: The pool is packed when it holds so many examples or tokens.
POOL_EXAMPLES, POOL_TOKENS = 2_048, 4_000_000


class VectorPacker:
    """Packs examples (key, tokens, loss) under limits (tokens, segments, loss).

    ``cut``: examples may be cut; every token then bears loss. Without it an example over the limits raises ValueError.
    Pieces come as (key, start, length, sequence, offset); sequences count up from 0.
    """

    def __init__(self, tokens: int, segments: int, loss: int, cut: bool):
        self.limits, self.cut = np.array([tokens, segments, loss], float), cut
        self.keys: list = []
        self.starts: list[int] = []
        self.sizes: list[tuple[int, int, int]] = []
        self.sequence = 0

    def add(self, key, tokens: int, loss: int, start: int = 0) -> None:
        if not self.cut and (tokens > self.limits[0] or loss > self.limits[2]):
            raise ValueError(f"example {key!r} of {tokens} tokens, {loss} of them with loss, is over the limits")
        self.keys.append(key)
        self.starts.append(start)
        self.sizes.append((tokens, 1, loss))

    def pack(self, last: bool) -> Iterator[tuple]:
        """Pieces of all sequences that are full; with ``last``, of all that is left too."""
        n = len(self.keys)
        size, starts, keys = np.array(self.sizes, float).reshape(n, 3), self.starts, self.keys
        free = np.ones(n, bool)
        whole = int(self.limits[0]) if self.cut else 0
        while True:
            left, taken = self.limits.copy(), []
            undo = free.copy(), size.copy(), list(starts)
            while left[1] >= 1:
                fits = free & (size <= left).all(axis=1)
                if fits.any():
                    score = np.where(fits, (size / self.limits) @ (left / self.limits), -1.0)
                    i = int(score.argmax())
                    taken.append((keys[i], starts[i], int(size[i, 0])))
                    left -= size[i]
                    free[i] = False
                elif self.cut and free.any() and (room := int(min(left[0], left[2]))) > 0:
                    i = int(np.where(free, size[:, 0], -1.0).argmax())
                    taken.append((keys[i], starts[i], room))
                    left -= (room, 1, room)
                    size[i] -= (room, 0, room)
                    starts[i] += room
                else:
                    break
            if not taken:
                break
            if not last and not free.any() and (not self.cut or sum(t[2] for t in taken) < whole):
                free, size, starts = undo  # not full: wait for more examples
                break
            yield from self._place(taken, last and self.cut and not free.any())
        at = np.flatnonzero(free)
        self.keys, self.starts = [keys[i] for i in at], [starts[i] for i in at]
        self.sizes = [tuple(int(x) for x in size[i]) for i in at]

    def _place(self, taken: list[tuple], tail: bool) -> Iterator[tuple]:
        total, limit = sum(t[2] for t in taken), int(self.limits[0])
        ends = [total]
        if tail and total < limit:  # cut at powers of two, the largest first
            ends = list(np.cumsum([1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]))
        begin, offset = 0, 0
        for key, start, length in taken:
            placed = False
            while length or not placed:  # an example without tokens has a place too
                placed = True
                part = min(length, int(ends[0]) - begin)
                yield key, start, part, self.sequence, offset
                begin, offset, start, length = begin + part, offset + part, start + part, length - part
                if begin == ends[0] and len(ends) > 1:
                    ends.pop(0)
                    self.sequence, offset = self.sequence + 1, 0
        self.sequence += 1


def pack_documents(docs: DataFrame, path: str | None = None, *, tokens: int = 4096, segments: int = 512, end_id: int = 2) -> DataFrame:
    """Pieces of all documents, each with its end id, in sequences of at most ``tokens`` tokens and ``segments`` pieces.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A sequence's id holds its partition.
    """
    path = path or default_tokenizer()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = library_bpe(path), np.array([end_id], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 32
        packer, pool, held = VectorPacker(tokens, segments, tokens, cut=True), {}, 0
        n = 0

        def batch(pieces) -> Iterator[pa.RecordBatch]:
            rows = [(pool[k][0], s, m, zlib.crc32(pool[k][1][4 * s : 4 * (s + m)]), len(pool[k][1]) // 4, base | q, o) for k, s, m, q, o in pieces]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            yield from batch(packer.pack(last))
            for k in set(pool).difference(packer.keys):
                del pool[k]
            held = sum(t for t, _, _ in packer.sizes)

        for part, rows in texts(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), rows, strict=True):
                raw = bpe.encode(text) + end
                size = len(raw) // 4
                pool[n] = (doc_id, raw)
                for start in range(0, size, tokens):  # each full length asks for a sequence of its own
                    part_size = min(tokens, size - start)
                    packer.add(n, part_size, part_size, start)
                    held += part_size
                n += 1
                if len(packer.keys) >= POOL_EXAMPLES or held >= POOL_TOKENS:
                    yield from flush(False)
        yield from flush(True)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, ", ".join(f"`{c}` long" for c in names))


def pack_examples(examples: DataFrame, *, key: str, tokens: str, loss: str, max_tokens: int, max_segments: int, max_loss: int) -> DataFrame:
    """Places whole instruction examples: adds nothing, returns (key, sequence_id, offset).

    An example over the limits fails the job: it can lie in no sequence. Null counts are 0.
    """
    kind = examples.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        packer = VectorPacker(max_tokens, max_segments, max_loss, cut=False)

        def out(last: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
            rows = [(k, base | q, o) for k, _, _, q, o in packer.pack(last)]
            if rows:
                k, q, o = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, schema.field(0).type), pa.array(q, pa.int64()), pa.array(o, pa.int64())], names=["key", "sequence_id", "offset"])

        schema = None
        for b in batches:
            schema = b.schema
            for k, t, m in zip(*(c.to_pylist() for c in b.columns), strict=True):
                packer.add(k, t, m)
                if len(packer.keys) >= POOL_EXAMPLES:
                    yield from out(False, schema)
        if schema is not None:
            yield from out(True, schema)

    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long"))
    return examples.select(F.col(key).alias("key"), count(tokens).alias("t"), count(loss).alias("m")).mapInArrow(run, f"key {kind}, sequence_id long, offset long").withColumnRenamed("key", key)


def turn_counts(turns: DataFrame, path: str | None = None) -> DataFrame:
    """(conv_id, n, m) of each turn (conv_id, role, text): its tokens with an end id, and those with loss: the assistant's."""
    path = path or default_tokenizer()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = library_bpe(path)
        for part, rows in texts(batches):
            n = np.array([len(bpe.encode(t)) // 4 + 1 for t in rows], np.int64)
            own = np.array([r == "assistant" for r in part.column(1).to_pylist()], bool)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(np.where(own, n, 0))], names=["conv_id", "n", "m"])

    given = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, "conv_id long, n long, m long")


def pack_conversations(turns: DataFrame, path: str | None = None, *, max_tokens: int = 4096, max_segments: int = 16, max_loss: int = 3072) -> DataFrame:
    """Packs whole conversations under three limits: conv_id, n_tokens, n_loss, sequence_id, offset.

    A turn is its tokens and an end id; the assistant's bear loss. Turns of a conversation are counted before the shuffle,
    so a conversation of very many turns is no large group. One over a limit can lie in no sequence: its sequence_id and
    offset are null. Null texts are empty, null roles bear no loss, null ids are one conversation; an empty table gives
    no rows.
    """
    whole = turn_counts(turns, path).groupBy("conv_id").agg(F.sum("n").alias("n_tokens"), F.sum("m").alias("n_loss"))
    whole = stored(whole, "conversations")
    fits = (F.col("n_tokens") <= max_tokens) & (F.col("n_loss") <= max_loss)
    example = F.struct("conv_id", "n_tokens", "n_loss").alias("example")
    placed = pack_examples(whole.where(fits).select(example, "n_tokens", "n_loss"), key="example", tokens="n_tokens", loss="n_loss", max_tokens=max_tokens, max_segments=max_segments, max_loss=max_loss)
    placed = placed.select("example.*", "sequence_id", "offset")
    return placed.unionByName(whole.where(~fits), allowMissingColumns=True)
