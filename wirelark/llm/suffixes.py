"""Operator 12: removal of byte strings that repeat across documents, by difference-cover suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller doc_id goes. Sorting all
suffixes of a corpus would move a row for each byte several times, so what cannot repeat is set aside first, without loss:

1. *Anchors.* The anchor of a string of ``length`` bytes is the least hash of its ``GRAM``-byte grams, so equal strings
   have equal anchors. Neighbouring strings mostly share theirs: one in sixteen has a new one. Strings whose anchor stands
   in one document alone are dropped.
2. *Contexts.* Neighbouring strings with one anchor are a run of bytes, their context. Equal contexts (their anchors are
   equal, too) are one class with its smallest doc_id: copies are all removed but for that document's.
3. *Suffix sorting.* The contexts of an anchor go to one task, once, which sorts the suffixes of many anchors' classes
   together by the difference-cover algorithm: triples at two of three places are sorted and named, names are sorted by
   recursion until they span ``length`` bytes, the remaining suffixes are merged in, and the prefixes of neighbours are
   compared. Neighbours with equal prefixes of ``length`` bytes are one string; its smallest doc_id decides for every class.

An anchor with more than ``hot`` contexts (a passage that very many documents share) has its equal contexts combined before
the shuffle; with more than ``hot`` classes even then (the edge of such a passage) it is cut into its single strings, which
are grouped by themselves, combined before the shuffle too. So no task holds them all.

Texts are UTF-8 bytes; null is the empty text; texts shorter than ``length`` lose nothing. Rows that repeat a doc_id are
one document: they do not remove from one another. Null ids count as one document after all others. Equal rows get equal
rows. A text of any length takes memory for itself alone. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import tidy
from .common import stored

LENGTH, GRAM = 50, 20
#: Contexts or classes of an anchor that one task sorts together, and bytes of classes, or of contexts, sorted at once.
HOT, CELL, WIDE_CELL = 10_000, 1 << 20, 4 << 20
#: Shares of the anchors that are settled one after another.
SHARES = 4
#: Texts hashed at once, in bytes: what the passes over them hold stays in a core's cache.
_SLICE = 1 << 19
_NO_ID = (1 << 63) - 1
_BYTES = np.random.default_rng(12).integers(1, 1 << 63, 256, np.uint64, endpoint=False) | np.uint64(1)
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- anchors


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each place."""
    n = len(data) - gram + 1
    if n < 1:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power, width, now, out, at = _BASE, 1, _BYTES[data], None, 0
        while True:  # doubled widths, put together as the bits of ``gram`` say
            if gram & width:
                part = now[at : at + n]
                out = part.copy() if out is None else out * power + part
                at += width
            if width * 2 > gram:
                break
            now = now[:-width] * power + now[width:]
            power, width = power * power, width * 2
        out ^= out >> np.uint64(29)
        out *= _MIX
        out ^= out >> np.uint64(32)
    return out


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of the ``width`` values from each place on."""
    n, w = len(x) - width + 1, 1
    while w * 2 <= width:
        x, w = best(x[:-w], x[w:]), w * 2
    return best(x[:n], x[width - w : width - w + n]) if w < width else x[:n]


def runs_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, strings, anchor): neighbouring strings with one anchor, in texts that lie one behind the other.

    ``ends``: where the texts end, each of ``length`` bytes or more. A run has no more strings than a string has grams.
    """
    grams = length - gram + 1
    least = _sliding(gram_hashes(data, gram), grams, np.minimum)
    inside = np.ones(len(least), bool)
    for end in ends.tolist():  # no string crosses the end of a text
        inside[end - length + 1 : end] = False
    new = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])]))
    size = np.diff(np.append(new, len(least)))
    keep = inside[new]
    new, size = new[keep], size[keep]
    if len(size) and size.max() > grams:  # grams that come again and again
        pieces = -(-size // grams)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(new, pieces) + nth * grams
        new, size = start, np.minimum(np.repeat(new + size, pieces) - start, grams)
    return new, size, least[new]


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, ends) of neighbouring rows of a column of bytes, about ``_SLICE`` bytes at once."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        upto = max(row + 1, int(np.searchsorted(bounds, bounds[row] + _SLICE, side="right")) - 1)
        yield row, data[bounds[row] : bounds[upto]], bounds[row + 1 : upto + 1] - bounds[row]
        row = upto


def repeated_anchors(texts: DataFrame, length: int, gram: int, per_task: int = 2_000_000) -> DataFrame:
    """(doc, anchor): the hashes of each document's anchors that stand in another document too.

    A batch settles what its own documents share, so a batch sends each hash once, however common it is.
    """
    total = texts.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, math.ceil(total / 16 / per_task))

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, hashes, owners = batch.column(0).to_numpy(), [], []
            for row, data, ends in slices(batch.column(1)):
                start, _, h = runs_of(data, ends, length, gram)
                hashes.append(h)
                owners.append(docs[row + np.searchsorted(ends, start, side="right")])
            h, doc = np.concatenate([np.empty(0, np.uint64), *hashes]), np.concatenate([np.empty(0, np.int64), *owners])
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            first = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
            fresh = first | np.concatenate([[True], doc[1:] != doc[:-1]])[: len(h)]
            h, doc, first = h[fresh], doc[fresh], first[fresh]
            size = np.diff(np.append(np.flatnonzero(first), len(h)))
            shared = np.repeat(size > 1, size)
            # 0: to be settled with other batches; 1: stands for an anchor that is known to repeat; 2: settled
            kind = np.concatenate([np.zeros(int((~shared).sum()), np.uint8), np.ones(int((shared & first).sum()), np.uint8), np.full(int(shared.sum()), 2, np.uint8)])
            h, doc = (np.concatenate([x[~shared], x[shared & first], x[shared]]) for x in (h, doc))
            with np.errstate(over="ignore"):
                task = np.where(kind == 2, doc.view(np.uint64) * _MIX, h * _MIX) >> np.uint64(33)
            task = (task % np.uint64(tasks)).astype(np.int32)
            order = np.lexsort((doc, task))  # neighbours of one document compress well
            h, doc, kind, task = (x[order] for x in (h, doc, kind, task))
            new = np.flatnonzero(np.diff(task, prepend=-1))
            for a, b in zip(new, np.append(new[1:], len(task)), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((int(task[a]), h[a:b].tobytes(), doc[a:b].tobytes(), kind[a:b].tobytes()), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["task", "anchors", "docs", "kinds"])

    def settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        if not held:
            return
        h, doc, kind = (np.frombuffer(b"".join(c), t) for c, t in zip(zip(*held, strict=True), (np.uint64, np.int64, np.uint8), strict=True))
        ready, h, doc, kind = (h[kind == 2], doc[kind == 2]), h[kind < 2], doc[kind < 2], kind[kind < 2]
        order = np.argsort(h, kind="stable")
        h, doc, kind = h[order], doc[order], kind[order]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
        if len(start):
            several = (np.maximum.reduceat(doc, start) != np.minimum.reduceat(doc, start)) | (np.maximum.reduceat(kind, start) > 0)
            keep = np.repeat(several, np.diff(np.append(start, len(h)))) & (kind == 0)
            ready = np.concatenate([ready[0], h[keep]]), np.concatenate([ready[1], doc[keep]])
        for at in range(0, len(ready[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(ready[1][at : at + 100_000]), pa.array(ready[0][at : at + 100_000].view(np.int64))], names=["doc", "anchor"])

    sent = texts.select("doc", "raw").mapInArrow(found, "task int, anchors binary, docs binary, kinds binary")
    return sent.repartitionById(tasks, "task").select("anchors", "docs", "kinds").mapInArrow(settled, "doc long, anchor long")


# ---------------------------------------------------------------- contexts


def contexts(texts: DataFrame, anchors: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, context, doc, text_key, at, strings): the strings that may repeat, by their anchor.

    A context holds ``strings`` strings of ``length`` bytes, at consecutive places from ``at`` on.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys, known = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            for row, data, ends in slices(batch.column(2)):
                lo, strings, h = runs_of(data, ends, length, gram)
                doc = np.searchsorted(ends, lo, side="right")
                own = np.zeros(len(h), bool)
                for r in np.unique(doc).tolist():
                    a, b = np.searchsorted(doc, [r, r + 1])
                    own[a:b] = np.isin(h[a:b].view(np.int64), known[row + r].values.to_numpy())
                lo, strings, h, doc = lo[own], strings[own], h[own], doc[own]
                if not len(lo):
                    continue
                size = strings + length - 1
                offsets = np.concatenate([[0], np.cumsum(size)])
                taken = data[np.repeat(lo - offsets[:-1], size) + np.arange(offsets[-1])]
                begin = np.concatenate([[0], ends])[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)), pa.Array.from_buffers(pa.binary(), len(lo), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(taken)]),
                        pa.array(docs[row + doc]), pa.array(keys[row + doc]), pa.array(lo - begin), pa.array(strings.astype(np.int32)),
                    ],
                    names=["anchor", "context", "doc", "text_key", "at", "strings"],
                )

    of_doc = anchors.groupBy("doc").agg(F.collect_list("anchor").alias("anchors"))
    # the documents that share something grow with the corpus, so they are never broadcast
    both = texts.join(of_doc.hint("merge"), "doc").select("doc", "text_key", "raw", "anchors")
    return both.mapInArrow(run, "anchor long, context binary, doc long, text_key long, at long, strings int")


# ---------------------------------------------------------------- suffix sorting


def suffix_ranks(s: np.ndarray, spans: int, depth: int) -> np.ndarray:
    """The place of each suffix among all, equal where ``depth`` bytes or more from its start are equal.

    ``s``: symbols from 1 on, below 2^21, of ``spans`` bytes each. Difference cover {1, 2} modulo 3: triples at those
    places are sorted and named; unless names are unique or span ``depth``, the string of names is ranked by recursion.
    """
    n = len(s)
    if n % 3 == 1:  # the places 1 modulo 3 end with a triple that runs over the end
        return suffix_ranks(np.append(s, 0), spans, depth)[:n]
    s = np.concatenate([s, [0, 0, 0]])
    one, two, zero = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sampled = np.concatenate([one, two])
    _, names = np.unique(s[sampled] << 42 | s[sampled + 1] << 21 | s[sampled + 2], return_inverse=True)
    names = names + 1
    if spans * 3 < depth and len(names) and names.max() < len(names):
        names = suffix_ranks(names, spans * 3, depth) + 1
    rank = np.zeros(n + 3, np.int64)
    rank[sampled] = names
    # the remaining suffixes are ordered by one symbol, or by two, and a sampled suffix
    by_one = lambda i: s[i] << 21 | rank[i + 1]
    by_two = lambda i: s[i] << 42 | s[i + 1] << 21 | rank[i + 2]
    orders, keys = zip(*((order, key[order]) for key in (by_one(zero), by_one(one), by_two(zero), by_two(two)) for order in [np.argsort(key)]), strict=True)
    zero_one, one_one, zero_two, two_two = keys  # what is looked up in order is found without jumping about
    size = np.bincount(names)
    out = np.empty(n, np.int64)
    out[sampled] = (np.cumsum(size) - size)[names]
    out[zero[orders[0]]] = np.searchsorted(zero_one, zero_one) + np.searchsorted(one_one, zero_one)
    out[one[orders[1]]] += np.searchsorted(zero_one, one_one)
    out[zero[orders[2]]] += np.searchsorted(two_two, zero_two)
    out[two[orders[3]]] += np.searchsorted(zero_two, two_two)
    return out


def ranks_of_bytes(data: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes of ``data``. A symbol is two bytes: the string of even places, an end, the string of odd ones."""
    wide = np.concatenate([data, [0, 0]]).astype(np.int64)
    pairs = (wide[:-1] << 8 | wide[1:])[: len(data)] + 1
    ranks = suffix_ranks(np.concatenate([pairs[0::2], [0], pairs[1::2]]), 2, depth)
    out, half = np.empty(len(data), np.int64), len(pairs[0::2])
    out[0::2], out[1::2] = ranks[:half], ranks[half + 1 :]
    return out


def repeats(contexts_: list[bytes], first: np.ndarray, length: int) -> np.ndarray:
    """Of each context, as bits, the strings that stand in a context with a smaller ``first`` too."""
    data = np.frombuffer(b"".join(contexts_), np.uint8)
    size = np.array([len(c) for c in contexts_])
    begin, strings = np.cumsum(size) - size, size - length + 1
    owner = np.repeat(np.arange(len(size)), strings)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    place = begin[owner] + nth
    order = np.argsort(ranks_of_bytes(data, length)[place], kind="stable")
    start, same = place[order], np.ones(max(0, len(order) - 1), bool)
    for k in range(0, length - 7, 7):  # neighbours' prefixes, eight bytes at once
        same &= _eight(data, start[1:] + k) == _eight(data, start[:-1] + k)
    same &= _eight(data, start[1:] + length - 8) == _eight(data, start[:-1] + length - 8)
    group = np.flatnonzero(np.concatenate([[True], ~same]))
    least = np.repeat(np.minimum.reduceat(first[owner[order]], group), np.diff(np.append(group, len(order))))
    bits = np.zeros(len(size), np.int64)
    hit = least < first[owner[order]]
    np.bitwise_or.at(bits, owner[order][hit], np.int64(1) << nth[order][hit])
    return bits


def _eight(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, 8)[at].copy().view(np.uint64)[:, 0]


def _by_anchor(batches: Iterable[pa.RecordBatch], cell: int, sort: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``sort`` of rows in order of their first column, the anchor, of about ``cell`` bytes at once; no anchor is cut in two."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < cell:
            continue
        table = pa.Table.from_batches(held)
        anchor = table.column(0).to_numpy()
        last = int(np.argmax(anchor == anchor[-1]))  # where the last anchor's rows, perhaps not all there, begin
        if last:
            yield sort(table.slice(0, last))
        held = table.slice(last).combine_chunks().to_batches()
        size = sum(b.nbytes for b in held)
    if held and (table := pa.Table.from_batches(held)).num_rows:
        yield sort(table)


def judged(classes: DataFrame, length: int, cell: int = CELL) -> DataFrame:
    """(anchor, key, first, bits) of classes (anchor, context, first): the strings that a smaller document has too."""

    def sort(table: pa.Table) -> pa.RecordBatch:
        anchor, first = table.column(0).to_numpy(), table.column(3).to_numpy()
        bits = np.zeros(len(anchor), np.int64)
        alike = anchor[1:] == anchor[:-1]
        several = np.flatnonzero(np.concatenate([[False], alike]) | np.concatenate([alike, [False]]))
        if len(several):
            bits[several] = repeats(table.column(1).take(pa.array(several)).to_pylist(), first[several], length)
        return pa.RecordBatch.from_arrays([pa.array(anchor), table.column(2).combine_chunks(), pa.array(first), pa.array(bits)], names=["anchor", "key", "first", "bits"])

    dealt = classes.select("anchor", "context", "key", "first").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(lambda batches: _by_anchor(batches, cell, sort), "anchor long, key long, first long, bits long")


def judged_rows(some: DataFrame, length: int, cell: int = WIDE_CELL) -> DataFrame:
    """(doc, text_key, at, bits) of contexts: the strings that go, where some do. Contexts are shuffled once."""

    def sort(table: pa.Table) -> pa.RecordBatch:
        anchor, doc = table.column(0).to_numpy(), table.column(2).to_numpy()
        encoded = table.column(1).combine_chunks().dictionary_encode()
        encoded = encoded.combine_chunks() if isinstance(encoded, pa.ChunkedArray) else encoded
        of, classes = encoded.indices.to_numpy(), encoded.dictionary  # a class is its context, which tells its anchor
        first = np.full(len(classes), _NO_ID)
        np.minimum.at(first, of, doc)
        whose = np.empty(len(classes), np.int64)
        whose[of] = anchor
        order = np.argsort(whose, kind="stable")
        start = np.flatnonzero(np.concatenate([[True], whose[order][1:] != whose[order][:-1]]))
        low, high = (f.reduceat(first[order], start) for f in (np.minimum, np.maximum))
        # classes that one document leads have no string of a smaller one
        several = np.sort(order[np.repeat(low < high, np.diff(np.append(start, len(order))))])
        bits = np.zeros(len(classes), np.int64)
        if len(several):
            bits[several] = repeats(classes.take(pa.array(several)).to_pylist(), first[several], length)
        strings = np.diff(np.frombuffer(classes.buffers()[1], np.int32)[classes.offset : classes.offset + len(classes) + 1]) - length + 1
        every = (np.int64(1) << strings.astype(np.int64)) - 1
        row = np.where(doc > first[of], every[of], bits[of])
        gone = np.flatnonzero(row)
        return pa.RecordBatch.from_arrays([pa.array(doc[gone]), *(table.column(i).combine_chunks().take(pa.array(gone)) for i in (3, 4)), pa.array(row[gone])], names=["doc", "text_key", "at", "bits"])

    dealt = some.select("anchor", "context", "doc", "text_key", "at").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(lambda batches: _by_anchor(batches, cell, sort), "doc long, text_key long, at long, bits long")


def judged_apart(classes: DataFrame, length: int) -> DataFrame:
    """What ``judged`` gives, for anchors of very many classes: each string is grouped by itself."""
    nth = F.explode(F.sequence(F.lit(0), F.octet_length("context") - length)).alias("nth")
    single = classes.select("anchor", "key", "first", "context", nth).withColumn("string", F.expr(f"substring(context, nth + 1, {length})")).drop("context")
    least = single.groupBy("anchor", "string").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hit = F.pow(F.lit(2.0), F.col("nth")).cast("long")
    return single.join(least.hint("merge"), ["anchor", "string"]).where("least < first").groupBy("anchor", "key", "first").agg(F.sum(hit).alias("bits"))


# ---------------------------------------------------------------- removal


def _texts(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("raw"))
    return named.select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), F.xxhash64("raw").alias("text_key"), "raw")


def removed_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, shares: int = SHARES) -> DataFrame:
    """(doc, text_key, at, bits): of the contexts of each text, the strings that go.

    Anchors are settled in ``shares`` equal shares one after another, so scratch disks hold the shuffles of one share.
    """
    texts = _texts(docs)
    long_ = texts.where(F.octet_length("raw") >= length).select("doc", "text_key", "raw")
    share = F.pmod(F.xxhash64(F.lit("share"), F.col("anchor")), F.lit(shares))
    some = stored(contexts(long_, repeated_anchors(long_, length, gram), length, gram), "suffix-contexts")
    crowded = stored(some.groupBy("anchor").count().where(F.col("count") > hot), "suffix-crowded")
    rows = crowded.agg(F.sum("count")).first()[0] or 0
    usual = some.join(crowded, "anchor", "left_anti") if rows else some
    found = [stored(judged_rows(usual.where(share == k), length), "suffix-found") for k in range(shares)]
    if rows:  # in as many turns as its part of the rows is of the shares
        turns = math.ceil(shares * rows / some.count())
        turn, apart = F.pmod(F.xxhash64(F.lit("turn"), F.col("anchor")), F.lit(turns)), some.join(crowded, "anchor", "left_semi")
        found += [stored(_settled(apart.where(turn == k), length, hot), "suffix-found") for k in range(turns)]
    return reduce(DataFrame.unionByName, found)


def _settled(some: DataFrame, length: int, hot: int) -> DataFrame:
    """(doc, text_key, at, bits) of the contexts of anchors that have very many: equal contexts combine before the shuffle."""
    some = some.withColumn("key", F.xxhash64("context"))
    classes = some.groupBy("anchor", "context").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes.withColumn("key", F.xxhash64("context")), "suffix-classes")
    sizes = stored(classes.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), "suffix-hot")
    usual = classes if sizes.isEmpty() else classes.join(sizes.hint("merge"), "anchor", "left_anti")
    verdicts = judged(usual, length).where("bits <> 0").select("anchor", "key", "bits")
    if not sizes.isEmpty():
        verdicts = verdicts.unionByName(judged_apart(classes.join(sizes.hint("merge"), "anchor"), length).select("anchor", "key", "bits"))
    told = classes.select("anchor", "key", "first", "n").join(stored(verdicts, "suffix-verdicts").hint("merge"), ["anchor", "key"], "left").where("n > 1 OR bits IS NOT NULL")
    every = F.pow(F.lit(2.0), F.col("strings")).cast("long") - 1  # exact: 62 strings at most
    bits = F.when(F.col("doc") > F.col("first"), every).otherwise(F.coalesce("bits", F.lit(0).cast("long")))
    rows = some.drop("context").join(told.select("anchor", "key", "first", "bits").hint("merge"), ["anchor", "key"]).select("doc", "text_key", "at", bits.alias("bits"))
    return rows.where("bits <> 0")


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, shares: int = SHARES) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay)."""
    if not 8 <= gram <= length - 1 or length - gram + 1 > 62:
        raise ValueError("a string holds its grams at 62 places or fewer")
    with tidy(docs.sparkSession):  # each table is made from stored ones, and large shuffles need not wait for garbage
        strings = removed_strings(docs, length, gram, hot, shares)
        found = stored(strings.groupBy("doc", "text_key").agg(F.collect_list(F.struct("at", "bits")).alias("found")), "suffix-texts")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.arange(63)
        for batch in batches:
            out = []
            for raw, has in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if not has.is_valid:
                    out.append((len(raw), 0, 0, raw))
                    continue
                at, bits = (has.values.field(k).to_numpy() for k in (0, 1))
                row, nth = np.nonzero(bits[:, None] >> places & 1)
                start = at[row] + nth
                step = np.bincount(start, minlength=len(raw) + 1) - np.bincount(start + length, minlength=len(raw) + 1)
                gone = np.cumsum(step[: len(raw)]) > 0
                spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                out.append((len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    whole = _texts(docs).join(found.hint("merge"), ["doc", "text_key"], "left").select("doc_id", "raw", "found")
    return whole.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame, **how) -> DataFrame:
    """The columns of ``deduplicated`` with the SHA-256 of what stays in place of the bytes."""
    return deduplicated(docs, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT r, k, b, substr(h, b + 1, 4098) AS g FROM (SELECT r, k, h, unnest(range(0, greatest(length(h) - 98, 1), 4000)) AS b FROM d)),
p AS MATERIALIZED (SELECT r, k, b // 2 + i AS i, substr(g, 2 * i - 1, 100) AS w FROM (SELECT r, k, b, g, unnest(range(1, least(2000, (length(g) - 98) // 2) + 1)) AS i FROM c)),
f AS (SELECT w, min(k) AS m FROM p GROUP BY w),
hit AS (SELECT r, i FROM p JOIN f USING (w) WHERE m < k),
s AS (SELECT r, i, sum(CASE WHEN i <= was + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS was FROM hit)),
span AS (SELECT r, min(i) AS a, max(i) + 49 AS b FROM s GROUP BY r, g),
piece AS (SELECT r, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS e FROM span),
kept AS (SELECT r, string_agg(substr(h, 2 * e + 1, 2 * (a - 1 - e)), '' ORDER BY a) AS x FROM piece JOIN d USING (r) GROUP BY r),
per AS (SELECT r, count(*) AS n_spans, sum(b - a + 1) AS n_removed, max(b) AS tail FROM span GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE x || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""
